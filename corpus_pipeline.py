"""A training-data pipeline over the documents table.

Five stages, each written as Parquet and read again as the next one's documents: the quality classifier drops documents that it
rejects; near-duplicate groups keep their smallest id; benchmark passages are cut out, and documents that are mostly such
passages leave; secrets are replaced by a mark; sources are repeated to their target weights, which adds ``replica``.
An empty input passes through all stages; nulls and repeated rows are treated as each operator says.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from widelog.llm import decontaminate, mixing, near_dup, quality, secrets
from widelog.llm.common import read, removed, shared_folder
from widelog.shipping import ship

#: No SQL expresses the learned and the hashed stages; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.trained(ship(spark), sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_dup.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.cleaned(docs, decontaminate.automaton(read(ship(spark), sf_dir, "benchmark")))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("source_mixing", source_mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each through a table in the shared folder; only the last one's stays there."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        if before:
            removed(spark, before)
        before = f"{folder}/{name}"
        docs = spark.read.parquet(before)
    return docs
