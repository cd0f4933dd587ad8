"""Streams of writes into a table's log, and current rows kept up to date from them.

A stream's micro-batches are appended as runs of the log, so that a batch that is written again after a failure changes
nothing: its folder is replaced, and a merge takes equal cells as one. Rows are merged when they are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import merge_on_read
from ..sources.write import log_of
from ..spec import TableSpec


def stream_writes(rows: DataFrame, spec: TableSpec, path: str, checkpoint: str, options: dict[str, object] | None = None) -> StreamingQuery:
    """Appends a stream of rows to the log under path, a folder for each micro-batch.

    A TIMESTAMP option is needed: the write time of a row must not depend on when its batch runs.
    """
    if not (options or {}).get("TIMESTAMP"):
        raise ValueError("a stream needs the TIMESTAMP option")

    def append(batch: DataFrame, number: int) -> None:
        log_of(batch, spec, options).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number}")

    return rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, spec: TableSpec, path: str, now: int = 0) -> DataFrame:
    """Merged rows of all batches so far."""
    return merge_on_read(spark.read.option("mergeSchema", "true").parquet(path).drop("batch"), spec, now)


def latest_per_window(events: DataFrame, spec: TableSpec, time: str, window: str, late: str) -> DataFrame:
    """The newest write of each row within each window of event time, for streams and tables alike; late rows past the watermark drop."""
    values = [F.col(f"`{n}`").alias(n) for n in spec.regulars]
    newest = F.max_by(F.struct(*values), F.struct(F.col(time), *values)).alias("row")
    grouped = events.withWatermark(time, late).groupBy(F.window(time, window), *[F.col(f"`{k}`") for k in spec.primary_key]).agg(newest)
    return grouped.select(F.col("window.start").alias("start"), *[f"`{k}`" for k in spec.primary_key], "row.*")
