"""Statistics that come with a job instead of a job of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..spec import TableSpec
from .sizes import row_size


def observed(df: DataFrame, spec: TableSpec, name: str = "read", **more: Column) -> tuple[DataFrame, Observation]:
    """df, and an observation that has rows, bytes and any further aggregates once an action on df has run."""
    seen = Observation(name)
    size = row_size(df, [n for n in spec.names if n in df.columns])
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"), *[v.alias(k) for k, v in more.items()]), seen
