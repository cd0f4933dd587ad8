"""Sizes of partitions and summaries of runs, from metadata-like aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import TableSpec

_FIXED = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4, T.DoubleType: 8, T.BooleanType: 1, T.TimestampType: 8, T.TimestampNTZType: 8, T.DateType: 4}


def value_size(value: Column, kind: T.DataType) -> Column:
    """Bytes of a value as stored; null has none."""
    for t, n in _FIXED.items():
        if isinstance(kind, t):
            return F.when(value.isNotNull(), F.lit(n)).otherwise(0).cast("long")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long")
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.aggregate(value, F.lit(0).cast("long"), lambda a, x: a + value_size(x, kind.elementType)), F.lit(0)).cast("long")
    if isinstance(kind, T.MapType):
        return value_size(F.map_keys(value), T.ArrayType(kind.keyType)) + value_size(F.map_values(value), T.ArrayType(kind.valueType))
    if isinstance(kind, T.StructType):
        total = F.lit(0).cast("long")
        for f in kind:
            total = total + value_size(value[f.name], f.dataType)
        return total
    return F.coalesce(F.octet_length(value.cast("string")), F.lit(0)).cast("long")


def row_size(df: DataFrame, names: list[str]) -> Column:
    total = F.lit(0).cast("long")
    for n in names:
        total = total + value_size(F.col(f"`{n}`"), df.schema[n].dataType)
    return total


def partition_sizes(df: DataFrame, spec: TableSpec, run: str | None = None, ratios: DataFrame | None = None) -> DataFrame:
    """One row for each run and partition: its key, uncompressed and compressed bytes. Runs are not added up.

    ratios: (run, ratio) of compressed to uncompressed bytes of each run; without it compressed is uncompressed. Each
    partition's compressed size is its share of its run's.
    """
    names = [n for n in spec.names if n in df.columns]
    by = ([run] if run else []) + spec.partition_key
    sizes = df.groupBy(*[F.col(f"`{k}`") for k in by]).agg(F.sum(row_size(df, names)).alias("uncompressed"))
    if ratios is None or not run:
        return sizes.withColumn("compressed", F.col("uncompressed"))
    known = sizes.join(F.broadcast(ratios.select(run, "ratio")) if ratios.count() <= 100_000 else ratios.select(run, "ratio"), run, "left")
    return known.withColumn("compressed", F.round(F.col("uncompressed") * F.coalesce("ratio", F.lit(1.0))).cast("long")).drop("ratio")


def prorated(start: int, end: int, chunk: int, lengths: list[int]) -> int:
    """Compressed bytes of an uncompressed stretch of a file that is compressed in chunks of equal size."""
    if end <= start:
        return 0
    first, last = start // chunk, (end - 1) // chunk
    if first == last:
        return round((end - start) / chunk * lengths[first])
    head = round((chunk - start % chunk) / chunk * lengths[first])
    tail = round((end - last * chunk) / chunk * lengths[last])
    return head + sum(lengths[first + 1 : last]) + tail


def with_compressed(index: DataFrame, start: str, end: str, chunk: int, lengths: str) -> DataFrame:
    """index with compressed, column by column the same proration; lengths: an array column of compressed chunk lengths."""
    a, b, n = F.col(start), F.col(end), F.lit(chunk)
    first, last = F.floor(a / n).cast("int"), F.floor((b - 1) / n).cast("int")
    at = lambda k: F.get(F.col(lengths), k)
    middle = F.aggregate(F.slice(F.col(lengths), first + 2, F.greatest(last - first - 1, F.lit(0))), F.lit(0).cast("long"), lambda s, x: s + x)
    one = F.bround((b - a) / n * at(first)).cast("long")
    many = F.bround((n - a % n) / n * at(first)).cast("long") + middle + F.bround((b - last * n) / n * at(last)).cast("long")
    return index.withColumn("compressed", F.when(b <= a, F.lit(0)).when(first == last, one).otherwise(many).cast("long"))


def index_entries(df: DataFrame, spec: TableSpec, run: str, token: str = "token") -> DataFrame:
    """Where each partition begins and ends in its run, in token order: the difference of next positions is its size."""
    from pyspark.sql import Window

    sizes = df.groupBy(run, token, *[F.col(f"`{k}`") for k in spec.partition_key]).agg(F.sum(row_size(df, [n for n in spec.names if n in df.columns])).alias("size"))
    order = Window.partitionBy(run).orderBy(token, *[F.col(f"`{k}`") for k in spec.partition_key])
    return sizes.withColumn("end", F.sum("size").over(order)).withColumn("start", F.col("end") - F.col("size"))


def run_summaries(df: DataFrame, run: str, token: str = "token") -> DataFrame:
    """First and last token and number of rows of each run."""
    return df.groupBy(run).agg(F.min(token).alias("first_token"), F.max(token).alias("last_token"), F.count("*").alias("rows"))
