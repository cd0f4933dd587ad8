"""Bounded samples of labelled rows, for fitting classifiers only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bounded(df: DataFrame, label: str, key: str, per_label: int, max_labels: int | None) -> tuple[DataFrame, list]:
    """Up to per_label rows of each of the max_labels commonest labels (of every label if None), those of the smallest hashed keys.

    Counts cover all rows. A hash threshold of each label leaves about twice per_label rows of it, so the ranking
    that follows gets a bounded number of rows whatever the input's size.
    """
    counts = df.groupBy(label).count().orderBy(F.desc("count"), label)
    counts = (counts if max_labels is None else counts.limit(max_labels)).collect()
    if not counts:
        return df.limit(0), []
    draw = F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 40))
    if max_labels is None:  # one join, however many labels
        shares = df.sparkSession.createDataFrame([(r[label], int(min(1.0, (2 * per_label + 50) / r["count"]) * (1 << 40))) for r in counts], "__label string, __below long")
        rank = F.row_number().over(Window.partitionBy(label).orderBy("__draw", key))
        drawn = df.withColumn("__draw", draw).join(F.broadcast(shares), F.col(label) == F.col("__label")).filter("__draw < __below")
        return drawn.withColumn("__rank", rank).filter(F.col("__rank") <= per_label).drop("__draw", "__rank", "__label", "__below"), [r[label] for r in counts]
    near = F.lit(False)
    for row in counts:
        near = near | ((F.col(label) == F.lit(row[label])) & (draw < F.lit(int(min(1.0, (2 * per_label + 50) / row["count"]) * (1 << 40)))))
    rank = F.row_number().over(Window.partitionBy(label).orderBy("__draw", key))
    return df.filter(near).withColumn("__draw", draw).withColumn("__rank", rank).filter(F.col("__rank") <= per_label).drop("__draw", "__rank"), [r[label] for r in counts]
