"""Connected components of a link table by alternating large and small stars, all in joins and grouped minima.

No vertex's neighbours are ever gathered in one place: a round takes each vertex's smallest neighbour by a partial
aggregate and joins it back, and the few vertices with a large share of all links are joined by broadcast. First, each task contracts
the links that it reads, a bounded number at a time, to stars of their own, so that long chains take few rounds. As soon as what is left
is no more than one task contracts at a time, one task settles it, without rounds: every round costs the driver many exchanges
and broadcasts. Every round ends in a table in the shared folder. An empty link table gives an empty result; self links and repeated links change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FEW_FILES, dropped, written


#: A vertex with more than a share 1 / HOT of all link ends is joined by broadcast; there are fewer than HOT of them.
HOT, FEW = 500, 64
#: Links that a task contracts at a time; so many at most are settled by one task.
AT_ONCE = 1_000_000


def least_reached(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct vertices of some links, and the smallest one that each reaches by them."""
    ids, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for side in (a, b):
            np.minimum.at(new, side, low)
            np.minimum.at(new, label[side], low)
        while not (new[new] == new).all():
            new = new[new]
        if (new == label).all():
            return ids, ids[label]
        label = new


def contracted(links: DataFrame) -> DataFrame:
    """links (u, v) as stars (u, v) with u > v: what each task reads hangs together as before."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def stars() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            held.clear()
            ids, least = least_reached(table["u"].to_numpy(), table["v"].to_numpy())
            far = ids != least
            return pa.RecordBatch.from_arrays([pa.array(ids[far]), pa.array(least[far])], names=["u", "v"])

        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= AT_ONCE:
                yield stars()
        if held:
            yield stars()

    return links.mapInArrow(contract, "u long, v long").distinct()


def starred(links: DataFrame, small: bool, total: int) -> DataFrame:
    """One star step over links (u, v) with u > v, of which there are total."""
    if small:
        ends = links
    else:
        ends = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    centre = ends.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("u", "m"))
    hot = F.broadcast(centre.filter(F.col("n") > max(FEW, 2 * total // HOT)).select("u", "m"))
    joined = ends.join(hot, "u").unionByName(ends.join(hot.select("u"), "u", "left_anti").join(centre.select("u", "m"), "u"))
    if small:
        moved = joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u > v").distinct()


def settled(links: DataFrame) -> tuple[int, bool]:
    """How many links (u, v) there are, and whether they are stars: each u once, and none of them a v."""
    ends = links.select("u", F.lit(1).alias("out"), F.lit(0).alias("centre")).unionByName(links.select(F.col("v").alias("u"), F.lit(0).alias("out"), F.lit(1).alias("centre")))
    by = ends.groupBy("u").agg(F.sum("out").alias("out"), F.max("centre").alias("centre"))
    told = by.agg(F.sum("out").alias("n"), F.sum(((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("centre") > 0))).cast("int")).alias("wrong")).first()
    return int(told["n"] or 0), not told["wrong"]


def components(links: DataFrame, u: str, v: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every linked node but the smallest of each component, which is its component's name; a written table."""
    now = written(contracted(links.select(F.col(u).alias("u"), F.col(v).alias("v"))), "links", FEW_FILES)
    total, done = now.count(), False
    for _ in range(max_rounds):
        if total <= AT_ONCE:
            stars = written(contracted(now.coalesce(1)), "links", 1)
            dropped(now)
            now, done = stars, True
        else:
            total, done = settled(now)
        if done:
            out = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            out.written_at = now.written_at
            return out
        large = written(starred(now, small=False, total=total), "links", FEW_FILES)
        small = written(starred(large, small=True, total=total), "links", FEW_FILES)
        dropped(now, large)
        now = small
        total = now.count()
    raise RuntimeError("components did not settle")
