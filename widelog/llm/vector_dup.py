"""Near-duplicate vectors by NN-descent.

1. Equal vectors form a node that counts for all of them.
2. A neighbour graph starts from rows that lie together in several orders by random projections, cut into chunks of
   fixed size. Each round of descent then meets, at every node, its neighbours and a bounded sample of the nodes that have
   it as theirs; all pairs met are compared, and every node keeps its K nearest.
3. A list is saturated if even its last neighbour is linked, or for the centre of a ball of several so near that members may
   be: more links may exist than it holds. Then nodes within half the
   linking angle of a smaller-numbered one join the ball around it - all members of a ball are linked with each other,
   by the triangle inequality, without looking at their pairs - and the descent goes on among the centres of saturated lists.
   Where nothing can be joined any more, saturated nodes that hang together make a group, whose pairs are settled by blocks; their lists
   then hold nodes of other groups only, and the descent goes on until none is saturated. Lists never grow.
4. Found edges name pairs of balls. A pair of balls near enough to link throughout counts as such; any other is settled by
   exact cosines between blocks of members. What a task compares is bounded, however large a ball.
5. Recall is audited: a bounded set of nodes is compared with all others, and each node's share of its links counts
   alike, also among nodes with few links alone. As long as links are missing, another descent with twice the starting
   orders adds its edges; if the last audit still misses some, the query fails.

Cosines are in double precision. Vectors that are null, empty, zero or hold null or non-finite components link with nothing:
no links, a component of their own. Vectors of different lengths do not link. Rows that repeat an id are vectors of their
own that count as links of each other if equal; a null id never is kept and lends no name to a component. Only
the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log1p, log2, pi, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import FEW_FILES, kept_table, own_tables, partitions, written
from .components import components

THRESHOLD = 0.9
K, TREES, ROUNDS, CHUNK_ROWS, BITS = 8, 6, 3, 64, 14
AUDITED, RECALL, AUDITS = 256, 0.995, 6
BLOCK = 1024
SLACK = 1e-6
#: Starting lists are made anew as long as this share of nodes joins balls by them.
SHRUNK = 0.02


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def matrices(raw: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, unit vectors) for each length of vector."""
    sizes = np.array([len(x) for x in raw])
    for size in np.unique(sizes):
        spot = np.flatnonzero(sizes == size)
        yield spot, unit(np.frombuffer(b"".join(raw[k] for k in spot), np.float64).reshape(len(spot), -1))


def vectors(df: DataFrame, key: str, column: str) -> DataFrame:
    """vec_id, raw: the components as doubles; null where they can't link."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(1).to_pylist():
                a = np.array([np.nan if v is None else v for v in x], np.float64) if x else np.zeros(1)
                out.append(a.tobytes() if np.isfinite(a).all() and a.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "raw"])

    return df.select(F.col(key).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("x")).mapInArrow(check, "vec_id long, raw binary")


LISTS = "id long, near array<struct<sim:float,other:long>>"
LIST_TYPE = pa.list_(pa.struct([("sim", pa.float32()), ("other", pa.int64())]))


class Lists:
    """Neighbour lists on their way out, as flat arrays."""

    def __init__(self) -> None:
        self.own, self.size, self.sim, self.other = [], [], [], []
        self.held = 0

    def add(self, ids: np.ndarray, groups: np.ndarray, raw: list[bytes], k: int) -> None:
        """Each row's k nearest among those of other groups; a node of no group is one of its own."""
        for spot, u in matrices(raw):
            if len(spot) < 2:
                continue
            mine, own = ids[spot], groups[spot]
            s = u @ u.T
            s[own[:, None] == own[None, :]] = -2
            many = min(k, len(spot) - 1)
            best = np.argpartition(-s, many - 1, axis=1)[:, :many]
            sims = np.take_along_axis(s, best, axis=1)
            real = sims > -2
            self.own.append(mine)
            self.size.append(real.sum(1))
            self.sim.append(np.round(sims[real], 6).astype(np.float32))
            self.other.append(mine[best][real])
            self.held += real.size

    def batch(self) -> pa.RecordBatch:
        own, size, sim, other = (np.concatenate(x) for x in (self.own, self.size, self.sim, self.other))
        self.__init__()
        pairs = pa.StructArray.from_arrays([pa.array(sim), pa.array(other)], fields=list(LIST_TYPE.value_type))
        ends = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(own), pa.ListArray.from_arrays(ends, pairs).cast(LIST_TYPE)], names=["id", "near"])


def best_of(lists: DataFrame, k: int) -> DataFrame:
    """The k nearest of all lists of each id; there are a bounded number of lists by id."""
    every = F.array_distinct(F.sort_array(F.flatten(F.collect_list("near")), asc=False))
    return lists.groupBy("id").agg(F.slice(every, 1, k).alias("near"))


def halvings(many: int, k: int) -> float:
    """How many times many rows are halved down to one chunk."""
    return log2(max(1.0, many / max(CHUNK_ROWS, 4 * k)))


def orders(many: int, threshold: float, k: int, trees: int) -> int:
    """Starting orders, trees at least, of which two seeds bring all but 1 - RECALL of barely linked pairs among many rows into one chunk."""
    together = (1 - acos(threshold) / pi) ** halvings(many, k)
    return trees if together >= 1 else max(trees, ceil(log(1 - RECALL) / (2 * log1p(-together))))


def started(nodes: DataFrame, k: int, trees: int, seed: int, many: int) -> DataFrame:
    """Lists from chunks of rows that are neighbours in orders by random projections."""
    chunk, bits = max(CHUNK_ROWS, 4 * k), max(BITS, ceil(halvings(many, k)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(2).to_pylist()
            code, value = np.zeros((len(raw), trees), np.int64), np.zeros((len(raw), trees))
            for spot, u in matrices(raw):
                for t in range(trees):
                    axes = np.random.default_rng([seed, t, u.shape[1]]).normal(size=(u.shape[1], bits + 1))
                    along = u @ axes
                    code[spot, t] = (along[:, :bits] > 0) @ (1 << np.arange(bits))
                    value[spot, t] = along[:, bits]
            take = np.repeat(np.arange(len(raw)), trees)
            columns = [pa.array(np.tile(np.arange(trees), len(raw)).astype(np.int32)), pa.array(code.reshape(-1)), pa.array(value.reshape(-1))]
            yield pa.RecordBatch.from_arrays([*columns, *(c.take(pa.array(take)) for c in batch.columns)], names=["tree", "code", "value", "id", "grp", "raw"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, ids, groups, raw, out = -1, [], [], [], Lists()
        for batch in batches:
            for t, i, g, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if t != tree or len(ids) == chunk:
                    if len(ids) > 1:
                        out.add(np.array(ids), np.array(groups), raw, k)
                    tree, ids, groups, raw = t, [], [], []
                ids.append(i)
                groups.append(g)
                raw.append(x)
            if out.held > 200_000:
                yield out.batch()
        if len(ids) > 1:
            out.add(np.array(ids), np.array(groups), raw, k)
        if out.held:
            yield out.batch()

    placed = nodes.select("id", "grp", "raw").mapInArrow(place, "tree int, code long, value double, id long, grp long, raw binary")
    ordered = placed.repartitionByRange(partitions(nodes.sparkSession), "tree", "code", "value").sortWithinPartitions("tree", "code", "value")
    return best_of(ordered.select("tree", "id", "grp", "raw").mapInArrow(meet, LISTS), k)


def descended(nodes: DataFrame, graph: DataFrame, k: int) -> DataFrame:
    """One round: all pairs met at any node are compared."""
    ahead = graph.select(F.col("id").alias("at"), F.explode("near.other").alias("id"))
    back = graph.select(F.explode("near").alias("x"), "id").select(F.col("x.other").alias("at"), "id", F.col("x.sim").alias("sim"))
    rank = F.row_number().over(Window.partitionBy("at").orderBy(F.desc("sim"), "id"))
    back = back.withColumn("r", rank).filter(F.col("r") <= k).select("at", "id")
    met = ahead.unionByName(back).unionByName(graph.select(F.col("id").alias("at"), "id")).distinct()
    sent = met.join(nodes.select("id", "grp", "raw"), "id")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, groups, raw, out = None, [], [], [], Lists()
        for batch in batches:
            for a, i, g, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if a != at:
                    if len(ids) > 1:
                        out.add(np.array(ids), np.array(groups), raw, max(3, k // 2))
                    at, ids, groups, raw = a, [], [], []
                ids.append(i)
                groups.append(g)
                raw.append(x)
                if out.held > 200_000:
                    yield out.batch()
        if len(ids) > 1:
            out.add(np.array(ids), np.array(groups), raw, max(3, k // 2))
        if out.held:
            yield out.batch()

    together = sent.select("at", "id", "grp", "raw").repartition(partitions(nodes.sparkSession), "at").sortWithinPartitions("at")
    fresh = together.mapInArrow(meet, LISTS)
    single = fresh.select("id", F.explode("near").alias("x")).select("id", "x.sim", "x.other").distinct()  # partial: the same pair is met at many nodes
    top = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("sim"), "other"))
    short = single.withColumn("r", top).filter(F.col("r") <= k).groupBy("id").agg(F.collect_list(F.struct("sim", "other")).alias("near"))
    return best_of(graph.unionByName(short), k)


def descent(nodes: DataFrame, k: int, trees: int, rounds: int, seed: int, many: int) -> DataFrame:
    graph = written(started(nodes, k, trees, seed, many), "graph", FEW_FILES)
    for _ in range(rounds):
        graph = written(descended(nodes, graph, k), "graph", FEW_FILES)
    return graph


def half_way(threshold: float) -> float:
    """The cosine of half the angle of which threshold is the cosine, a little raised."""
    return sqrt((1 + threshold) / 2) + 1e-12


def cosines(left: str, right: str, pairs: DataFrame, out: str) -> DataFrame:
    """pairs with a column out, the cosine of two columns of raw vectors, which go."""
    names = [c for c in pairs.columns if c not in (left, right)]

    def cosine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.full(batch.num_rows, -2.0)
            a, b = batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            same = [k for k in range(len(a)) if len(a[k]) == len(b[k])]
            for spot, u in matrices([a[k] for k in same]):
                rows = [same[k] for k in spot]
                v = unit(np.frombuffer(b"".join(b[k] for k in rows), np.float64).reshape(len(rows), -1))
                got[rows] = (u * v).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(got)], names=[*names, out])

    schema = T.StructType([*pairs.select(*names).schema.fields, T.StructField(out, T.DoubleType())])
    return pairs.select(*names, left, right).mapInArrow(cosine, schema)


def joined_balls(members: DataFrame, nodes: DataFrame, edges: DataFrame, threshold: float) -> tuple[DataFrame, int]:
    """members (id, centre) after centres joined smaller-numbered ones near them; and how many members moved."""
    near = edges.filter(F.col("sim") >= half_way(threshold) + SLACK).select("id", "other")
    both = near.unionByName(near.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct()
    least = both.groupBy("id").agg(F.min("other").alias("least"))
    leaders = least.filter("least > id").select(F.col("id").alias("other"))
    moves = both.join(leaders, "other").filter("other < id").groupBy("id").agg(F.min("other").alias("to"))
    tried = members.join(moves.withColumnRenamed("id", "centre"), "centre").select("id", "centre", "to")
    with_raw = tried.join(nodes.select("id", F.col("raw").alias("a")), "id").join(nodes.select(F.col("id").alias("to"), F.col("raw").alias("b")), "to")
    moved = cosines("a", "b", with_raw.select("id", "to", "a", "b"), "sim").filter(F.col("sim") >= half_way(threshold)).select("id", "to")
    moved = written(moved, "moved", FEW_FILES)
    after = members.join(moved, "id", "left").select("id", F.coalesce("to", "centre").alias("centre"))
    return written(after, "members", FEW_FILES), moved.count()


def found_edges(nodes: DataFrame, threshold: float, k: int, trees: int, rounds: int, seed: int, times: int = 1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges (id, other) between linked or nearly linked nodes, members (id, centre) of balls, and links (u, v) that make groups of centres."""
    members = written(nodes.select("id", F.col("id").alias("centre")), "members", FEW_FILES)
    active, many, all_edges = nodes.withColumn("grp", F.col("id")), nodes.count(), None
    group_links = written(nodes.select(F.col("id").alias("u"), F.col("id").alias("v")).limit(0), "group-links", FEW_FILES)
    dense, balls = True, True  # first, dense groups shrink to centres by the starting lists alone, as long as much moves
    while many > 1:
        enough = orders(many, threshold, k, trees) * times
        graph = written(started(active, k, enough, seed, many), "graph", FEW_FILES) if dense else descent(active, k, enough, rounds, seed, many)
        # a radius beyond the threshold, for balls whose members link where their centres do not
        edges = graph.select("id", F.explode("near").alias("x")).select("id", "x.other", "x.sim").filter(F.col("sim") >= 2 * threshold**2 - 1 - SLACK)
        edges = written(edges, "edges", FEW_FILES)
        all_edges = edges if all_edges is None else all_edges.unionByName(edges)
        moved = 0
        if balls:
            members, moved = joined_balls(members, nodes, edges, threshold)
        left = members.select(F.col("centre").alias("id")).distinct()
        if dense:
            dense = moved > SHRUNK * many
            active = left.join(nodes, "id").withColumn("grp", F.col("id"))
        else:
            several = members.groupBy(F.col("centre").alias("id")).agg((F.count("*") > 1).alias("several"))
            reach = F.when(F.col("several"), 2 * threshold**2 - 1).otherwise(threshold) - SLACK
            full = graph.filter(F.size("near") >= k).join(several, "id").filter(F.col("near")[k - 1]["sim"] >= reach)
            active = full.select("id").join(left, "id", "left_semi").join(nodes, "id").withColumn("grp", F.col("id"))
            if not moved:
                balls = False
                fresh = full.select("id", "near", reach.alias("reach")).select(F.col("id").alias("u"), "reach", F.explode("near").alias("x"))
                fresh = fresh.filter(F.col("x.sim") >= F.col("reach")).select("u", F.col("x.other").alias("v"))
                group_links = written(group_links.unionByName(fresh), "group-links", FEW_FILES)
                label = components(group_links, "u", "v")
                active = active.drop("grp").join(label.withColumnRenamed("node", "id"), "id", "left").withColumn("grp", F.coalesce("component", "id")).drop("component")
        active, seed = written(active, "active", FEW_FILES), seed + 1
        many = active.count()
    if all_edges is None:
        all_edges = nodes.select("id", F.col("id").alias("other"), F.lit(0.0).cast("float").alias("sim")).limit(0)
    return all_edges, members, group_links


def in_groups(weighed: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(id, n, to) of nodes of groups, by blocks of a group that meet each other in tasks of their own: weights of others linked there, and a smallest node reached there.

    weighed has id, grp, weight. A node's counts add up over tasks; links to the smallest nodes connect what the group's links do.
    """
    some = weighed.filter("grp is not null").select("id", "grp", "weight")
    blocks = some.groupBy("grp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    mine = some.join(nodes.select("id", "raw"), "id").join(blocks, "grp").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    mine = mine.withColumn("across", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sent = mine.select("grp", F.least("own", "across").alias("i"), F.greatest("own", "across").alias("j"), (F.col("own") > F.col("across")).cast("int").alias("side"), "id", "weight", "raw")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = rows[rows["side"] == 0], rows[rows["side"] == 1]
        if not len(b):  # a block with itself, or one that nothing meets
            b = a if rows["i"].iloc[0] == rows["j"].iloc[0] else b
        if not len(a) or not len(b):
            return pd.DataFrame({"id": [], "n": [], "to": []}).astype("int64")
        ids, others = a["id"].to_numpy(), b["id"].to_numpy()
        u, v = (unit(np.frombuffer(b"".join(x["raw"]), np.float64).reshape(len(x), -1)) for x in (a, b))
        link = (u @ v.T >= threshold) & (ids[:, None] != others[None, :])
        least, most = ids.copy(), others.copy()
        while True:
            x = np.minimum(least, np.where(link, most[None, :], np.iinfo(np.int64).max).min(1))
            y = np.minimum(most, np.where(link, x[:, None], np.iinfo(np.int64).max).min(0))
            if (x == least).all() and (y == most).all():
                break
            least, most = x, y
        n = link @ b["weight"].to_numpy()
        if b is a:
            return pd.DataFrame({"id": ids, "n": n.astype(np.int64), "to": np.minimum(least, most)})
        return pd.DataFrame({"id": np.concatenate([ids, others]), "n": np.concatenate([n, a["weight"].to_numpy() @ link]).astype(np.int64), "to": np.concatenate([least, most])})

    return written(sent.groupBy("grp", "i", "j").applyInPandas(compare, "id long, n long, to long"), "in-groups", FEW_FILES)


def settled(nodes: DataFrame, members: DataFrame, edges: DataFrame, group_links: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(id, name, n_links) of each node, and links (u, v) between names of balls."""
    centre_of = lambda c: members.select(F.col("id").alias(c), F.col("centre").alias(f"{c}_centre"))
    joined = group_links.join(centre_of("u"), "u").join(centre_of("v"), "v").select("u_centre", "v_centre")
    label = components(joined, "u_centre", "v_centre")
    groups = label.select(F.col("node").alias("centre"), F.col("component").alias("grp")).unionByName(label.select(F.col("component").alias("centre"), F.col("component").alias("grp")).distinct())
    groups = written(groups, "groups", FEW_FILES)
    members = written(members.join(groups, "centre", "left").select("id", "centre", "grp"), "members", FEW_FILES)
    weighed = members.join(nodes.select("id", "weight"), "id")
    ball = weighed.groupBy("centre").agg(F.sum("weight").alias("size"), F.min("id").alias("name"), F.count("*").alias("rows"))
    to_centre = members.join(nodes.select("id", F.col("raw").alias("a")), "id").join(nodes.select(F.col("id").alias("centre"), F.col("raw").alias("b")), "centre")
    spread = cosines("a", "b", to_centre.filter("id != centre"), "sim").groupBy("centre").agg(F.min("sim").alias("least"))
    ball = written(ball.join(spread, "centre", "left").withColumn("angle", F.acos(F.least(F.coalesce("least", F.lit(1.0)), F.lit(1.0)))), "balls", FEW_FILES)

    ends = edges.select("id", "other").distinct()
    ends = ends.join(members.select("id", F.col("centre").alias("p"), F.col("grp").alias("p_grp")), "id")
    ends = ends.join(members.select(F.col("id").alias("other"), F.col("centre").alias("q"), F.col("grp").alias("q_grp")), "other")
    pairs = ends.filter((F.col("p") != F.col("q")) & ~F.coalesce(F.col("p_grp") == F.col("q_grp"), F.lit(False))).select(F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q")).distinct()
    for side in ("p", "q"):
        pairs = pairs.join(ball.select(F.col("centre").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in ("size", "name", "rows", "angle"))), side)
        pairs = pairs.join(nodes.select(F.col("id").alias(side), F.col("raw").alias(f"{side}_raw")), side)
    pairs = cosines("p_raw", "q_raw", pairs, "sim").withColumn("apart", F.acos(F.least(F.greatest("sim", F.lit(-1.0)), F.lit(1.0))))
    limit = acos(threshold)
    slack = F.col("p_angle") + F.col("q_angle")
    pairs = written(pairs.filter(F.col("apart") <= slack + limit + 1e-6), "pairs", FEW_FILES)
    lone = (F.col("p_rows") == 1) & (F.col("q_rows") == 1)
    whole = pairs.filter((F.col("apart") + slack <= limit - 1e-6) | (lone & (F.col("sim") >= threshold)))
    rest = pairs.filter((F.col("apart") + slack > limit - 1e-6) & ~lone)

    more = whole.select(F.col("p").alias("centre"), F.col("q_size").alias("n")).unionByName(whole.select(F.col("q").alias("centre"), F.col("p_size").alias("n")))
    more = more.groupBy("centre").agg(F.sum("n").alias("more"))

    # members of either side in blocks; every block of one side meets every block of the other in a task of its own
    blocks = rest.select("p", "q", F.ceil(F.col("p_rows") / BLOCK).cast("int").alias("p_blocks"), F.ceil(F.col("q_rows") / BLOCK).cast("int").alias("q_blocks"))
    full = weighed.join(nodes.select("id", "raw"), "id")
    sent = []
    for side, other in (("p", "q"), ("q", "p")):
        mine = full.select("id", F.col("centre").alias(side), "weight", "raw").join(blocks, side)
        own = F.pmod(F.xxhash64("id"), F.col(f"{side}_blocks")).cast("int")
        mine = mine.withColumn("own", own).withColumn("across", F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)))
        i, j = ("own", "across") if side == "p" else ("across", "own")
        sent.append(mine.select("p", "q", F.col(i).alias("i"), F.col(j).alias("j"), F.lit(side).alias("side"), "id", "weight", "raw"))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = rows[rows["side"] == "p"], rows[rows["side"] == "q"]
        if not len(a) or not len(b):
            return pd.DataFrame({"p": [], "q": [], "id": [], "n": []}).astype("int64")
        u, v = (unit(np.frombuffer(b"".join(x["raw"]), np.float64).reshape(len(x), -1)) for x in (a, b))
        link = u @ v.T >= threshold
        ids = np.concatenate([a["id"].to_numpy(), b["id"].to_numpy()])
        n = np.concatenate([link @ b["weight"].to_numpy(), a["weight"].to_numpy() @ link]).astype(np.int64)
        return pd.DataFrame({"p": rows["p"].iloc[0], "q": rows["q"].iloc[0], "id": ids[n > 0], "n": n[n > 0]})

    single = written(sent[0].unionByName(sent[1]).groupBy("p", "q", "i", "j").applyInPandas(compare, "p long, q long, id long, n long"), "across", FEW_FILES)
    extra = single.groupBy("id").agg(F.sum("n").alias("extra"))
    met = in_groups(weighed, nodes, threshold)
    within = met.groupBy("id").agg(F.sum("n").alias("within"))
    counted = weighed.join(ball.select("centre", "size", "name"), "centre").join(more, "centre", "left").join(extra, "id", "left").join(within, "id", "left")
    own = F.when(F.col("grp").isNull(), F.col("size") - 1).otherwise(F.col("weight") - 1 + F.coalesce("within", F.lit(0)))
    counted = counted.select("id", "name", (own + F.coalesce("more", F.lit(0)) + F.coalesce("extra", F.lit(0))).alias("n_links"))
    named = members.join(ball.select("centre", "name"), "centre").select("id", "name")
    reached = met.filter("id != to").select("id", "to").distinct().join(named.withColumnRenamed("name", "p_name"), "id").join(named.select(F.col("id").alias("to"), F.col("name").alias("q_name")), "to").select("p_name", "q_name")
    links = reached.unionByName(whole.select("p_name", "q_name")).unionByName(pairs.join(single.select("p", "q").distinct(), ["p", "q"], "left_semi").select("p_name", "q_name"))
    return written(counted, "counted", FEW_FILES), written(links, "links", FEW_FILES)


def audited(nodes: DataFrame, counted: DataFrame, threshold: float) -> float:
    """The mean share of a node's links that were found, over a bounded set of nodes compared with all; that of nodes with few links if it is less."""
    chosen = nodes.select("id", "raw").orderBy(F.xxhash64("id", F.lit("audit")), "id").limit(AUDITED).collect()
    if not chosen:
        return 1.0
    ids, raw = [r["id"] for r in chosen], [bytes(r["raw"]) for r in chosen]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(ids), np.int64)
        asked = list(matrices(raw))
        for batch in batches:
            weight = batch.column(1).to_numpy()
            for spot, u in matrices(batch.column(0).to_pylist()):
                for mine, q in asked:
                    if q.shape[1] == u.shape[1]:
                        n[mine] += (q @ u.T >= threshold) @ weight[spot]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n)], names=["id", "n"])

    truth = {r["id"]: r["n"] - 1 for r in nodes.select("raw", "weight").mapInArrow(compare, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()}
    got = {r["id"]: r["n_links"] for r in counted.filter(F.col("id").isin(ids)).collect()}
    shares = {k: min(got[k], n) / n for k, n in truth.items() if n}
    few = [x for k, x in shares.items() if truth[k] <= K]
    return min((sum(x) / len(x) for x in (list(shares.values()), few) if x), default=1.0)


def near_vectors(df: DataFrame, key: str = "vec_id", column: str = "embedding", threshold: float = THRESHOLD, k: int = K, trees: int = TREES, rounds: int = ROUNDS) -> DataFrame:
    """One row for each row of df: vec_id, n_links, component_id, kept."""
    with own_tables():
        all_rows = written(vectors(df, key, column).withColumn("same", F.md5("raw")), "vectors", FEW_FILES)
        named = all_rows.filter("raw is not null")
        ids = F.coalesce(F.min("vec_id"), F.min(-F.abs(F.xxhash64("raw")) - 1))  # a class without any id gets a negative number of its own
        nodes = written(named.groupBy("same").agg(ids.alias("id"), F.count("*").alias("weight"), F.min("raw").alias("raw")), "nodes", FEW_FILES)
        edges, members, group_links = found_edges(nodes, threshold, k, trees, rounds, 1)
        for again in range(AUDITS):
            counted, links = settled(nodes, members, edges, group_links, threshold)
            recall = audited(nodes, counted, threshold)
            if recall >= RECALL:
                break
            if again + 1 == AUDITS:
                raise RuntimeError(f"recall of links is {recall:.4f} after {AUDITS} descents, less than {RECALL}")
            fresh, _, more_links = found_edges(nodes, threshold, k, trees, rounds + 1, 101 * (again + 1), 2 << again)
            group_links = written(group_links.unionByName(more_links), "group-links", FEW_FILES)
            edges = written(edges.unionByName(fresh).select("id", "other", "sim"), "edges", FEW_FILES)
        group = components(links, "p_name", "q_name").select(F.col("node").alias("name"), "component")
        told = counted.join(group, "name", "left").select("id", "n_links", F.coalesce("component", "name").alias("component"))
        told = nodes.select("same", "id").join(told, "id").select("same", "n_links", "component")
        out = all_rows.select("vec_id", "same").join(told, "same", "left")
        component = F.coalesce("component", "vec_id")
        told = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
        return kept_table(told, "near-vectors")


def op9_near_vectors(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return near_vectors(read(spark, sf_dir, "embeddings"))
