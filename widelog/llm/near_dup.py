"""Near-duplicate documents by bottom-k sketches from one hash function.

1. Each text's set of shingles gives its size, a digest of the whole set, and a sketch: the K smallest hashes.
   Documents with equal sets form a class; a row with the smallest id stands for it from here on.
2. Inverted lists of the retained values. ``fewest_shared`` says how many of them two linked sets share at least. With each
   sketch in one global order, rarest values first, two such sketches meet in the first size - needed + 1
   values of both, so only those are listed: passages that many documents share come last and mostly drop out.
   Lists count each class's overlap with the smallest class of every list; lists that hang together make groups.
3. ``refined`` goes over the groups twice, first with sketches, then with full sets. The class with the largest overlap counted is
   tested first for each member, which settles most of a group in linear time. Only members that are still in different
   parts meet after that, in blocks of bounded size dealt by part and by size of set, each pair of blocks in a task of its own.
   - With sketches, a pair goes on if the union of both sketches (its K smallest values) holds as many shared values as a linked pair's.
     Texts are read again only for the classes that this leaves together.
   - With full sets, the test is exact: 100 * intersection >= PERCENT * union.
   Each task returns a spanning forest of what it found, and stars join forests up over all tasks.

Certainty: sets of up to K members have whole sketches, and bounds on their overlaps hold always. For larger sets the K smallest values of
the union are a random sample of it; a linked pair shows fewer shared values than ``fewest_shared`` in less than one of 1 / MISS cases,
whatever the sizes, which is rarer than two shingles with one 64-bit hash. Nothing else lets a link go.

Texts without words, empty and null texts have no shingles and are linked with nothing: component_id is their own id.
Classes are told apart by numbers of their own, so rows without an id and rows that share one link like all others. A component
is named by its least id (null where it has none); the texts kept are those of that id, or the one of the least digest
where there is no id, and rows that repeat id and text get the same answer. Where one id has several texts, each is judged
by itself. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import FEW_FILES, by_key, dropped, kept_table, own_tables, runs, written
from .components import components
from .shingles import sets

K, PERCENT, MISS = 64, 75, 1e-12
BLOCK_ROWS, BLOCK_VALUES = 256, 250_000
#: Sets whose sizes differ by this factor or more can't be linked (it is a little over 100 / PERCENT).
BAND = 1.34
TOP = np.uint64(1 << 63)


def marked(key: str, text: str) -> Column:
    """A digest of a row's id and text."""
    body = F.coalesce(F.concat(F.lit("="), F.col(text)), F.lit(""))
    return F.md5(F.concat(F.coalesce(F.col(key).cast("long").cast("string"), F.lit("")), body))


def as_lists(found: list[np.ndarray]) -> pa.ListArray:
    """Sorted hashes as longs that order as the hashes do."""
    ends = np.concatenate([[0], np.cumsum([len(s) for s in found])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array((np.concatenate(found) ^ TOP).view(np.int64)))


def from_lists(column: pa.ListArray) -> list[np.ndarray]:
    at, flat = column.offsets.to_numpy(), column.values.to_numpy()
    return [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc, mark, n, set_key, sketch."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, at in runs(batches, "t"):
            found = sets(raw, at)
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in found]
            columns = [rows.column(0), rows.column(1), pa.array([len(s) for s in found], pa.int64()), pa.array(digests, pa.binary()), as_lists([s[:K] for s in found])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "mark", "n", "set_key", "sketch"])

    return docs.select(F.col(key).cast("long").alias("doc"), marked(key, text).alias("mark"), F.col(text).alias("t")).mapInArrow(sketch, "doc long, mark string, n long, set_key binary, sketch array<long>")


def least_intersection(n: int, m: int) -> int:
    """The smallest intersection of linked sets of n and m members."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


@cache
def fewest_of_sample() -> int:
    """The fewest shared ones among K members of a linked pair's union, but for one case in 1 / MISS.

    Drawing from the union without replacement strays less than independent draws, which this counts.
    """
    t, below, k = PERCENT / 100, 0.0, 0
    while below + (one := comb(K, k) * t**k * (1 - t) ** (K - k)) < MISS:
        below, k = below + one, k + 1
    return max(1, k)


@cache
def fewest_shared(n: int) -> int:
    """The fewest retained values that a set of n members shares with the sketch of any set it is linked with.

    Sets of up to K are whole. A linked partner of m > K members holds at least ``least_intersection`` of theirs, so its
    sketch has at most m less that many others, whichever values it retains.
    """
    if n > K:
        return fewest_of_sample()
    whole = -(-PERCENT * n // 100)
    return min([whole, *(K - m + least_intersection(n, m) for m in range(K + 1, 100 * n // PERCENT + 1))])


def needed() -> Column:
    """``fewest_shared`` by the column n."""
    bounds = F.array(*(F.lit(fewest_shared(n)) for n in range(K + 2)))
    return F.get(bounds, F.least("n", F.lit(K + 1)).cast("int"))


def counted_overlaps(classes: DataFrame) -> DataFrame:
    """(node, pivot, shared): each listed class, the smallest class of a list that it is in, and in how many lists they meet."""
    size = F.least("n", F.lit(K)).cast("int")
    postings = classes.select("node", size.alias("size"), needed().alias("needed"), F.explode("sketch").alias("value"))
    common = postings.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1")
    own = Window.partitionBy("node")  # K rows at most
    ranked = postings.join(common, "value").withColumns({"alone": F.col("size") - F.count("*").over(own), "rank": F.row_number().over(own.orderBy("df", "value"))})
    listed = written(ranked.filter("alone + rank - 1 <= size - needed").select("value", "node"), "lists")
    pivot = listed.groupBy("value").agg(F.min("node").alias("pivot"))
    out = written(listed.join(pivot, "value").filter("node > pivot").groupBy("node", "pivot").agg(F.count("*").alias("shared")), "overlaps", FEW_FILES)
    dropped(listed)
    return out


#: Whether the sets of a pair may be, or are, linked: (their sizes, their retained or all members) -> bool.
Test = Callable[[int, int, np.ndarray, np.ndarray], bool]


def common_members(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    place = np.minimum(np.searchsorted(large, small), max(len(large) - 1, 0))
    return small[large[place] == small] if len(large) else small[:0]


def by_sketch(n: int, m: int, a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the union sketch of a pair shows as many shared values as a linked pair's does."""
    if PERCENT * max(n, m) > 100 * min(n, m):
        return False
    both = common_members(a, b)
    if max(n, m) <= K:
        return by_set(n, m, a, b)
    if len(both) < min(fewest_shared(n), fewest_shared(m)):
        return False
    union = np.unique(np.concatenate([a, b]))
    hits = np.searchsorted(both, union[K - 1], "right") if len(union) >= K else len(both)
    return hits >= fewest_of_sample()


def by_set(n: int, m: int, a: np.ndarray, b: np.ndarray) -> bool:
    both = len(common_members(a, b))
    return 100 * both >= PERCENT * (n + m - both)


def overlap_matrix(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of a with all of b, by slabs of the values that both sides hold."""
    u, v = np.concatenate(a), np.concatenate(b)
    values = common_members(np.unique(u), np.unique(v))
    total = np.zeros((len(a), len(b)), dtype=np.float32)
    if not len(values):
        return total
    sides = []
    for flat, parts in ((u, a), (v, b)):
        own, column = np.repeat(np.arange(len(parts)), [len(p) for p in parts]), np.searchsorted(values, flat)
        keep = values[np.minimum(column, len(values) - 1)] == flat
        own, column = own[keep], column[keep]
        order = np.argsort(column, kind="stable")
        sides.append((own[order], column[order], len(parts)))
    for first in range(0, len(values), 1024):
        slabs = []
        for own, column, rows in sides:
            x, y = np.searchsorted(column, [first, first + 1024])
            slab = np.zeros((rows, 1024), dtype=np.float32)
            slab[own[x:y], column[x:y] - first] = 1
            slabs.append(slab)
        total += slabs[0] @ slabs[1].T
    return total


def forest(label: np.ndarray, n: np.ndarray, data: list[np.ndarray], side: np.ndarray, floor: Callable[[np.ndarray, np.ndarray], np.ndarray], test: Test) -> list[tuple[int, int]]:
    """A spanning forest, over parts that label names, of the pairs that pass.

    Pairs are between side 0 and side 1, or within side 0 if that is all there is. ``floor`` gives the least overlap of a pair worth a test.
    """
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1)
    right = right if len(right) else left
    if not len(left) or len(np.unique(label)) < 2:
        return []
    over = overlap_matrix([data[k] for k in left], [data[k] for k in right])
    worth = (over >= floor(n[left][:, None], n[right][None, :])) & (label[left][:, None] != label[right][None, :])
    i, j = np.nonzero(worth)
    order = np.argsort(-over[i, j], kind="stable")
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    out = []
    for a, b in zip(left[i[order]].tolist(), right[j[order]].tolist(), strict=True):
        x, y = root(int(label[a])), root(int(label[b]))
        if x != y and test(int(n[a]), int(n[b]), data[a], data[b]):
            parent[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def sketch_floor(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    bound = np.array([fewest_shared(k) for k in range(K + 2)])
    low = np.minimum(bound[np.minimum(n, K + 1)], bound[np.minimum(m, K + 1)])
    return np.where(PERCENT * np.maximum(n, m) > 100 * np.minimum(n, m), np.inf, low)


def set_floor(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def tested(pairs: DataFrame, members: DataFrame, test: Test) -> DataFrame:
    """Those of pairs (u, v) that pass; members has node, n, data."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = zip(batch.column(2).to_pylist(), batch.column(4).to_pylist(), from_lists(batch.column(3)), from_lists(batch.column(5)), strict=True)
            keep = pa.array([test(n, m, a, b) for n, m, a, b in sizes], pa.bool_())
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["u", "v"]).filter(keep)

    u = members.select(F.col("node").alias("u"), F.col("n").alias("n"), F.col("data").alias("a"))
    v = members.select(F.col("node").alias("v"), F.col("n").alias("m"), F.col("data").alias("b"))
    # what many share comes first, while rows are small
    return pairs.join(v, "v").join(u, "u").select("u", "v", "n", "a", "m", "b").mapInArrow(judge, "u long, v long")


#: Into how many a group's members are dealt where they meet what is known of the group.
SALT = 16


def salted(members: DataFrame, known: DataFrame, by: list[str]) -> DataFrame:
    """members joined with known, a row a group, without a group's members going to one task."""
    salt = F.pmod(F.xxhash64("node"), F.lit(SALT)).cast("int")
    copies = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return members.withColumn("salt", salt).join(copies, [*by, "salt"]).drop("salt")


def blocks_met(members: DataFrame, floor: Callable[[np.ndarray, np.ndarray], np.ndarray], test: Test) -> DataFrame:
    """(u, v): spanning forests of the pairs inside a group that pass and are in different parts; members has node, part (its group), label (its part), n, data.

    A large part has blocks of its own, which never meet each other; the members of small parts share blocks. Blocks hold sets of one band of
    sizes and meet those of the same band and the next one only.
    """
    labels = members.groupBy("part", "label").agg(F.count("*").alias("rows"))
    several = labels.groupBy("part").agg(F.count("*").alias("labels")).filter("labels > 1").select("part")
    known = labels.join(several, "part").select("part", "label", F.when(F.col("rows") >= BLOCK_ROWS // 2, F.col("label")).otherwise(F.lit(-1)).alias("own"))
    band = F.floor(F.log(BAND, F.col("n").cast("double"))).cast("int")
    placed = members.select("node", "part", "label", "n", F.size("data").alias("size"), band.alias("band"))
    placed = written(salted(placed, known, ["part", "label"]).select("node", "part", "label", "n", "size", "own", "band"), "placed", FEW_FILES)
    cells = placed.groupBy("part", "own", "band").agg(F.count("*").alias("rows"), F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("size") / BLOCK_VALUES)).cast("int").alias("blocks"))
    cells = written(cells, "cells", FEW_FILES)
    a, b = (cells.select("part", *(F.col(c).alias(f"{s}_{c}") for c in ("own", "band", "rows", "blocks"))) for s in "ab")
    same = (F.col("a_own") == F.col("b_own")) & (F.col("a_band") == F.col("b_band"))
    first = F.struct("a_own", "a_band") <= F.struct("b_own", "b_band")
    apart = (F.col("a_own") != F.col("b_own")) | (F.col("a_own") == -1)
    met = a.join(b, "part").filter(first & apart & (F.abs(F.col("a_band") - F.col("b_band")) <= 1) & (~same | (F.col("a_rows") > 1)))
    met = met.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("a_blocks") - 1))).withColumn("j", F.explode(F.sequence(F.when(same, F.col("i")).otherwise(F.lit(0)), F.col("b_blocks") - 1)))
    # numbers of tasks; should two get the same, their members meet in vain
    met = met.withColumn("task", F.xxhash64("part", "a_own", "a_band", "i", "b_own", "b_band", "j"))
    lone = same & (F.col("i") == F.col("j"))
    sides = met.select("part", F.col("a_own").alias("own"), F.col("a_band").alias("band"), F.col("i").alias("block"), "task", F.lit(0).alias("side"))
    sides = sides.unionByName(met.filter(~lone).select("part", F.col("b_own").alias("own"), F.col("b_band").alias("band"), F.col("j").alias("block"), "task", F.lit(1).alias("side")))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = salted(placed, cells.select("part", "own", "band", "blocks"), ["part", "own", "band"]).withColumn("block", block)
    dealt = dealt.join(sides, ["part", "own", "band", "block"]).select("task", "side", "node", "label", "n")
    sent = dealt.join(members.select("node", "data"), "node").select("task", "side", "node", "label", "n", "data")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_key(batches):
            side, node, label, n = (rows.column(k).to_numpy() for k in range(1, 5))
            out = forest(label, n, from_lists(rows.column(5)), side, floor, test)
            if out:
                u, v = np.array(out).T
                yield pa.RecordBatch.from_arrays([pa.array(node[u]), pa.array(node[v])], names=["u", "v"])

    found = sent.repartition("task").sortWithinPartitions("task").mapInArrow(compare, "u long, v long")
    found = written(found, "met", FEW_FILES)
    dropped(placed, cells)
    return found


def refined(members: DataFrame, seeds: DataFrame, floor: Callable[[np.ndarray, np.ndarray], np.ndarray], test: Test) -> DataFrame:
    """(u, v) that connect all members (node, part, n, data) of a group which pairs that pass connect; seeds (u, v) are tested first."""
    first = written(tested(seeds, members, test), "seeds", FEW_FILES)
    label = components(first, "u", "v")
    labelled = members.join(label, "node", "left").withColumn("label", F.coalesce("component", "node"))
    return first.unionByName(blocks_met(labelled, floor, test))


def whole_groups(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, part) of every linked node; a part is named by its smallest node."""
    group = components(links, u, v).withColumnRenamed("component", "part")
    return group.unionByName(group.select(F.col("part").alias("node"), "part").distinct())


def full_sets(docs: DataFrame, some: DataFrame, key: str, text: str) -> DataFrame:
    """node, part, n, data: all members of the sets of some (node, mark, part)."""
    texts = docs.select(marked(key, text).alias("mark"), F.col(text).alias("t")).join(some.hint("shuffle_hash"), "mark").select("node", "part", "t")

    def members_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # of one task: rows that repeat id and text
        for rows, raw, at in runs(batches, "t"):
            ids = rows.column(0).to_pylist()
            fresh = [k for k, i in enumerate(ids) if not (i in seen or seen.add(i))]
            if fresh:
                found = [sets(raw[at[k] : at[k + 1]], np.array([0, at[k + 1] - at[k]]))[0] for k in fresh]
                kept = rows.take(pa.array(fresh))
                yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), pa.array([len(s) for s in found], pa.int64()), as_lists(found)], names=["node", "part", "n", "data"])

    return texts.mapInArrow(members_of, "node long, part long, n long, data array<long>")


def linked_nodes(classes: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """(node, part) of every class that is linked with another one."""
    overlaps = counted_overlaps(classes)
    groups = whole_groups(overlaps, "node", "pivot")
    members = written(groups.join(classes.select("node", "n", F.col("sketch").alias("data")), "node"), "members")
    best = overlaps.groupBy(F.col("node").alias("u")).agg(F.max_by("pivot", F.struct(F.col("shared"), -F.col("pivot"))).alias("v"))
    likely = refined(members, best, sketch_floor, by_sketch)
    some = whole_groups(likely).join(classes.select("node", "row.mark"), "node")
    sets_of = written(full_sets(docs, some, key, text), "sets")
    return whole_groups(refined(sets_of, likely, set_floor, by_set))


def grouped(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row for each row of docs: doc, mark, n, head (no_id, doc and mark of the row that its component keeps; null without shingles)."""
    with own_tables():
        sk = written(sketches(docs, key, text), "sketches")
        first = F.min(F.struct(F.col("doc").isNull().alias("no_id"), "doc", "mark", "n", "sketch"))
        some = sk.filter("n > 0").groupBy("set_key").agg(first.alias("x"))
        classes = written(some.select("set_key", F.monotonically_increasing_id().alias("node"), F.struct("x.no_id", "x.doc", "x.mark").alias("row"), "x.n", "x.sketch"), "classes")
        found = linked_nodes(classes, docs, key, text)
        heads = found.join(classes.select("node", "row"), "node").groupBy("part").agg(F.min("row").alias("head"))
        heads = salted(found, heads, ["part"]).select("node", "head")
        named = classes.join(heads, "node", "left").select("set_key", F.coalesce("head", "row").alias("head"))
        out = sk.select("doc", "mark", "n", "set_key").join(named, "set_key", "left").select("doc", "mark", "n", F.when(F.col("n") > 0, F.col("head")).alias("head"))
        return kept_table(out, "grouped")


def stands() -> Column:
    return F.when(F.col("n") > 0, F.col("mark") == F.col("head.mark")).otherwise(F.lit(True))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, kept."""
    component = F.when(F.col("n") > 0, F.col("head.doc")).otherwise(F.col("doc"))
    return grouped(docs, key, text).select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), stands().alias("kept"))


def op4_near_dup(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return near_duplicates(read(spark, sf_dir, "documents"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of docs of each component, with all its columns, whether it has an id or not.

    Texts without shingles are near-duplicates of nothing: they leave one row of each id and text, and all that have no id.
    """
    kept = grouped(docs, "doc_id", "text").filter(stands() & ((F.col("n") > 0) | F.col("doc").isNotNull()))
    kept = kept.select(F.col("mark").alias("__kept")).distinct()
    one = docs.withColumn("__mark", marked("doc_id", "text")).join(kept.hint("shuffle_hash"), F.col("__mark") == F.col("__kept"), "left_semi")
    blank = ~F.coalesce(F.col("text").rlike(r"[^\x09-\x0D\x20]"), F.lit(False))
    return one.dropDuplicates(["__mark"]).drop("__mark").unionByName(docs.filter(F.col("doc_id").isNull() & blank))
