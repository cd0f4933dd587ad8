"""Merge on read: a log of timestamped writes and deletes becomes current rows.

A log has the table's columns and some of these beside them:

    _writetime  long, microseconds; required
    _op         insert (the default), update, delete_row, delete_partition, delete_range, delete_columns
    _ttl        seconds that a write lives; null: the table's default, or for ever
    _set        names of the columns a write sets; null: all of them. A set column may be null, which deletes it
    _from, _to  of delete_range: the first clustering column from _from (included; null: the least) to _to (excluded; null: no end)

Cells of a row merge one by one: the newest write of each wins; of writes at one time, a delete wins, then the larger value.
Deletes of a partition, a range or a row end cells that are not newer. A newest cell past its time to live reads as absent,
and still hides older ones. A row is there if a write that was an insert left a live marker or any regular cell
is live. Static columns belong to the partition and are repeated on its rows; a partition with nothing but static cells
reads as one row without a clustering key.

The log is read once and shuffled once, by partition key: rows are grouped within that partitioning, and what the partition says for
all of them - its deletes, static columns and range deletes - reaches them by windows over it. Range deletes are first cut into ranges
that don't overlap, by a sweep, so a row meets one of them at most. A partition's rows are sorted in one task, which
spills. Filters on the partition key go below the merge, others stay above it. Table columns may have any name that
doesn't begin with "__merge".
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import LAST_MODIFIED, TableSpec

WRITETIME, OP, TTL, SET, FROM, TO = "_writetime", "_op", "_ttl", "_set", "_from", "_to"
WRITES = ("insert", "update")
NEVER = -(1 << 63)


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def completed(log: DataFrame, spec: TableSpec, overrides: dict[str, str] | None = None) -> DataFrame:
    """log with every column that the merge reads; overrides name the log's own columns for some of the marks."""
    for mark, name in (overrides or {}).items():
        log = log.withColumn(mark, col(name))
    have = set(log.columns)
    new: dict[str, Column] = {}
    if WRITETIME not in have:
        raise ValueError(f"a log needs {WRITETIME}")
    new[OP] = F.coalesce(F.col(OP), F.lit("insert")) if OP in have else F.lit("insert")
    if TTL not in have:
        new[TTL] = F.lit(None).cast("int")
    if SET not in have:
        new[SET] = F.lit(None).cast("array<string>")
    for c in spec.columns:
        if c.name not in have:
            new[c.name] = F.lit(None).cast(spec.struct_type()[c.name].dataType)
    kind = log.schema[WRITETIME].dataType
    if isinstance(kind, T.TimestampNTZType):  # without the session's time zone
        new[WRITETIME] = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), col(WRITETIME))
    elif isinstance(kind, T.TimestampType):
        new[WRITETIME] = F.unix_micros(col(WRITETIME))
    return log.withColumns(new) if new else log


def expiry(spec: TableSpec) -> Column:
    """Second at which a write's cells stop living; null: never."""
    ttl = F.coalesce(F.col(TTL).cast("long"), F.lit(spec.default_ttl or None).cast("long"))
    return F.when(ttl > 0, F.floor(F.col(WRITETIME) / 1_000_000) + ttl)


def order_of(value: Column, kind: T.DataType) -> Column:
    """What breaks ties between values; maps don't order, so their sorted entries do."""
    return F.array_sort(F.map_entries(value)) if isinstance(kind, T.MapType) else value


def sets(name: str) -> Column:
    """Whether a write sets a column."""
    return (F.col(SET).isNull() & F.col(OP).isin(*WRITES)) | F.array_contains(F.col(SET), name)


def rank_of(log: DataFrame, name: str, spec: TableSpec) -> Column:
    """What the newest write of a column is the largest by; null for writes that don't set it."""
    value = col(name)
    deletes = (F.col(OP) == "delete_columns") | value.isNull()
    return F.when(sets(name), F.struct(F.col(WRITETIME).alias("at"), deletes.alias("gone"), order_of(value, log.schema[name].dataType).alias("value"), expiry(spec).alias("until")))


def newest(log: DataFrame, name: str, spec: TableSpec) -> Column:
    """struct<at, until, gone, value> of the newest write that sets a column; null if none does."""
    value = col(name)
    deletes = (F.col(OP) == "delete_columns") | value.isNull()
    cell = F.struct(F.col(WRITETIME).alias("at"), expiry(spec).alias("until"), deletes.alias("gone"), value.alias("value"))
    return F.max_by(F.when(sets(name), cell), rank_of(log, name, spec))


def newest_rank(log: DataFrame, name: str, spec: TableSpec) -> Column:
    return F.max(rank_of(log, name, spec))


def live(cell: Column, deleted: Column, now: int) -> Column:
    """Whether a newest cell is there: set, not deleted, not expired."""
    ok = cell.isNotNull() & ~cell["gone"] & (cell["at"] > deleted) & (cell["until"].isNull() | (cell["until"] > now))
    return F.coalesce(ok, F.lit(False))


def swept(ranges: list[tuple[object, object, int]]) -> Iterator[tuple[object, object, int]]:
    """Ranges (from, to, at) in order of from, null first, as ranges that don't overlap, each with the last time that covers it."""
    active: list[tuple[int, int, object]] = []  # by falling time
    at: object = None
    low_open = True  # the place reached is before all values

    def until(stop: object, none: bool) -> Iterator[tuple[object, object, int]]:
        """What the active ranges cover from the place reached to stop, or to the end if none."""
        nonlocal at, low_open
        while active:
            _, _, end = active[0]
            if end is not None and not low_open and end <= at:
                heappop(active)
                continue
            to = end if none or (end is not None and end < stop) else stop
            if low_open or to is None or at < to:
                yield (None if low_open else at, to, -active[0][0])
            if to is None or (not none and to == stop):
                if to is None:
                    active.clear()
                return
            at, low_open = to, False

    for k, (start, end, time) in enumerate(ranges):
        if start is not None:
            yield from until(start, False)
            at, low_open = start, False
        if end is None or start is None or start < end:
            heappush(active, (-time, k, end))
    yield from until(None, True)


def range_segments(log: DataFrame, spec: TableSpec) -> DataFrame:
    """(partition key, _from, _to, _writetime) of range deletes that don't overlap, a row for each stretch and the last delete that covers it."""
    keys = [col(k) for k in spec.partition_key]
    some = log.filter(F.col(OP) == "delete_range").select(*keys, FROM, TO, F.col(WRITETIME).cast("long").alias(WRITETIME))
    names, width = some.columns, len(keys)

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held, schema = None, [], None

        def out() -> Iterator[pa.RecordBatch]:
            found = list(swept(held))
            if found:
                columns = [[x] * len(found) for x in held_key] + [list(c) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], names=names)

        for batch in batches:
            schema = batch.schema
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key, rest = row[:width], row[width:]
                if key != held_key:
                    if held:
                        yield from out()
                    held_key, held = key, []
                held.append(rest)
        if held:
            yield from out()

    return some.repartition(*keys).sortWithinPartitions(*keys, FROM).mapInArrow(sweep, some.schema)


@dataclass(frozen=True)
class Live:
    """What a merge knows of a current row, for columns that features add.

    times and values are of the live regular and static columns by name, null where there is none; inserted is the
    time of the row's marker. Times are microseconds.
    """

    spec: TableSpec
    times: dict[str, Column]
    values: dict[str, Column]
    inserted: Column

    def last(self, names: list[str], *more: Column) -> Column:
        times = [*(self.times[n] for n in names), *more]
        return F.greatest(*times) if len(times) > 1 else times[0] if times else F.lit(None).cast("long")


@dataclass(frozen=True)
class Feature:
    """A column that a read adds to the table's own: its name, and what it holds for each row."""

    name: str
    value: Callable[[Live], Column]


def last_modified_feature(name: str = LAST_MODIFIED) -> Feature:
    """The newest write time of a row's live regular cells, else of its marker and its partition's static cells."""
    return Feature(name, lambda row: F.timestamp_micros(F.coalesce(row.last(row.spec.regulars), row.last(row.spec.statics, row.inserted))))


def merge_on_read(log: DataFrame, spec: TableSpec, now: int = 0, columns: list[str] | None = None, features: tuple[str | Feature, ...] = (), ranges: bool | None = None, last_modified: str = LAST_MODIFIED, **marks: str) -> DataFrame:
    """Current rows of a log. now: the reference time of expiry in epoch seconds, one for the whole read.

    columns: which to return, all by default. features: further columns, in order; "last_modified_timestamp" stands for
    last_modified_feature(last_modified). ranges: whether the log has range deletes;
    by default it may if it has a column _from. marks: _writetime="ts" and the like name a log's own columns.
    """
    if clash := [n for n in spec.names if n.startswith("__merge")]:
        raise ValueError(f"columns {clash} have names that a merge uses itself")
    log = completed(log, spec, marks)
    if ranges is None:
        ranges = FROM in log.columns
    ranges = ranges and bool(spec.clustering_key)
    partition, clustering = spec.partition_key, spec.clustering_key
    kept = [c.name for c in spec.columns if columns is None or c.name in columns]
    added = [f if isinstance(f, Feature) else last_modified_feature(last_modified) for f in features if isinstance(f, Feature) or f == LAST_MODIFIED]
    every = lambda names: reduce(lambda a, b: a & b, [col(k).isNotNull() for k in names])

    said = log.filter(every(partition))
    if ranges:
        said = said.filter(F.col(OP) != "delete_range")
    marker = F.struct(F.col(WRITETIME).alias("at"), expiry(spec).alias("until"), F.lit(False).alias("gone"))
    inserts = F.col(OP) == "insert"
    if clustering:  # a write without a whole clustering key is about the partition only
        said = said.withColumns({k: F.when(every(clustering), col(k)) for k in clustering})
    rows = said.repartition(*map(col, partition)).groupBy(*map(col, spec.primary_key)).agg(
        *[newest(log, n, spec).alias(n) for n in spec.regulars],
        *[F.struct(newest(log, n, spec).alias("cell"), newest_rank(log, n, spec).alias("rank")).alias(n) for n in spec.statics],
        F.max_by(F.when(inserts, marker), F.when(inserts, F.struct(F.col(WRITETIME), expiry(spec)))).alias("__merge_marker"),
        F.max(F.when(F.col(OP) == "delete_row", F.col(WRITETIME))).alias("__merge_row"),
        F.max(F.when(F.col(OP) == "delete_partition", F.col(WRITETIME))).alias("__merge_gone"),
    )
    whole = Window.partitionBy(*map(col, partition))
    shared = {"__merge_gone": F.max("__merge_gone").over(whole)}
    shared |= {n: F.max_by(col(n)["cell"], col(n)["rank"]).over(whole) for n in spec.statics}
    rows = rows.withColumns(shared)
    if ranges:
        first = clustering[0]
        segments = range_segments(log, spec).select(*map(col, partition), F.col(FROM).alias(first), F.struct(TO, WRITETIME).alias("__merge_segment"))
        inorder = whole.orderBy(col(first).asc_nulls_first(), F.col("__merge_segment").isNull())
        met = rows.withColumn("__merge_a_row", F.lit(True)).unionByName(segments, allowMissingColumns=True)
        last = F.last("__merge_segment", ignorenulls=True).over(inorder)
        rows = met.withColumn("__merge_segment", last).filter("__merge_a_row").drop("__merge_a_row")
        covered = F.col("__merge_segment")[TO].isNull() | (col(first) < F.col("__merge_segment")[TO])
        ended = F.when(covered, F.col("__merge_segment")[WRITETIME])
    deleted = F.greatest(F.lit(NEVER), F.col("__merge_row"), F.col("__merge_gone"), *([ended] if ranges else []))
    rows = rows.withColumn("__merge_deleted", deleted)
    a_row = every(clustering) if clustering else F.lit(True)
    alive = {n: live(col(n), F.col("__merge_deleted"), now) for n in spec.regulars}
    marked = live(F.col("__merge_marker"), F.col("__merge_deleted"), now)
    rows = rows.withColumn("__merge_live", a_row & reduce(lambda a, b: a | b, [marked, *alive.values()]))
    there = {n: live(col(n), F.coalesce("__merge_gone", F.lit(NEVER)), now) for n in spec.statics}
    if spec.statics:
        # a partition of nothing but live static cells shows as one row
        number = F.row_number().over(whole.orderBy(*map(col, clustering or partition)))
        rows = rows.withColumns({"__merge_number": number, "__merge_any": F.max("__merge_live").over(whole)})
        lone = ~F.col("__merge_any") & (F.col("__merge_number") == 1) & reduce(lambda a, b: a | b, there.values())
        rows = rows.filter(F.col("__merge_live") | lone)
    else:
        rows = rows.filter("__merge_live")
    shown_row = F.col("__merge_live")
    out = {k: col(k) for k in partition} | {k: F.when(shown_row, col(k)) for k in clustering}
    out |= {n: F.when(there[n], col(n)["value"]) for n in spec.statics} | {n: F.when(shown_row & alive[n], col(n)["value"]) for n in spec.regulars}
    if not spec.statics:
        out |= {k: col(k) for k in clustering}
    shown = [out[n].alias(n) for n in kept]
    if added:
        times = {n: F.when(shown_row & alive[n], col(n)["at"]) for n in spec.regulars} | {n: F.when(there[n], col(n)["at"]) for n in spec.statics}
        row = Live(spec, times, {n: out[n] for n in (*spec.regulars, *spec.statics)}, F.when(shown_row & marked, F.col("__merge_marker")["at"]))
        shown += [f.value(row).alias(f.name) for f in added]
    return rows.select(*shown)


def merge_elements(elements: DataFrame, keys: list[str], kind: str, now: int = 0) -> DataFrame:
    """Unfrozen collections from their elements' log: keys, _element (path), value, _writetime, optional _ttl and _deleted.

    A row with a null _element and _deleted set ends all elements of the collection that are not newer. The newest write of
    each element wins. kind: set (paths), list (values by path), map (value by path) or udt (value by field name, as a map).
    Elements come in order of their paths; a collection without live elements is left out.
    """
    for name, value in ((TTL, F.lit(None).cast("int")), ("_deleted", F.lit(False)), ("value", F.lit(None).cast("string"))):
        if name not in elements.columns:
            elements = elements.withColumn(name, value)
    by = [col(k) for k in keys]
    ttl = F.col(TTL).cast("long")
    until = F.when(ttl > 0, F.floor(F.col(WRITETIME) / 1_000_000) + ttl)
    cleared = elements.filter(F.col("_element").isNull() & F.col("_deleted")).groupBy(*by).agg(F.max(WRITETIME).alias("_cleared"))
    cell = F.struct(F.col(WRITETIME).alias("at"), until.alias("until"), F.col("_deleted").alias("gone"), F.col("value"))
    rank = F.struct(F.col(WRITETIME), F.col("_deleted"), order_of(F.col("value"), elements.schema["value"].dataType))
    last = elements.filter(F.col("_element").isNotNull()).groupBy(*by, "_element").agg(F.max_by(cell, rank).alias("_cell"))
    last = last.join(cleared, keys, "left").filter(live(F.col("_cell"), F.coalesce("_cleared", F.lit(NEVER)), now))
    pairs = F.array_sort(F.collect_list(F.struct(F.col("_element").alias("path"), F.col("_cell")["value"].alias("value"))))
    if kind == "set":
        value = F.transform(pairs, lambda x: x["path"])
    elif kind == "list":
        value = F.transform(pairs, lambda x: x["value"])
    else:
        value = F.map_from_entries(pairs)
    return last.groupBy(*by).agg(value.alias("value"))


def union_runs(*runs: DataFrame) -> DataFrame:
    """Logs of several runs or replicas as one; columns that some lack are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), runs)


def only_current_replica(log: DataFrame, repaired: str, primary: str) -> DataFrame:
    """Rows of repaired runs from the primary replica only; the others have them too."""
    return log.filter(~F.coalesce(col(repaired), F.lit(False)) | F.coalesce(col(primary), F.lit(False)))
