"""One query for each operator over the test tables, with the same result in SQL where SQL can say it."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.convert import inet_bytes, nanos_of_day, stored_date, timeuuid_from_millis
from .functions.tokens import key_bytes, murmur3_token, random_token, with_token
from .operators.merge import merge_elements, merge_on_read, only_current_replica, union_runs
from .operators.sizes import index_entries, partition_sizes, run_summaries, with_compressed
from .plans.consistency import failed_ranges, ranked_replicas, topology_changes, write_check
from .plans.filters import EqualTo, In, filtered_keys, key_product, key_values, keys_frame, split_filters
from .plans.ring import Instance, Ring, parts_of, split_range
from .sources.datasource import register
from .sources.read import read_replicas, read_table, replica_log
from .sources.write import bulk_write, bundles, log_of, normalized, write_log
from .spec import LAST_MODIFIED, Replication, TableSpec

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

EVENTS = TableSpec.of("events", {"user_id": "bigint"}, {"event_type": "text"}, {"event_id": "bigint", "value": "double"})
WITH_STATIC = TableSpec.of("events", {"user_id": "bigint"}, {"event_type": "text"}, {"value": "double"}, {"props": "text"})
LINES = TableSpec.of("lineitem", {"l_orderkey": "bigint"}, {"l_linenumber": "int"}, {"l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_returnflag": "text"})
TURNS = TableSpec.of("conversations", {"conv_id": "bigint", "turn": "bigint"}, {}, {"role": "text", "text": "text"})
#: Reference time of expiry, and the least write time, as the test data has them.
MICROS = "epoch_us(ts)"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(name: str) -> F.Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(name))


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("_writetime", micros("ts")).drop("ts")


# ---- scans, projections and filters ----


@query("scan_project", "select l_orderkey, l_linenumber, l_extendedprice from lineitem where l_quantity > 45")
def scan_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").filter("l_quantity > 45").select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("project_keys_only", "select distinct user_id, event_type from events")
def project_keys_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_on_read(event_log(spark, sf_dir), EVENTS, columns=["user_id", "event_type"])


@query("count_only", "select count(*) as n from (select distinct user_id, event_type from events)")
def count_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_on_read(event_log(spark, sf_dir), EVENTS).agg(F.count("*").alias("n"))


@query("pk_eq", "select event_type, arg_max(value, ts) as value from events where user_id = 7 group by event_type")
def pk_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    pushed, _ = split_filters([EqualTo("USER_ID", 7)], EVENTS)
    return filtered_keys(merge_on_read(event_log(spark, sf_dir), EVENTS), pushed, EVENTS).select("event_type", "value")


@query("pk_in_cartesian", "select conv_id, turn, role, length(text) as n from conversations where conv_id in (1, 2, 3, 5, 8) and turn in (0, 1, 2)")
def pk_in_cartesian(spark: SparkSession, sf_dir: str) -> DataFrame:
    pushed, _ = split_filters([In("conv_id", (1, 2, 3, 5, 8)), In("turn", (0, 1, 2))], TURNS)
    return filtered_keys(table(spark, sf_dir, "conversations"), pushed, TURNS).select("conv_id", "turn", "role", F.length("text").alias("n"))


@query("pk_key_set", "select conv_id, turn, role from conversations where conv_id in (1, 2, 3, 5, 8) and turn in (0, 1, 2)")
def pk_key_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = key_product(list(key_values([In("conv_id", (1, 2, 3, 5, 8)), In("turn", (0, 1, 2))], TURNS).values()))
    return keys_frame(table(spark, sf_dir, "conversations"), keys, TURNS).select("conv_id", "turn", "role")


@query("partial_key_filter", "select count(*) as n, sum(turn)::bigint as turns from conversations where conv_id = 3")
def partial_key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pushed, left = split_filters([EqualTo("conv_id", 3)], TURNS)
    assert not pushed and len(left) == 1
    return table(spark, sf_dir, "conversations").filter("conv_id = 3").agg(F.count("*").alias("n"), F.sum("turn").alias("turns"))


@query("post_scan_filter", "select user_id, event_type, value from (select user_id, event_type, arg_max(value, ts) as value from events group by all) where event_type like 'p%' and value > 50")
def post_scan_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_on_read(event_log(spark, sf_dir), EVENTS).filter("event_type like 'p%' and value > 50").select("user_id", "event_type", "value")


# ---- merge on read ----


@query("lww_merge", "select user_id, event_type, arg_max(event_id, ts) as event_id, arg_max(value, ts) as value from events group by all")
def lww_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_on_read(event_log(spark, sf_dir), EVENTS)


@query(
    "merged_revenue",
    """with m as (select l_orderkey, l_linenumber, arg_max(l_extendedprice, (l_shipdate, l_extendedprice)) as p, arg_max(l_discount, (l_shipdate, l_discount)) as d, arg_max(l_returnflag, (l_shipdate, l_returnflag)) as l_returnflag
    from lineitem group by all) select l_returnflag, count(*) as n, round(sum(p * (1 - d)), 2) as revenue from m group by l_returnflag""",
)
def merged_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merge_on_read(table(spark, sf_dir, "lineitem"), LINES, _writetime="l_shipdate")
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("lww_last_modified", f"select user_id, event_type, arg_max(value, ts) as value, max({MICROS}) as modified from events group by all")
def lww_last_modified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merge_on_read(event_log(spark, sf_dir), EVENTS, features=(LAST_MODIFIED,), last_modified="modified")
    return rows.select("user_id", "event_type", "value", F.unix_micros("modified").alias("modified"))


@query("k_way_merge", "select user_id, event_type, arg_max(value, ts) as value, arg_max(event_id, ts) filter (event_id % 3 > 0) as event_id from events group by all")
def k_way_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir)
    first = log.filter("event_id % 3 = 0").drop("event_id").withColumn("_set", F.array(F.lit("value")))
    return merge_on_read(union_runs(first, log.filter("event_id % 3 = 1"), log.filter("event_id % 3 = 2")), EVENTS).select("user_id", "event_type", "value", "event_id")


@query(
    "partial_upsert",
    """select user_id, event_type, arg_max(value, ts) filter (event_id % 2 = 0) as value, arg_max(event_id, ts) filter (event_id % 2 = 1) as event_id
    from events group by all""",
)
def partial_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = F.when(F.col("event_id") % 2 == 0, F.array(F.lit("value"))).otherwise(F.array(F.lit("event_id")))
    return merge_on_read(event_log(spark, sf_dir).withColumn("_set", sets).withColumn("_op", F.lit("update")), EVENTS).select("user_id", "event_type", "value", "event_id")


@query(
    "partition_tombstone",
    """with d as (select user_id, max(ts) as gone from events where event_type = 'error' group by user_id)
    select e.user_id, event_type, arg_max(value, ts) as value from events e left join d on e.user_id = d.user_id where event_type <> 'error' and (gone is null or ts > gone) group by all""",
)
def partition_tombstone(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir).withColumn("_op", F.when(F.col("event_type") == "error", "delete_partition").otherwise("insert"))
    return merge_on_read(log, EVENTS).select("user_id", "event_type", "value")


@query(
    "row_tombstone",
    """with d as (select user_id, event_type, max(ts) as gone from events where event_id % 5 = 0 group by all)
    select e.user_id, e.event_type, arg_max(value, ts) as value from events e left join d on e.user_id = d.user_id and e.event_type = d.event_type
    where event_id % 5 > 0 and (gone is null or ts > gone) group by all""",
)
def row_tombstone(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir).withColumn("_op", F.when(F.col("event_id") % 5 == 0, "delete_row").otherwise("insert"))
    return merge_on_read(log, EVENTS).select("user_id", "event_type", "value")


@query(
    "range_tombstone",
    """with d as (select user_id, ts as gone from events where event_id % 37 = 0), m as (
      select user_id, event_type, arg_max(value, ts) as value, max(ts) as last from events where event_id % 37 > 0 group by all)
    select user_id, event_type, value from m where not exists (
      select 1 from d where d.user_id = m.user_id and m.event_type >= 'c' and m.event_type < 'q' and d.gone >= m.last)""",
)
def range_tombstone(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = F.col("event_id") % 37 == 0
    log = event_log(spark, sf_dir).withColumns({"_op": F.when(gone, "delete_range").otherwise("insert"), "_from": F.when(gone, "c"), "_to": F.when(gone, "q")})
    return merge_on_read(log, EVENTS).select("user_id", "event_type", "value")


@query("cell_tombstone", "select user_id, event_type, arg_max(event_id, ts) as event_id, arg_max_null(case when event_id % 3 > 0 then value end, ts) as value from events group by all")
def cell_tombstone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_on_read(event_log(spark, sf_dir).withColumn("value", F.when(F.col("event_id") % 3 > 0, F.col("value"))), EVENTS)


@query(
    "ttl_expiry",
    f"""with now as (select max({MICROS}) // 1000000 as s from events), l as (select user_id, event_type, value, ts, {MICROS} // 1000000 + (event_id % 30 + 1) * 86400 as until from events),
    m as (select user_id, event_type, arg_max(value, ts) as value, arg_max(until, ts) as until from l group by all)
    select user_id, event_type, value from m, now where until > s""",
)
def ttl_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir).withColumn("_ttl", ((F.col("event_id") % 30 + 1) * 86400).cast("int"))
    now = log.agg(F.floor(F.max("_writetime") / 1_000_000)).first()[0]
    return merge_on_read(log, EVENTS, now or 0).select("user_id", "event_type", "value")


@query(
    "static_broadcast",
    """with s as (select user_id, arg_max(props, ts) as props from events group by user_id), m as (select user_id, event_type, arg_max(value, ts) as value from events group by all)
    select m.user_id, event_type, value, props from m join s on m.user_id = s.user_id""",
)
def static_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_on_read(event_log(spark, sf_dir), WITH_STATIC).select("user_id", "event_type", "value", "props")


@query(
    "static_only_partitions",
    """with s as (select user_id, arg_max(props, ts) as props from events group by user_id), m as (select user_id, event_type, arg_max(value, ts) as value from events where user_id % 2 = 0 group by all)
    select s.user_id, event_type, value, props from s left join m on m.user_id = s.user_id""",
)
def static_only_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir)
    statics = log.filter("user_id % 2 = 1").select("user_id", "props", "_writetime").withColumns({"_op": F.lit("update"), "_set": F.array(F.lit("props"))})
    return merge_on_read(union_runs(log.filter("user_id % 2 = 0"), statics), WITH_STATIC).select("user_id", "event_type", "value", "props")


@query("pk_only_rows", "select distinct user_id, event_type, null::double as value from events")
def pk_only_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_on_read(event_log(spark, sf_dir).withColumn("value", F.lit(None).cast("double")).withColumn("event_id", F.lit(None).cast("long")), EVENTS).select("user_id", "event_type", "value")


@query("update_only_rows", "select user_id, event_type, value from (select user_id, event_type, arg_max_null(case when event_id % 2 = 0 then value end, ts) as value from events group by all) where value is not null")
def update_only_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a marker go when their only cell is deleted."""
    log = event_log(spark, sf_dir).withColumns({"value": F.when(F.col("event_id") % 2 == 0, F.col("value")), "_op": F.lit("update"), "_set": F.array(F.lit("value"))})
    return merge_on_read(log, EVENTS).select("user_id", "event_type", "value")


@query(
    "repaired_dedup",
    """select user_id, event_type, arg_max(value, ts) as value, count(*) as copies from (select * from events union all select * from events where event_id % 4 > 0) group by all""",
)
def repaired_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir).withColumn("repaired", F.col("event_id") % 4 == 0)
    both = log.withColumn("primary", F.lit(True)).unionByName(log.withColumn("primary", F.lit(False)))
    kept = only_current_replica(both, "repaired", "primary")
    copies = kept.groupBy("user_id", "event_type").agg(F.count("*").alias("copies"))
    return merge_on_read(kept, EVENTS).select("user_id", "event_type", "value").join(copies, ["user_id", "event_type"])


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir)
    return log.select("user_id", F.col("event_type").alias("_element"), F.round("value", 3).alias("value"), "_writetime", (F.col("event_id") % 4 == 0).alias("_deleted"))


LIVE_ELEMENTS = "select user_id, event_type as k, round(arg_max(value, ts), 3) as v from events group by all having arg_max(event_id, ts) % 4 > 0"


@query("set_merge", f"select user_id, string_agg(k, ',' order by k) as members from ({LIVE_ELEMENTS}) group by user_id")
def set_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_elements(elements(spark, sf_dir), ["user_id"], "set").select("user_id", F.array_join("value", ",").alias("members"))


@query("map_merge", f"select user_id, count(*) as n, round(sum(v), 2) as total, max(k) as last from ({LIVE_ELEMENTS}) group by user_id")
def map_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = merge_elements(elements(spark, sf_dir), ["user_id"], "map")
    total = F.aggregate(F.map_values("value"), F.lit(0.0), lambda a, x: a + x)
    return merged.select("user_id", F.size("value").cast("long").alias("n"), F.round(total, 2).alias("total"), F.array_max(F.map_keys("value")).alias("last"))


@query("list_merge", f"select user_id, count(*) as n, round(arg_min(v, k), 3) as first from ({LIVE_ELEMENTS}) group by user_id")
def list_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_elements(elements(spark, sf_dir), ["user_id"], "list").select("user_id", F.size("value").cast("long").alias("n"), F.element_at("value", 1).alias("first"))


@query(
    "collection_clear",
    """with c as (select user_id, max(ts) as gone from events where event_type = 'error' group by user_id)
    select e.user_id, count(distinct event_type) as n from events e left join c on c.user_id = e.user_id where event_type <> 'error' and (gone is null or ts > gone) group by e.user_id""",
)
def collection_clear(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir)
    clear = F.col("event_type") == "error"
    one = log.select("user_id", F.when(~clear, F.col("event_type")).alias("_element"), "value", "_writetime", clear.alias("_deleted"))
    return merge_elements(one, ["user_id"], "set").select("user_id", F.size("value").cast("long").alias("n"))


# ---- sizes and runs ----


@query("partition_size", "select user_id, event_id % 3 as run, sum(24 + strlen(event_type))::bigint as uncompressed, cast(round(sum(8 + strlen(event_type) + 8 + 8) * 0.5) as bigint) as compressed from events group by all")
def partition_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").withColumn("run", F.col("event_id") % 3)
    ratios = spark.createDataFrame([(0, 0.5), (1, 0.5), (2, 0.5)], "run long, ratio double")
    return partition_sizes(log, EVENTS, "run", ratios)


@query(
    "partition_index",
    """with s as (select event_id % 3 as run, user_id as token, user_id, sum(24 + strlen(event_type)) as size from events group by all)
    select run, user_id, size::bigint as size, (sum(size) over (partition by run order by token, user_id))::bigint as "end", (sum(size) over (partition by run order by token, user_id) - size)::bigint as start from s""",
)
def partition_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").withColumns({"run": F.col("event_id") % 3, "token": F.col("user_id")})
    return index_entries(log, EVENTS, "run").select("run", "user_id", "size", "end", "start")


@query(
    "compressed_proration",
    """select o_orderkey as k, case when e // 100 = s // 100 and true then round_even((e - s) / 100.0 * 60, 0)::bigint
    else (round_even((100 - s % 100) / 100.0 * 60, 0) + greatest((e - 1) // 100 - s // 100 - 1, 0) * 60 + round_even((e - ((e - 1) // 100) * 100) / 100.0 * 60, 0))::bigint end as compressed
    from (select o_orderkey, o_orderkey % 250 as s, o_orderkey % 250 + 120 as e from orders)""",
)
def compressed_proration(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 250).alias("s"), (F.col("o_orderkey") % 250 + 120).alias("e"), F.array_repeat(F.lit(60), 5).alias("chunks"))
    return with_compressed(index, "s", "e", 100, "chunks").select(F.col("o_orderkey").alias("k"), "compressed")


@query("run_summary", "select event_id % 4 as run, min(user_id) as first_token, max(user_id) as last_token, count(*) as rows from events group by 1")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summaries(table(spark, sf_dir, "events").withColumns({"run": F.col("event_id") % 4, "token": F.col("user_id")}), "run")


@query("row_json", """select user_id, '{"user_id":' || user_id || ',"event_type":"' || event_type || '","event_id":' || event_id || '}' as json from (select user_id, event_type, arg_max(event_id, ts) as event_id from events group by all)""")
def row_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merge_on_read(event_log(spark, sf_dir), EVENTS)
    return rows.select("user_id", F.to_json(F.struct("user_id", "event_type", "event_id")).alias("json"))


# ---- tokens and rings ----

NODES = [Instance(t, f"n{k}", f"dc{k % 2 + 1}", "DOWN" if k == 5 else "UP", "MOVING" if k == 2 else "NORMAL") for k, t in enumerate((-6, -4, -1, 2, 5, 8))]
RING_SQL = "(values (-6, 'n0', 0), (-4, 'n1', 0), (-1, 'n2', 1), (2, 'n3', 0), (5, 'n4', 0), (8, 'n5', 2)) i(token, node, priority)"
OWNED_SQL = f"""with i as (select *, row_number() over (order by token) - 1 as k from {RING_SQL}),
r as (select a.k, a.token as lower, b.token as upper from i a join i b on b.k = (a.k + 1) % 6 where a.token < b.token union all select 5, 8, 9223372036854775807 union all select 5, -9223372036854775808, -6),
t as (select lower, upper, i.node, i.priority from r join i on i.k in ((r.k + 1) % 6, (r.k + 2) % 6, (r.k + 3) % 6))"""


def ring() -> Ring:
    return Ring(NODES, Replication("SimpleStrategy", {"replication_factor": 3}))


def _hash_sql(table: str, columns: str, key: list[str]) -> str:
    """The token of key bytes (SQL texts of each byte) in steps of 64-bit arithmetic, for keys of 8 and of 16 to 23 bytes."""
    word = 1 << 64
    c1, c2 = 0x87C37B91114253D5, 0x4CF5AD432745937F
    big = lambda x: f"'{x}'::uhugeint"
    mul = lambda x, c: f"(({x}) * {big(c)}) % {big(word)}"
    xor = lambda a, b: f"xor(({a})::ubigint, ({b})::ubigint)::uhugeint"
    plus = lambda a, b: f"(({a}) + ({b})) % {big(word)}"
    turn = lambda x, r: f"((({x}) * {big(1 << r)}) % {big(word)} + ({x}) // {big(1 << (64 - r))})"
    lane = lambda some: " + ".join(f"({b})::uhugeint * {big(1 << (8 * i))}" for i, b in enumerate(some))
    tail = big(0)
    for i, b in enumerate(key[len(key) // 16 * 16 :]):  # as signed bytes
        tail = xor(tail, f"case when ({b}) < 128 then ({b})::uhugeint * {big(1 << (8 * i))} else {big(word)} - (256 - ({b}))::uhugeint * {big(1 << (8 * i))} end")
    steps = [("h1", big(0)), ("h2", big(0))]
    if len(key) >= 16:
        steps += [("m1", mul(lane(key[:8]), c1)), ("h1", mul(turn("m1", 31), c2)), ("h1", plus(turn("h1", 27), "h2")), ("h1", plus(mul("h1", 5), big(0x52DCE729)))]
        steps += [("m2", mul(lane(key[8:16]), c2)), ("h2", mul(turn("m2", 33), c1)), ("h2", plus(turn("h2", 31), "h1")), ("h2", plus(mul("h2", 5), big(0x38495AB5)))]
    steps += [("m1", mul(tail, c1)), ("h1", xor("h1", mul(turn("m1", 31), c2))), ("h1", xor("h1", len(key))), ("h2", xor("h2", len(key))), ("h1", plus("h1", "h2")), ("h2", plus("h2", "h1"))]
    for h in ("h1", "h2"):
        for c in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            steps += [(h, xor(h, f"{h} // {big(1 << 33)}")), (h, mul(h, c))]
        steps.append((h, xor(h, f"{h} // {big(1 << 33)}")))
    steps.append(("h1", plus("h1", "h2")))
    seen: set[str] = set()
    out = f"select * from {table}"
    for name, expr in steps:
        out = f"select * {'replace' if name in seen else ','} {f'({expr} as {name})' if name in seen else f'{expr} as {name}'} from ({out})"
        seen.add(name)
    signed = f"case when h1 >= {big(1 << 63)} then (h1::hugeint - '{word}'::hugeint) else h1::hugeint end::bigint"
    return f"select {columns}, {signed} as token from ({out})"


def _bytes_sql(column: str) -> list[str]:
    return [f"(({column} >> {8 * k}) & 255)" for k in range(7, -1, -1)]


COMPOSITE = ["0", "8", *_bytes_sql("conv_id"), "0", "0", "8", *_bytes_sql("turn"), "0"]
COMPOSITE_TEXT = "'0008' || printf('%016X', conv_id) || '000008' || printf('%016X', turn) || '00'"


@query("token_hash", _hash_sql("events", "user_id, event_id", _bytes_sql("user_id")))
def token_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_token(table(spark, sf_dir, "events").select("user_id", "event_id"), EVENTS)


@query("token_composite", _hash_sql("conversations", f"conv_id, turn, {COMPOSITE_TEXT} as key", COMPOSITE))
def token_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.hex(key_bytes(TURNS)).alias("key"), murmur3_token(key_bytes(TURNS)).alias("token"))


@query("key_bytes", "select conv_id, turn, '0008' || printf('%016X', conv_id) || '000008' || printf('%016X', turn) || '00' as key from conversations")
def key_bytes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.hex(key_bytes(TURNS)).alias("key"))


@query(
    "token_random",
    """with h as (select o_orderkey, md5_number(chr(0)) as z, md5(unhex(printf('%016X', o_orderkey))) as m from orders), p as (
      select o_orderkey, ('0x' || substr(m, 1, 16))::uhugeint * 18446744073709551616::uhugeint + ('0x' || substr(m, 17, 16))::uhugeint as u from h)
    select o_orderkey, lpad((case when u >= 170141183460469231731687303715884105728::uhugeint then 340282366920938463463374607431768211455::uhugeint - u + 1 else u end)::varchar, 39, '0') as token from p""",
)
def token_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TableSpec.of("orders", {"o_orderkey": "bigint"})
    return table(spark, sf_dir, "orders").select("o_orderkey", random_token(key_bytes(spec)).alias("token"))


@query("token_range_split", "select l, u from (values (0, 3), (3, 6), (6, 9), (9, 11)) r(l, u)")
def token_range_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(r.lower, r.upper) for r in split_range(0, 11, 4)], "l int, u int")


@query("token_range_count", "select ((user_id + 7) // 25) * 25 - 7 as lower, count(*) as n from (select user_id - 1 as user_id from events) group by 1")
def token_range_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "events").select(F.col("user_id").alias("token"))
    parts = split_range(-7, -7 + 25 * 4000, 4000)
    return parts_of(keyed, parts).groupBy("lower").agg(F.count("*").alias("n"))


@query("ring_ranges", f"{OWNED_SQL} select lower, upper, node from t")
def ring_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring().to_df(spark).select("lower", "upper", "node")


@query("replica_split", f"{OWNED_SQL} select lower, upper, node, priority, row_number() over (partition by lower, upper order by priority, node) <= 2 as is_primary from t")
def replica_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_replicas(ring().to_df(spark), 2).select("lower", "upper", "node", "priority", "is_primary")


@query(
    "write_cl_check",
    """select o_custkey as lower, o_custkey + 1 as upper, count(*) filter (o_orderstatus = 'F') as n_succeeded, count(*) filter (o_orderstatus = 'P') as n_pending,
    count(*) filter (o_orderstatus = 'F') >= 2 + count(*) filter (o_orderstatus = 'P') as satisfied from orders group by o_custkey""",
)
def write_cl_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("lower"), (F.col("o_custkey") + 1).alias("upper"), (F.col("o_orderstatus") == "F").alias("succeeded"), (F.col("o_orderstatus") == "P").alias("pending"))
    return write_check(flags, 2)


@query("failed_ranges", f"{OWNED_SQL}, f as (select * from (values (-3, 1, 'n3'), (0, 4, 'n4'), (6, 7, 'n0')) f(a, b, node)), m as (select lower, upper, t.node, count(f.node) as n from t left join f on f.node = t.node and t.lower < f.b and f.a < t.upper group by all) select lower, upper, count(*) filter (n = 0) as succeeded, count(*) filter (n > 0) as failed from m group by all having count(*) filter (n > 0) > 0 and count(*) filter (n = 0) < 2")
def failed_ranges_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    failures = spark.createDataFrame([(-3, 1, "n3"), (0, 4, "n4"), (6, 7, "n0")], "lower long, upper long, node string")
    return failed_ranges(failures, ring().to_df(spark), 2)


@query("topology_change", "select n_nationkey, n_regionkey, case when n_nationkey % 7 = 0 then 'lost' else 'gained' end as change from (select n_nationkey, n_regionkey from nation where n_nationkey % 7 = 0 union all select n_nationkey + 100, n_regionkey from nation where n_nationkey % 7 = 1) where true")
def topology_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey").filter("n_nationkey % 7 <> 1")
    moved = table(spark, sf_dir, "nation").filter("n_nationkey % 7 = 1").select(F.col("n_nationkey") + 100, "n_regionkey")
    return topology_changes(before, before.filter("n_nationkey % 7 <> 0").union(moved))


# ---- writes ----


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or "file:///tmp/checkpoints"
    return f"{base.rstrip('/')}/runs-{uuid.uuid4().hex}"


NATIVE = TableSpec.of("typed", {"k": "bigint"}, {}, {"i": "int", "d": "decimal", "v": "varint", "ts": "timestamp", "da": "date", "ti": "time", "tags": "set<text>", "u": "uuid"})


@query(
    "normalize_types",
    """select event_id as k, (user_id % 100)::int as i, (event_id::decimal(38, 19))::varchar as d, (event_id::decimal(38, 0))::varchar as v, epoch_us(ts) as ts, epoch_us(ts) // 86400000000 as da, (epoch_us(ts) % 86400000000) * 1000 as ti, event_type as tags from events""",
)
def normalize_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = micros("ts")
    given = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("k"), (F.col("user_id") % 100).cast("short").alias("i"), F.col("event_id").cast("string").alias("d"), F.col("event_id").alias("v"), F.timestamp_micros(at).alias("ts"),
        F.floor(at / 1000).alias("da"), F.timestamp_micros(at).alias("ti"), F.array("event_type", "event_type").alias("tags"), F.lit(None).cast("string").alias("u"),
    )
    n = normalized(given, NATIVE)
    return n.select("k", "i", F.col("d").cast("string").alias("d"), F.col("v").cast("string").alias("v"), F.unix_micros("ts").alias("ts"), F.unix_date("da").cast("long").alias("da"), "ti", F.array_join("tags", ",").alias("tags"))


@query("stored_values", "select event_id, epoch_us(ts) // 86400000000 + 2147483648 as stored, printf('%02X%02X%02X%02X', 10, user_id % 256, event_id % 256, event_id // 256 % 256) as home from events")
def stored_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", stored_date(F.to_date("ts")).alias("stored"), F.hex(inet_bytes(F.concat_ws(".", F.lit("10"), F.col("user_id") % 256, F.col("event_id") % 256, F.floor(F.col("event_id") / 256) % 256))).alias("home"))


@query("time_ids", "select event_id, lower(printf('%08X', t & 4294967295) || '-' || printf('%04X', (t >> 32) & 65535) || '-1' || printf('%03X', t >> 48) || '-8080-808080808080') as id from (select event_id, (epoch_us(ts) // 1000) * 10000 + 122192928000000000 as t from events)")
def time_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", timeuuid_from_millis(F.floor(micros("ts") / 1000)).alias("id"))


@query("time_of_day", "select event_id, (epoch_us(ts) % 86400000000) * 1000 as nanos from events")
def time_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", nanos_of_day(F.timestamp_micros(micros("ts"))).alias("nanos"))


@query("insert_log", "select user_id, event_type, value, epoch_us(ts) as _writetime, (event_id % 7 + 1)::int as _ttl, 'insert' as _op from events")
def insert_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "events").select("user_id", "event_type", "value", micros("ts").alias("at"), (F.col("event_id") % 7 + 1).alias("ttl"))
    return log_of(given, EVENTS, {"TTL": "ttl", "TIMESTAMP": "at"}).select("user_id", "event_type", "value", "_writetime", "_ttl", "_op")


@query("bulk_write_round_trip", "select user_id, event_type, arg_max(event_id, ts) as event_id, arg_max(value, ts) as value from events group by all")
def bulk_write_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    given = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", micros("ts").alias("at"))
    job = bulk_write(given, EVENTS, path, {"TIMESTAMP": "at"})
    return read_table(spark, EVENTS, job.path, options={"create_snapshot": False}, now=0)


@query(
    "delete_partition_write",
    """select user_id, event_type, arg_max(value, ts) as value from events where user_id % 3 > 0 group by all""",
)
def delete_partition_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "events").filter("user_id % 3 = 0").select("user_id").distinct()
    deletes = log_of(keys, EVENTS, {"WRITE_MODE": "DELETE_PARTITION", "TIMESTAMP": str((1 << 62))}).select("user_id", "_op", "_writetime")
    return merge_on_read(union_runs(event_log(spark, sf_dir), deletes), EVENTS).select("user_id", "event_type", "value")


@query("manifest", "select count(*) as n, count(distinct user_id) as keys from events")
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the files of a write add up to, and the partitions that their token ranges hold."""
    given = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", micros("ts").alias("at"))
    job = bulk_write(given, EVENTS, scratch(spark), {"TIMESTAMP": "at", "DIGEST": "MD5"})
    keys = spark.read.parquet(job.path).agg(F.count_distinct("user_id").alias("keys"))
    return job.manifest.agg(F.sum("rows").alias("n")).join(keys)


@query(
    "bundle_manifest",
    """with m as (select l_suppkey as start_token, l_suppkey as end_token, 'f' || l_suppkey as file, count(*) * 10 as length from lineitem group by l_suppkey),
    p as (select *, floor((sum(length) over (order by start_token, file) - 1) / 20000) as bundle from m)
    select bundle::bigint as bundle, min(start_token) as start_token, max(end_token) as end_token, count(*) as files, sum(length)::bigint as bytes from p group by bundle""",
)
def bundle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg((F.count("*") * 10).alias("length"))
    files = files.select(F.col("l_suppkey").alias("start_token"), F.col("l_suppkey").alias("end_token"), F.concat(F.lit("f"), "l_suppkey").alias("file"), "length", F.md5(F.col("l_suppkey").cast("string")).alias("digest"))
    return bundles(files, 20_000).select(F.col("bundle").cast("long").alias("bundle"), "start_token", "end_token", F.size("components_checksum").cast("long").alias("files"), "bytes")


@query("round_trip_difference", "select 0::bigint as n")
def round_trip_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    given = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.max("event_id").alias("event_id"), F.round(F.max("value"), 3).alias("value"))
    job = bulk_write(given, EVENTS, path, {"TIMESTAMP": "1000"})
    back = read_table(spark, EVENTS, job.path, options={"create_snapshot": False}, now=0).select(*given.columns)
    return given.exceptAll(back).unionByName(back.exceptAll(given)).agg(F.count("*").alias("n"))


# ---- the table as a source and a sink of its own ----


EVENTS_DDL = "CREATE TABLE ks.events (user_id bigint, event_type text, event_id bigint, value double, PRIMARY KEY (user_id, event_type));"


def through_source(spark: SparkSession, log: DataFrame, paths: int = 1, **options: object) -> DataFrame:
    """Current rows of a log that was dealt to so many paths, as the source reads them."""
    folder = scratch(spark)
    for k in range(paths):
        write_log(log.filter(F.pmod(F.col("event_id"), F.lit(paths)) == k), EVENTS, f"{folder}/{k}")
    return register(spark).read.format("widelog").options(ddl=EVENTS_DDL, paths=",".join(f"{folder}/{k}" for k in range(paths)), **{"now": 0, "num_cores": 4, **options}).load()


@query("source_lww", f"select user_id, event_type, arg_max(event_id, ts) as event_id, arg_max(value, ts) as value, max({MICROS}) as modified from events group by all")
def source_lww(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three paths of runs as one log."""
    rows = through_source(spark, event_log(spark, sf_dir).drop("props"), 3, lastModifiedColumnName="modified")
    return rows.withColumn("modified", F.unix_micros("modified"))


@query("source_partition_delete", SQL["partition_tombstone"])
def source_partition_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir).drop("props").withColumn("_op", F.when(F.col("event_type") == "error", "delete_partition").otherwise("insert"))
    return through_source(spark, log, 2).select("user_id", "event_type", "value")


@query("source_row_delete", SQL["row_tombstone"])
def source_row_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir).drop("props").withColumn("_op", F.when(F.col("event_id") % 5 == 0, "delete_row").otherwise("insert"))
    return through_source(spark, log, 2).select("user_id", "event_type", "value")


@query("source_range_delete", SQL["range_tombstone"])
def source_range_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = F.col("event_id") % 37 == 0
    log = event_log(spark, sf_dir).drop("props").withColumns({"_op": F.when(gone, "delete_range").otherwise("insert"), "_from": F.when(gone, "c"), "_to": F.when(gone, "q")})
    return through_source(spark, log, 2).select("user_id", "event_type", "value")


@query("source_ttl", "with m as (select user_id, event_type, arg_max(value, ts) as value, arg_max(event_id, ts) as event_id, max(epoch_us(ts)) as t from events group by all) select user_id, event_type, value from m where event_id % 2 = 0 or t // 1000000 + 604800 > 1706000000")
def source_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one write each, which lives a week or, with an even id, for ever, read at a fixed second."""
    last = event_log(spark, sf_dir).groupBy("user_id", "event_type").agg(F.max_by(F.struct("event_id", "value"), "_writetime").alias("x"), F.max("_writetime").alias("_writetime"))
    log = last.select("user_id", "event_type", "x.*", "_writetime").withColumn("_ttl", F.when(F.col("event_id") % 2 == 1, F.lit(604_800)))
    return through_source(spark, log, 1, now=1_706_000_000).select("user_id", "event_type", "value")


@query("source_key_filter", "select user_id, event_type, arg_max(value, ts) as value from events where user_id in (3, 5, 7) group by all")
def source_key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through_source(spark, event_log(spark, sf_dir).drop("props"), 2, columns="user_id,event_type,value").filter("user_id in (3, 5, 7)")


@query("sink_round_trip", "select user_id, event_type, arg_max(event_id, ts) as event_id, arg_max(value, ts) as value from events where user_id % 4 > 0 group by all")
def sink_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes and deletes of partitions through the sink, read back through the source."""
    path = scratch(spark)
    given = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", micros("ts").alias("at"))
    register(spark)
    given.write.format("widelog").options(ddl=EVENTS_DDL, path=path, TIMESTAMP="at").mode("append").save()
    keys = given.filter("user_id % 4 = 0").select("user_id").distinct()
    keys.write.format("widelog").options(ddl=EVENTS_DDL, path=path, WRITE_MODE="DELETE_PARTITION", TIMESTAMP=str(1 << 62)).mode("append").save()
    return spark.read.format("widelog").options(ddl=EVENTS_DDL, path=path, now=0).load()


THREE = [Instance(-(6 * 10**18), "a"), Instance(0, "b"), Instance(6 * 10**18, "c")]


@query(
    "replica_read",
    """select m.*, n from (select user_id, event_type, arg_max(event_id, ts) as event_id, arg_max(value, ts) as value from events group by all) m
    join (select user_id, event_type, sum(case when event_id % 2 = 0 then 1 else 2 end)::bigint as n from events group by all) c using (user_id, event_type)""",
)
def replica_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three replicas read at QUORUM: rows of repaired runs come from one of them, others from two; n counts them."""
    folder, around = scratch(spark), Ring(THREE, Replication("SimpleStrategy", {"replication_factor": 3}))
    log = event_log(spark, sf_dir).drop("props").withColumn("_repaired", F.col("event_id") % 2 == 0)
    write_log(log, EVENTS, folder)
    options = {"consistency_level": "QUORUM"}
    paths = {i.node: folder for i in THREE}
    counted = replica_log(spark, EVENTS, around, paths, options).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return read_replicas(spark, EVENTS, around, paths, options, now=0).join(counted, ["user_id", "event_type"])


# ---- what Spark brings itself, over merged rows ----


@query("agg_by_clustering", "select event_type, count(*) as n, round(sum(value), 4) as total from (select user_id, event_type, arg_max(value, ts) as value from events group by all) group by event_type")
def agg_by_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_on_read(event_log(spark, sf_dir), EVENTS).groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("distinct_agg", "select l_returnflag, count(distinct l_suppkey) as suppliers, count(distinct l_partkey) as parts from lineitem group by l_returnflag")
def distinct_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_suppkey").alias("suppliers"), F.count_distinct("l_partkey").alias("parts"))


@query("rollup", "select l_returnflag, l_linestatus, count(*) as n, sum(l_quantity) as q from lineitem group by rollup (l_returnflag, l_linestatus)")
def rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))


@query("cube", "select o_orderstatus, o_orderpriority, count(*) as n from orders group by cube (o_orderstatus, o_orderpriority)")
def cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("grouping_sets", "select o_orderstatus, o_orderpriority, count(*) as n from orders group by grouping sets ((o_orderstatus), (o_orderpriority), ())")
def grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupingSets([["o_orderstatus"], ["o_orderpriority"], []], "o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


JOIN = {"inner": "join", "left": "left join", "right": "right join", "full": "full join"}


def _join(kind: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
        o = table(spark, sf_dir, "orders").filter("o_totalprice > 300000").select("o_orderkey", "o_custkey")
        return c.join(o, F.col("c_custkey") == F.col("o_custkey"), kind)

    return run


for _kind, _word in JOIN.items():
    QUERIES[f"join_{_kind}"] = _join(_kind)
    SQL[f"join_{_kind}"] = f"select c_custkey, c_name, o_orderkey, o_custkey from customer {_word} (select o_orderkey, o_custkey from orders where o_totalprice > 300000) on c_custkey = o_custkey"
for _kind, _word in {"left_semi": "exists", "left_anti": "not exists"}.items():
    QUERIES[f"join_{_kind}"] = _join(_kind)
    SQL[f"join_{_kind}"] = f"select c_custkey, c_name from customer where {_word} (select 1 from orders where o_custkey = c_custkey and o_totalprice > 300000)"


@query("join_cross", "select r_name, n_name from region cross join nation")
def join_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two tables of a few rows."""
    return table(spark, sf_dir, "region").select("r_name").crossJoin(table(spark, sf_dir, "nation").select("n_name"))


@query("window_rank", "select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as r, round(sum(o_totalprice) over (partition by o_custkey), 2) as total from orders")
def window_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = Window.partitionBy("o_custkey")
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.row_number().over(by.orderBy(F.desc("o_totalprice"), "o_orderkey")).alias("r"), F.round(F.sum("o_totalprice").over(by), 2).alias("total"))


@query("clustering_order", "select user_id, event_type, value, row_number() over (partition by user_id order by event_type desc) as r from (select user_id, event_type, arg_max(value, ts) as value from events group by all)")
def clustering_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merge_on_read(event_log(spark, sf_dir), EVENTS).select("user_id", "event_type", "value")
    return rows.withColumn("r", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("event_type"))))


@query("top_k", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25")
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("set_union", "select o_custkey as k from orders union select c_custkey from customer")
def set_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")).union(table(spark, sf_dir, "customer").select("c_custkey")).distinct()


@query("set_intersect", "select c_custkey as k from customer intersect select o_custkey from orders")
def set_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).intersect(table(spark, sf_dir, "orders").select("o_custkey"))


@query("set_except", "select c_custkey as k from customer except select o_custkey from orders")
def set_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).exceptAll(table(spark, sf_dir, "orders").select("o_custkey").distinct())


HEADLINES = ("merged_revenue", "lww_merge", "lww_last_modified", "partition_tombstone", "range_tombstone", "ttl_expiry", "static_broadcast", "map_merge", "partition_size", "token_hash", "bulk_write_round_trip", "window_rank")
assert set(HEADLINES) <= set(QUERIES), os.path.basename(__file__)
