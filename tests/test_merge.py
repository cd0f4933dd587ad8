import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from widelog.operators.merge import merge_elements, merge_on_read, swept, union_runs
from widelog.spec import LAST_MODIFIED, TableSpec

SPEC = TableSpec.of("t", {"p": "int"}, {"c": "int"}, {"x": "int", "y": "text"}, {"s": "text"})
LOG = "p int, c int, x int, y string, s string, _writetime long, _op string, _ttl int, _set array<string>, _from int, _to int"
NOW = 1000


def brute(log):
    """Current rows, cell by cell, from plain dictionaries."""
    partition, rows, ranges, cells, statics, markers = {}, {}, [], {}, {}, {}
    for p, c, x, y, s, at, op, ttl, sets, low, high in log:
        until = at // 1_000_000 + ttl if ttl else None
        if op == "delete_partition":
            partition[p] = max(partition.get(p, at), at)
        elif op == "delete_range":
            ranges.append((p, low, high, at))
        elif op == "delete_row":
            rows[p, c] = max(rows.get((p, c), at), at)
        else:
            for name, value in (("x", x), ("y", y), ("s", s)):
                if name in (sets if sets is not None else ("x", "y", "s") if op != "delete_columns" else ()):
                    gone = value is None or op == "delete_columns"
                    to, key = (statics, (p, name)) if name == "s" else (cells, (p, c, name))
                    rank = (at, gone, value is not None, value if value is not None else 0, until is not None, until or 0)
                    if c is not None or name == "s":
                        to[key] = max(to.get(key, ((-1,), None)), (rank, None if gone else value), key=lambda t: t[0])
            if op == "insert" and c is not None:
                rank = (at, until is not None, until or 0)
                markers[p, c] = max(markers.get((p, c), rank), rank)

    def deleted(p, c):
        found = [partition.get(p, -1), rows.get((p, c), -1)]
        found += [at for q, low, high, at in ranges if q == p and (low is None or c >= low) and (high is None or c < high)]
        return max(found)

    def live(cell, gone):
        (at, dead, _, _, ends, until), value = cell
        return not dead and at > gone and (not ends or until > NOW)

    out, keys = {}, {k[:2] for k in cells} | set(markers)
    for p, c in keys:
        gone = deleted(p, c)
        here = {n: cells[p, c, n] for n in "xy" if (p, c, n) in cells and live(cells[p, c, n], gone)}
        m = markers.get((p, c))
        marked = m and m[0] > gone and (not m[1] or m[2] > NOW)
        if here or marked:
            out[p, c] = {n: here[n][1] if n in here else None for n in "xy"}, max((t[0][0] for t in here.values()), default=None), m[0] if marked else None
    static = {p: (t[1], t[0][0]) for (p, _), t in statics.items() if live(t, partition.get(p, -1))}
    result = set()
    for (p, c), (v, cell_time, marked) in out.items():
        s, at = static.get(p, (None, None))
        result.add((p, c, s, v["x"], v["y"], cell_time if cell_time is not None else max(t for t in (at, marked, -1) if t is not None)))
    for p, (s, at) in static.items():
        if p not in {k[0] for k in out}:
            result.add((p, None, s, None, None, at))
    return result


def merged(spark, log):
    from pyspark.sql import functions as F

    df = merge_on_read(spark.createDataFrame(log, LOG), SPEC, NOW, features=(LAST_MODIFIED,))
    return {tuple(r) for r in df.withColumn(LAST_MODIFIED, F.unix_micros(LAST_MODIFIED)).collect()}


small = st.integers(0, 3)
write = st.tuples(small, small, st.one_of(st.none(), small), st.one_of(st.none(), st.sampled_from("ab")), st.one_of(st.none(), st.sampled_from("uv")), st.integers(1, 12).map(lambda k: k * 90_000_000), st.sampled_from(["insert", "update", "delete_columns"]), st.sampled_from([None, None, 200, 900]), st.one_of(st.none(), st.lists(st.sampled_from("xys"), unique=True)), st.none(), st.none())
delete = st.tuples(small, small, st.none(), st.none(), st.none(), st.integers(1, 12).map(lambda k: k * 90_000_000), st.sampled_from(["delete_row", "delete_partition", "delete_range"]), st.none(), st.none(), st.one_of(st.none(), small), st.one_of(st.none(), small))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(write, write, write, delete), max_size=25))
def test_any_log(spark, log):
    log = [(*r[:1], None if r[6] == "delete_partition" or r[6] == "delete_range" else r[1], *r[2:]) for r in log]
    assert merged(spark, log) == brute(log)


def random_log():
    rng = random.Random(4)
    log = []
    for _ in range(4000):
        op = rng.choice(["insert"] * 4 + ["update"] * 4 + ["delete_columns", "delete_row", "delete_partition", "delete_range"])
        sets = rng.choice([None, None, ["x"], ["y", "s"], ["x", "y", "s"]])
        key = None if op in ("delete_partition", "delete_range") else rng.randrange(6)
        low, high = (rng.choice([None, 1, 2]), rng.choice([None, 4, 5])) if op == "delete_range" else (None, None)
        value = op in ("insert", "update", "delete_columns")
        log.append((rng.randrange(200), key, rng.choice([None, 1, 2, 3]) if value else None, rng.choice([None, "a", "b"]) if value else None, rng.choice([None, "u", "v"]) if value else None, rng.randrange(1, 10**9), op, rng.choice([None, None, 300, 900]) if value else None, sets if value else None, low, high))
    return log


def test_many_random_logs_at_once(spark):
    assert merged(spark, random_log()) == brute(random_log())


def test_source_merges_by_the_same_rules(spark, tmp_path):
    """The same log dealt to three paths of sorted runs, through the table source."""
    from pyspark.sql import functions as F

    from widelog.sources.datasource import register
    from widelog.sources.write import write_log

    log = random_log()
    for k in range(3):
        write_log(spark.createDataFrame(log[k::3], LOG), SPEC, f"file://{tmp_path}/{k}", 3)
    ddl = "CREATE TABLE ks.t (p int, c int, s text static, x int, y text, PRIMARY KEY (p, c));"
    load = lambda **more: register(spark).read.format("widelog").options(ddl=ddl, paths=",".join(f"file://{tmp_path}/{k}" for k in range(3)), now=NOW, default_parallelism=4, **more).load()
    df = load(lastModifiedTimestamp="true")
    assert df.columns == ["p", "c", "s", "x", "y", LAST_MODIFIED]
    want = brute(log)
    assert {tuple(r) for r in df.withColumn(LAST_MODIFIED, F.unix_micros(LAST_MODIFIED)).collect()} == want
    assert {tuple(r) for r in load().filter("p = 7").collect()} == {r[:5] for r in want if r[0] == 7}
    assert {tuple(r) for r in load(columns="p,y").filter("p in (3, 4)").collect()} == {(r[0], r[4]) for r in want if r[0] in (3, 4)}


def test_sweep_of_ranges():
    rng = random.Random(1)
    for _ in range(500):
        given = sorted(((rng.choice([None, *range(8)]), rng.choice([None, *range(10)]), rng.randint(1, 5)) for _ in range(rng.randint(0, 6))), key=lambda r: (r[0] is not None, r[0] or 0))
        out = list(swept(given))
        cover = lambda ranges, x: [t for a, b, t in ranges if (a is None or x >= a) and (b is None or x < b)]
        assert len(out) <= 2 * len(given) and all(cover(out, x) == sorted(cover(given, x))[-1:] for x in range(-1, 12))


def test_hot_partition_with_many_ranges(spark):
    """100,000 rows and 10,000 range deletes of one partition: no row meets all ranges."""
    import time

    from pyspark.sql import functions as F

    rows = spark.range(100_000).select(F.lit(1).alias("p"), F.col("id").cast("int").alias("c"), F.lit(1).alias("x"), F.lit(5).cast("long").alias("_writetime"), F.lit("insert").alias("_op"))
    gone = spark.range(10_000).select(F.lit(1).alias("p"), (F.col("id") * 10).cast("int").alias("_from"), (F.col("id") * 10 + 4).cast("int").alias("_to"), F.lit(9).cast("long").alias("_writetime"), F.lit("delete_range").alias("_op"))
    began = time.time()
    assert merge_on_read(union_runs(rows, gone), SPEC, NOW).count() == 60_000
    assert time.time() - began < 60


@pytest.mark.parametrize("spec", [SPEC, TableSpec.of("t", {"p": "int"}, {"c": "int"}, {"x": "int"})])
def test_rows_are_shuffled_once(spark, tmp_path, spec):
    path = str(tmp_path / "log")
    spark.createDataFrame(random_log(), LOG).drop("_from", "_to").write.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = merge_on_read(spark.read.parquet(path), spec, NOW)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan parquet") == 1


def test_clashing_names(spark):
    spec = TableSpec.of("t", {"_row": "int"}, {"_gone": "int"}, {"_cells": "int", "_marker": "text"}, {"_static": "text", "_deleted": "int"})
    log = spark.createDataFrame([(1, 2, 3, "a", "s", 4, 10), (1, 2, 5, None, None, None, 20)], "_row int, _gone int, _cells int, _marker string, _static string, _deleted int, _writetime long")
    assert [tuple(r) for r in merge_on_read(log, spec).collect()] == [(1, 2, None, None, 5, None)]
    with pytest.raises(ValueError):
        merge_on_read(log.withColumnRenamed("_row", "__merge_row"), TableSpec.of("t", {"__merge_row": "int"}))


def test_newer_columns_and_older_files(spark):
    old = spark.createDataFrame([(1, 1, 5, 10)], "p int, c int, x int, _writetime long")
    new = spark.createDataFrame([(1, 1, "b", ["y"], "update", 20)], "p int, c int, y string, _set array<string>, _op string, _writetime long")
    assert [tuple(r) for r in merge_on_read(union_runs(old, new), SPEC).collect()] == [(1, 1, None, 5, "b")]


def test_key_only_table_and_empty_log(spark):
    spec = TableSpec.of("k", {"a": "bigint"}, {"b": "text"})
    df = spark.createDataFrame([(1, "x", 1), (1, "x", 2), (1, "y", 1)], "a long, b string, _writetime long")
    assert sorted(map(tuple, merge_on_read(df, spec).collect())) == [(1, "x"), (1, "y")]
    assert merge_on_read(df.limit(0), spec).count() == 0
    with pytest.raises(ValueError):
        merge_on_read(df.drop("_writetime"), spec)


def test_maps_break_ties_by_entries(spark):
    spec = TableSpec.of("m", {"a": "int"}, {}, {"v": "frozen<map<text, int>>"})
    df = spark.createDataFrame([(1, {"x": 1}, 5), (1, {"x": 2}, 5)], "a int, v map<string,int>, _writetime long")
    assert merge_on_read(df, spec).first()["v"] == {"x": 2}


def test_elements(spark):
    log = spark.createDataFrame(
        [(1, "a", 1, 10, False, None), (1, "b", 2, 10, False, None), (1, "a", 3, 20, False, None), (1, "b", None, 15, True, None), (1, "c", 9, 30, False, 5), (2, "z", 1, 10, False, None), (2, None, None, 10, True, None)],
        "k int, _element string, value int, _writetime long, _deleted boolean, _ttl int",
    )
    assert [tuple(r) for r in merge_elements(log, ["k"], "map", now=1000).collect()] == [(1, {"a": 3})]
    assert merge_elements(log, ["k"], "set", now=0).first()["value"] == ["a", "c"]
    assert merge_elements(log, ["k"], "list", now=0).first()["value"] == [3, 9]


def test_only_needed_columns_are_read(spark, tmp_path):
    spark.createDataFrame([(1, 1, 5, "y", "s", 10)], "p int, c int, x int, y string, s string, _writetime long").write.parquet(f"{tmp_path}/t")
    df = merge_on_read(spark.read.parquet(f"{tmp_path}/t"), TableSpec.of("t", {"p": "int"}, {"c": "int"}, {"x": "int"})).filter("p = 1").select("p", "x")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(p,1)" in plan and "y:string" not in plan.split("ReadSchema")[1]


def test_features_of_ones_own(spark):
    from pyspark.sql import functions as F

    from widelog.operators.merge import Feature, last_modified_feature

    oldest = Feature("oldest", lambda row: F.least(*row.times.values(), row.inserted))
    length = Feature("length", lambda row: F.length(row.values["y"]))
    log = spark.createDataFrame([(1, 1, 5, "abc", "s", 10), (1, 1, 6, None, None, 20), (2, 1, 1, "z", None, 7)], "p int, c int, x int, y string, s string, _writetime long")
    log = log.withColumn("_set", F.when(F.col("_writetime") == 20, F.array(F.lit("x"))))
    rows = merge_on_read(log, SPEC, features=(oldest, LAST_MODIFIED, length, last_modified_feature("again"))).orderBy("p").collect()
    assert [(r["p"], r["oldest"], r["length"]) for r in rows] == [(1, 10, 3), (2, 7, 1)] and all(r[LAST_MODIFIED] == r["again"] for r in rows)
    assert rows[0].__fields__ == ["p", "c", "s", "x", "y", "oldest", LAST_MODIFIED, "length", "again"]
