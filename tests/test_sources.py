import pytest
from pyspark.sql import functions as F

from widelog.functions.convert import converted, from_stored_date, inet_text, stored_date, timeuuid_from_millis, write_time
from widelog.operators.sizes import partition_sizes, prorated, run_summaries, with_compressed
from widelog.plans.ring import Instance, Ring
from widelog.sources.datasource import register
from widelog.sources.read import ClearStrategy, ReadOptions, Snapshot, read_log, read_replicas, read_table, replica_log, token_parts, whole_ring
from widelog.sources.write import PerWrite, bulk_write, bundles, estimated_bytes, file_digests, coordinated_write, log_of, statement, validate, write_options
from widelog.spec import Replication, TableSpec
from widelog.types import parse_type

SPEC = TableSpec.of("t", {"id": "bigint"}, {"c": "int"}, {"v": "text", "n": "int"}, keyspace="ks")
RING = Ring([Instance(0, "a"), Instance(10**18, "b"), Instance(-(10**18), "c")], Replication("SimpleStrategy", {"replication_factor": 3}))


def rows(spark, n=200):
    return spark.range(n).select((F.col("id") % 20).alias("id"), F.col("id").cast("int").alias("c"), F.concat(F.lit("v"), "id").alias("v"))


def test_statements(spark):
    df = spark.createDataFrame([], "id long, c int, v string, ttl int, at long")
    assert statement(df.select("id", "c", "v"), SPEC) == "INSERT INTO ks.t (id,c,v) VALUES (:id,:c,:v);"
    assert statement(df, SPEC, {"TTL": "ttl", "TIMESTAMP": "at"}) == "INSERT INTO ks.t (id,c,v) VALUES (:id,:c,:v) USING TIMESTAMP :at AND TTL :ttl;"
    assert statement(df.select("id", "c"), SPEC, {"TTL": "1000"}) == "INSERT INTO ks.t (id,c) VALUES (:id,:c) USING TTL 1000;"
    assert statement(df.select("id"), SPEC, {"WRITE_MODE": "DELETE_PARTITION"}) == "DELETE FROM ks.t where id=?;"
    quoted = TableSpec.from_ddl('CREATE TABLE "Ks"."table" ("Id" int PRIMARY KEY, v text);')
    assert statement(spark.createDataFrame([], "Id int, v string"), quoted, {"QUOTE_IDENTIFIERS": "true"}) == 'INSERT INTO "Ks"."table" ("Id",v) VALUES (:"Id",:v);'
    assert PerWrite.of("x").column == "x" and PerWrite.of("5").constant == 5 and not PerWrite.of(None).given


def test_validation(spark):
    df = rows(spark, 1)
    for bad, options in ((df.drop("c"), None), (df.withColumn("z", F.lit(1)), None), (df, {"WRITE_MODE": "DELETE_PARTITION"}), (df, {"TTL": "missing"})):
        with pytest.raises(ValueError):
            validate(bad, SPEC, options)
    validate(df.select("id"), SPEC, {"WRITE_MODE": "DELETE_PARTITION"})
    for bad in ({"nothing": 1}, {"WRITE_MODE": "x"}, {"DIGEST": "x"}, {"COMMIT_BATCH_SIZE": 5}, {"DATA_TRANSPORT": "PIGEON"}, {"RUN_SIZE_IN_MIB": 0}):
        with pytest.raises(ValueError):
            write_options(bad)
    for bad in ({"KEYSPACE": "other"}, {"TABLE": "other"}):
        with pytest.raises(ValueError):
            validate(df, SPEC, bad)
    with pytest.raises(Exception, match="non-null"):
        log_of(df.withColumn("c", F.lit(None).cast("int")), SPEC).collect()


def test_round_trip(spark, tmp_path):
    df, path = rows(spark), f"file://{tmp_path}/t"
    first = bulk_write(df, SPEC, path, {"TIMESTAMP": "1000"}, ring=RING)
    assert first.rows == 200 and first.bytes > 0
    assert bulk_write(df.filter("id < 5").withColumn("n", F.lit(7).cast("short")).drop("v"), SPEC, path, {"TIMESTAMP": "2000", "DIGEST": "MD5"}).rows == 50
    bulk_write(df.filter("id = 9").select("id").distinct(), SPEC, path, {"TIMESTAMP": "3000", "WRITE_MODE": "DELETE_PARTITION"})
    paths = [f"file://{p}" for p in sorted(map(str, (tmp_path / "t").iterdir()))]
    got = read_table(spark, SPEC, *paths, now=0)
    assert got.count() == 190 and got.filter("id < 5").select("n").distinct().first()[0] == 7
    assert got.filter("id < 5").exceptAll(got.filter("v is not null and n = 7")).count() == 0
    assert read_table(spark, SPEC, *paths, now=0, ranges=whole_ring(2)[:1]).count() + read_table(spark, SPEC, *paths, now=0, ranges=whole_ring(2)[1:]).count() == 190
    data = spark.read.parquet(first.path).withColumn("file", F.input_file_name())
    spans = sorted((r["first_token"], r["last_token"]) for r in run_summaries(data, "file").collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # files don't overlap in tokens
    for f in data.groupBy("file").agg(F.collect_list("token").alias("t")).collect():
        assert f["t"] == sorted(f["t"])


def test_ttl_and_expiry(spark, tmp_path):
    job = bulk_write(rows(spark, 10), SPEC, f"file://{tmp_path}/t", {"TTL": "5", "TIMESTAMP": "1000000"})
    assert read_table(spark, SPEC, job.path, now=5).count() == 10 and read_table(spark, SPEC, job.path, now=6).count() == 0


def test_modes_levels_and_transport(spark, tmp_path):
    for mode in ("overwrite", "ignore"):
        with pytest.raises(ValueError):
            bulk_write(rows(spark, 1), SPEC, str(tmp_path), mode=mode)
    down = Ring([Instance(0, "a", "", "DOWN"), Instance(9, "b", "", "DOWN"), Instance(99, "c")], RING.replication)
    with pytest.raises(RuntimeError):
        bulk_write(rows(spark, 1), SPEC, str(tmp_path), {"BULK_WRITER_CL": "QUORUM"}, ring=down)

    class Log:
        def __init__(self):
            self.seen = []

        def started(self, job):
            self.seen.append("started")

        def bundle_ready(self, job, bundle):
            self.seen.append(len(bundle["components_checksum"]))

        def finished(self, job, n):
            self.seen.append(n)

        def failed(self, job, error):
            self.seen.append(error)

    log = Log()
    bulk_write(rows(spark), SPEC, f"file://{tmp_path}/x", {"MAX_SIZE_PER_BUNDLE_IN_BYTES": 1}, transport=log)
    assert log.seen[0] == "started" and log.seen[-1] == 200 and set(log.seen[1:-1]) == {1}


def test_two_clusters(spark, tmp_path):
    got = coordinated_write(rows(spark), {"x": (SPEC, f"file://{tmp_path}/x", RING), "y": (SPEC, f"file://{tmp_path}/y", RING)}, {"BULK_WRITER_CL": "QUORUM"})
    assert {k: w.rows for k, w in got.items()} == {"x": 200, "y": 200}
    a, b = (spark.read.parquet(got[k].path).drop("_part") for k in "xy")
    assert a.exceptAll(b).count() == 0


def test_bundles(spark):
    files = spark.createDataFrame([("a", 1, 2, 60, "d1"), ("b", 3, 4, 30, "d2"), ("c", 5, 6, 30, "d3")], "file string, start_token long, end_token long, length long, digest string")
    got = [(r["start_token"], r["end_token"], r["components_checksum"]) for r in bundles(files, 100).orderBy("start_token").collect()]
    assert got == [(1, 4, {"a": "d1", "b": "d2"}), (5, 6, {"c": "d3"})]


def test_options_and_snapshots(spark, tmp_path):
    o = ReadOptions.of({"snapshotName": "s", "createSnapshot": "false", "DEFAULT_PARALLELISM": "7", "lastModifiedColumnName": "lm"})
    assert (o.snapshot_name, o.create_snapshot, o.default_parallelism, o.features) == ("s", False, 7, ("last_modified_timestamp",))
    for bad in ({"nothing": 1}, {"read_index_offset": True}, {"sizing": "huge"}):
        with pytest.raises(ValueError):
            ReadOptions.of(bad)
    assert len(token_parts(SPEC, ReadOptions.of({"sizing": "dynamic", "max_partition_size": 2}), whole_ring(1), 9 << 30)) == 5
    with pytest.raises(ValueError):
        read_table(spark, SPEC, str(tmp_path), options={"keyspace": "other"})
    assert ClearStrategy.of("TTL 2d").ttl_seconds == 172_800 and ClearStrategy.of("noOp").ttl_seconds is None
    for bad in ("TTL", "noOp 2d", "TTL 2x", "never"):
        with pytest.raises(ValueError):
            ClearStrategy.of(bad)
    job = bulk_write(rows(spark, 10), SPEC, f"file://{tmp_path}/t", {"TIMESTAMP": "1"})
    snap = Snapshot.take(spark, job.path)
    bulk_write(rows(spark, 50), SPEC, f"file://{tmp_path}/t", {"TIMESTAMP": "2", "JOB_ID": job.job})
    assert snap.read(spark).count() == 10 and read_log(spark, SPEC, job.path).count() == 60
    assert not snap.expired() and snap.expired(snap.taken + 10**6)
    snap.finish()
    with pytest.raises(RuntimeError):
        snap.read(spark)
    seen = read_table(spark, SPEC, job.path, options={"enable_stats": True, "last_modified_column_name": "lm"}, now=0)
    assert seen.count() == 50 and seen.read_stats.get["rows"] == 50
    same = [read_table(spark, SPEC, job.path, options={"cacheDataLayer": True, "createSnapshot": c}, now=0) for c in (True, False)]
    assert same[0] is same[1]


def test_python_source(spark, tmp_path):
    job = bulk_write(rows(spark), SPEC, f"file://{tmp_path}/t", {"TIMESTAMP": "1"})
    ddl = "CREATE TABLE ks.t (id bigint, c int, v text, n int, PRIMARY KEY (id, c));"
    load = lambda: register(spark).read.format("widelog").option("ddl", ddl).option("paths", job.path.removeprefix("file://")).option("default_parallelism", "4").load()
    assert load().columns == ["id", "c", "n", "v"] and load().count() == 200
    assert load().filter("id = 3").count() == 10 and load().filter("id in (3, 4) and c > 100").count() == 10 and load().filter("id = 99").count() == 0


DDL = "CREATE TABLE ks.t (id bigint, c int, v text, n int, PRIMARY KEY (id, c));"


def test_sink(spark, tmp_path):
    path, df = f"file://{tmp_path}/t", rows(spark)
    register(spark)
    save = lambda x, mode="append", **more: x.write.format("widelog").options(ddl=DDL, path=path, **more).mode(mode).save()
    load = lambda: spark.read.format("widelog").options(ddl=DDL, path=path, now=6).load()
    save(df.repartition(3), TIMESTAMP=1000, RUN_SIZE_IN_MIB=1, JOB_ID="first")
    save(df.filter("id < 5").withColumn("n", F.lit(7).cast("short")).drop("v"), TIMESTAMP=2000)
    save(df.filter("id = 9").select("id").distinct(), TIMESTAMP=3000, WRITE_MODE="DELETE_PARTITION")
    save(df.filter("id = 6").withColumn("late", F.lit(5)), TIMESTAMP=4000, TTL="late")
    got = load()
    assert got.count() == 180 and got.filter("id < 5 and n = 7 and v is not null").count() == 50
    assert got.exceptAll(read_table(spark, SPEC, *[f"file://{p}" for p in sorted(tmp_path.glob("t/*"))], now=6).select(*got.columns)).count() == 0
    assert len(list((tmp_path / "t" / "first").glob("*.parquet"))) == 3 and (tmp_path / "t" / "first" / "_manifest.json").exists()
    for bad, more in ((df, {"mode": "overwrite"}), (df.drop("c"), {}), (df.withColumn("c", F.lit(None).cast("int")), {}), (df.withColumn("n", F.lit("x")), {})):
        with pytest.raises(Exception):  # noqa: B017 - of the writer's process
            save(bad, **more)
    assert load().count() == 180


def test_a_run_that_is_too_late_is_cancelled(spark, tmp_path):
    import time

    slow = rows(spark, 8).repartition(8).withColumn("v", F.expr("reflect('java.lang.Thread', 'sleep', 8000L)"))
    began = time.time()
    with pytest.raises(TimeoutError):
        bulk_write(slow, SPEC, f"file://{tmp_path}/t", {"JOB_TIMEOUT_SECONDS": 3})
    assert time.time() - began < 14 and not list((tmp_path / "t").glob("*"))
    assert bulk_write(rows(spark, 8), SPEC, f"file://{tmp_path}/t", {"JOB_TIMEOUT_SECONDS": 300}).rows == 8
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


def test_run_size_and_digests(spark, tmp_path):
    import hashlib

    spark.range(200_000).select((F.col("id") % 50).alias("id"), F.col("id").cast("int").alias("c"), F.md5(F.col("id").cast("string")).alias("v")).write.parquet(f"file://{tmp_path}/in")
    df = spark.read.parquet(f"file://{tmp_path}/in")
    small = bulk_write(df, SPEC, f"file://{tmp_path}/t", {"RUN_SIZE_IN_MIB": 1, "SKIP_EXTENDED_VERIFY": True})
    assert small.manifest.count() > 4 and estimated_bytes(df) > 4 << 20
    for r in file_digests(spark, small.path, "MD5").collect():
        body = next((tmp_path / "t").rglob(r["file"])).read_bytes()
        assert (r["length"], r["digest"]) == (len(body), hashlib.md5(body).hexdigest())


def test_replicas(spark, tmp_path):
    """Each node has its ranges only; the level decides how many are read, and a node without a path is replaced."""
    log = log_of(rows(spark), SPEC, {"TIMESTAMP": "1"}).withColumn("_repaired", F.col("id") % 2 == 0)
    for node in "abc":
        log.write.parquet(f"{tmp_path}/{node}")
    paths = {n: f"{tmp_path}/{n}" for n in "abc"}
    count = lambda level, where=paths, **more: replica_log(spark, SPEC, RING, where, {"consistency_level": level, **more}).count()
    assert count("ONE") == 200 and count("QUORUM") == 300 and count("ALL") == 400 and count("QUORUM", use_incremental_repair="false") == 400
    two = {n: paths[n] for n in "bc"}
    assert count("QUORUM", two) == 300 and read_replicas(spark, SPEC, RING, two, {"consistency_level": "QUORUM"}, now=0).count() == 200
    with pytest.raises(RuntimeError):
        count("ALL", two)


def test_conversions(spark):
    df = spark.createDataFrame([(1_700_000_000_123, "127.0.0.1", "::1", [3, 1, 3])], "ms long, a string, b string, xs array<int>")
    kinds = {f.name: f.dataType for f in df.schema}
    to = lambda c, t: converted(F.col(c), kinds[c], parse_type(t))
    row = df.select(inet_text(to("a", "inet")).alias("a"), inet_text(to("b", "inet")).alias("b"), to("xs", "set<int>").alias("s"), to("xs", "list<bigint>").alias("l"), to("ms", "timeuuid").alias("u"), to("ms", "decimal").cast("string").alias("d"), F.unix_millis(to("ms", "timestamp")).alias("t"), from_stored_date(stored_date(to("ms", "date"))).cast("string").alias("da")).first()
    assert (row["a"], row["b"], row["s"], row["l"], row["t"], row["da"]) == ("127.0.0.1", "::1", [1, 3], [3, 1, 3], 1_700_000_000_123, "2023-11-14")
    import uuid

    u = uuid.UUID(row["u"])
    assert u.version == 1 and (u.time - 0x01B21DD213814000) // 10_000 == 1_700_000_000_123
    assert df.select(timeuuid_from_millis(F.lit(0).cast("long")).alias("u")).first()["u"] == "13814000-1dd2-11b2-8080-808080808080"
    for c, t in (("a", "bigint"), ("ms", "int"), ("a", "list<int>"), ("xs", "map<int, int>"), ("xs", "tuple<int>")):
        with pytest.raises(TypeError):
            to(c, t)
    for c, t in (("a", "uuid"), ("a", "timeuuid"), ("ms", "time")):
        if c == "ms":
            continue
        with pytest.raises(Exception, match="not a valid"):
            df.select(to(c, t)).collect()
    with pytest.raises(Exception, match="write time"):
        df.select(write_time(F.lit(None).cast("long"), kinds["ms"])).collect()


def test_nested_structs(spark):
    from widelog.spec import parse_udts

    udts = parse_udts(["CREATE TYPE k.inner (a int, b text)", "CREATE TYPE k.outer (i frozen<inner>, xs frozen<set<int>>)"])
    df = spark.createDataFrame([(((1, None), [2, 2, 1]),), (None,)], "s struct<i:struct<a:short,b:string>,xs:array<int>>")
    got = [r[0] for r in df.select(converted(F.col("s"), df.schema["s"].dataType, parse_type("outer", udts)).alias("s")).collect()]
    assert got[0].asDict(True) == {"i": {"a": 1, "b": None}, "xs": [1, 2]} and got[1] is None


def test_sizes(spark):
    df = spark.createDataFrame([(1, 1, "abc", None), (1, 2, "é", 5), (2, 1, None, None)], "id long, c int, v string, n int").withColumn("run", F.lit("r"))
    got = {r["id"]: (r["uncompressed"], r["compressed"]) for r in partition_sizes(df, SPEC, "run", spark.createDataFrame([("r", 0.5)], "run string, ratio double")).collect()}
    assert got == {1: (8 + 4 + 3 + 8 + 4 + 2 + 4, 16), 2: (12, 6)} or got == {1: (33, 17), 2: (12, 6)}
    chunks = [60, 70, 80, 90]
    spans = [(0, 50), (0, 100), (50, 150), (50, 350), (120, 130), (5, 5)]
    index = spark.createDataFrame([(a, b, chunks) for a, b in spans], "s long, e long, n array<int>")
    assert [r["compressed"] for r in with_compressed(index, "s", "e", 100, "n").collect()] == [prorated(a, b, 100, chunks) for a, b in spans] == [30, 60, 65, 225, 7, 0]
