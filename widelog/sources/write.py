"""Bulk writes: rows become a token-ordered log with checked keys, a manifest and digests."""

from __future__ import annotations

import hashlib
import json
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.convert import converted, write_time
from ..functions.tokens import MAX_TOKEN, MIN_TOKEN, key_bytes, murmur3_token
from ..operators.merge import OP, SET, TTL, WRITETIME
from ..plans.consistency import DEFAULT_WRITE, check_availability
from ..plans.ring import Ring, TokenPartitioner, range_number, split_range
from ..spec import TableSpec, quoted, validate_for_write

INSERT, DELETE_PARTITION = "INSERT", "DELETE_PARTITION"

# Options of a write with their defaults.
DEFAULTS: dict[str, object] = {
    "BULK_WRITER_CL": DEFAULT_WRITE,
    "COORDINATED_WRITE_CONFIG": None,
    "DATA_TRANSPORT": "DIRECT",
    "DIGEST": "XXHASH32",
    "JOB_ID": None,
    "JOB_TIMEOUT_SECONDS": -1,
    "KEYSPACE": None,
    "LOCAL_DC": None,
    "MAX_SIZE_PER_BUNDLE_IN_BYTES": 5 * 1024**3,
    "NUMBER_SPLITS": -1,
    "QUOTE_IDENTIFIERS": False,
    "SKIP_EXTENDED_VERIFY": False,
    "RUN_SIZE_IN_MIB": 160,
    "TABLE": None,
    "TIMESTAMP": None,
    "TTL": None,
    "WRITE_MODE": INSERT,
}


# Options of the remote protocol, which files don't have. They are refused, so that nobody counts on them.
REFUSED = frozenset(
    "COMMIT_BATCH_SIZE COMMIT_THREADS_PER_INSTANCE JOB_KEEP_ALIVE_MINUTES SIDECAR_CONTACT_POINTS SIDECAR_PORT SIDECAR_REQUEST_RETRIES KEYSTORE_PATH KEYSTORE_PASSWORD "
    "KEYSTORE_BASE64_ENCODED KEYSTORE_TYPE TRUSTSTORE_PATH TRUSTSTORE_PASSWORD TRUSTSTORE_BASE64_ENCODED TRUSTSTORE_TYPE".split()
)
TRANSPORTS = ("DIRECT", "S3_COMPAT")


def write_options(given: dict[str, object] | None = None) -> dict[str, object]:
    """Options with defaults; names in any case."""
    out = dict(DEFAULTS)
    for k, v in (given or {}).items():
        if k.upper() in REFUSED:
            raise ValueError(f"write option {k} belongs to a remote protocol and has no effect here")
        if k.upper() not in out:
            raise ValueError(f"unknown write option {k}")
        default = out[k.upper()]
        if isinstance(default, bool):
            v = v if isinstance(v, bool) else str(v).lower() == "true"
        elif isinstance(default, int):
            v = int(v)
        out[k.upper()] = v
    if out["WRITE_MODE"] not in (INSERT, DELETE_PARTITION):
        raise ValueError(f"unknown write mode {out['WRITE_MODE']}")
    if out["DATA_TRANSPORT"] not in TRANSPORTS:
        raise ValueError(f"unknown transport {out['DATA_TRANSPORT']}")
    if out["RUN_SIZE_IN_MIB"] < 1:
        raise ValueError("a run has a MiB at least")
    if out["DIGEST"] not in ("XXHASH32", "MD5"):
        raise ValueError(f"unknown digest {out['DIGEST']}")
    return out


@dataclass(frozen=True)
class PerWrite:
    """A number for all rows, or the name of a column that has one for each; neither: not given."""

    constant: int | None = None
    column: str | None = None

    @classmethod
    def of(cls, text: object) -> PerWrite:
        if text is None:
            return cls()
        try:
            return cls(constant=int(text))
        except ValueError:
            return cls(column=str(text))

    @property
    def given(self) -> bool:
        return self.constant is not None or self.column is not None

    def said(self, quote: bool) -> str:
        return f":{quoted(self.column, quote)}" if self.column else str(self.constant)


def statement(df: DataFrame, spec: TableSpec, options: dict[str, object] | None = None) -> str:
    """What the write means as a statement."""
    o = write_options(options)
    q = bool(o["QUOTE_IDENTIFIERS"])
    table = f"{quoted(spec.keyspace, q)}.{quoted(spec.name, q)}"
    if o["WRITE_MODE"] == DELETE_PARTITION:
        return f"DELETE FROM {table} where " + " AND ".join(f"{quoted(c, q)}=?" for c in df.columns) + ";"
    ttl, at = PerWrite.of(o["TTL"]), PerWrite.of(o["TIMESTAMP"])
    names = [c for c in df.columns if c not in (ttl.column, at.column)]
    using = [f"{word} {x.said(q)}" for word, x in (("TIMESTAMP", at), ("TTL", ttl)) if x.given]
    said = f"INSERT INTO {table} ({','.join(quoted(c, q) for c in names)}) VALUES ({','.join(':' + quoted(c, q) for c in names)})"
    return said + (" USING " + " AND ".join(using) if using else "") + ";"


def check_columns(have: list[str], spec: TableSpec, options: dict[str, object] | None = None) -> None:
    """Fails if columns don't fit the table and the mode, or the options name another table."""
    o = write_options(options)
    validate_for_write(spec)
    for name, own in (("KEYSPACE", spec.keyspace), ("TABLE", spec.name)):
        if o[name] not in (None, own):
            raise ValueError(f"{name} is {o[name]}, the table's is {own}")
    if o["WRITE_MODE"] == DELETE_PARTITION:
        if set(have) != set(spec.partition_key):
            raise ValueError(f"only partition key columns ({','.join(spec.partition_key)}) go with DELETE_PARTITION, not ({','.join(have)})")
        return
    if missing := [k for k in spec.primary_key if k not in have]:
        raise ValueError(f"missing key columns: {','.join(missing)}")
    extra = {PerWrite.of(o["TTL"]).column, PerWrite.of(o["TIMESTAMP"]).column}
    if unknown := [c for c in have if c not in spec.names and c not in extra]:
        raise ValueError(f"unknown columns: {unknown}")
    if absent := [c for c in extra if c and c not in have]:
        raise ValueError(f"missing option columns: {absent}")


def validate(df: DataFrame, spec: TableSpec, options: dict[str, object] | None = None) -> None:
    check_columns(list(df.columns), spec, options)


def normalized(df: DataFrame, spec: TableSpec) -> DataFrame:
    """df with each of the table's columns converted to the column's type; the others stay."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        out.append(converted(c, f.dataType, spec.column(f.name).type, spec.decimals, f.name).alias(f.name) if f.name in spec.names else c)
    return df.select(*out)


def not_null(name: str) -> Column:
    c = F.col(f"`{name}`")
    return F.when(c.isNull(), F.raise_error(F.lit(f"null in key column {name}; all key columns must be non-null"))).otherwise(c)


def log_of(df: DataFrame, spec: TableSpec, options: dict[str, object] | None = None, now_micros: int | None = None) -> DataFrame:
    """The log rows of a write: converted, keys checked, with token, write time, time to live and what they set."""
    o = write_options(options)
    validate(df, spec, options)
    ttl, at = PerWrite.of(o["TTL"]), PerWrite.of(o["TIMESTAMP"])
    now = int(time.time() * 1e6) if now_micros is None else now_micros
    kinds = {f.name: f.dataType for f in df.schema}
    keys = spec.primary_key if o["WRITE_MODE"] == INSERT else spec.partition_key
    ready = normalized(df, spec).withColumns({k: not_null(k) for k in keys})
    set_names = [c for c in df.columns if c in spec.names and c not in keys]
    marks = {
        OP: F.lit("insert" if o["WRITE_MODE"] == INSERT else "delete_partition"),
        WRITETIME: write_time(F.col(f"`{at.column}`"), kinds[at.column]) if at.column else F.lit(at.constant if at.constant is not None else now).cast("long"),
        TTL: F.col(f"`{ttl.column}`").cast("int") if ttl.column else F.lit(ttl.constant).cast("int"),
        SET: F.array(*[F.lit(c) for c in set_names]) if set_names else F.lit(None).cast("array<string>"),
        "_key": key_bytes(spec),
    }
    out = ready.withColumns(marks).withColumn("token", murmur3_token(F.col("_key")))
    return out.drop(*[c for c in (ttl.column, at.column) if c and c not in spec.names])


def dealt_by_token(log: DataFrame, spec: TableSpec, parts: list, extra: list[str] = ()) -> DataFrame:
    """log with each token range in a task of its own, in order of token, key bytes and clustering key; nothing is sampled first."""
    number = range_number(parts, F.col("token"))
    order = [F.col("token"), F.col("_key"), *[F.col(f"`{c}`").desc() if spec.column(c).descending else F.col(f"`{c}`") for c in spec.clustering_key if c in log.columns]]
    return log.withColumn("_part", number).repartitionById(len(parts), F.col("_part")).sortWithinPartitions("_part", *order)


#: Bytes that a digest takes at a time.
CHUNK = 8 << 20


@dataclass(frozen=True)
class Written:
    job: str
    path: str
    rows: int
    bytes: int
    seconds: float
    manifest: DataFrame


def file_digests(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(file, length, digest) of each data file, hashed where it is read, some bytes at a time."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path).select("path", "length")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyarrow import fs

        for batch in batches:
            out = []
            for file in batch.column(0).to_pylist():
                digest = hashlib.md5() if kind == "MD5" else xxhash.xxh32(seed=0)
                system, inner = fs.FileSystem.from_uri(file if "://" in file else file.replace("file:/", "file:///", 1))
                with system.open_input_stream(inner) as opened:
                    while chunk := opened.read(CHUNK):
                        digest.update(chunk)
                out.append(digest.hexdigest())
            names = [f.rsplit("/", 1)[-1] for f in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(names), batch.column(1), pa.array(out)], names=["file", "length", "digest"])

    return files.mapInArrow(hashed, "file string, length long, digest string")


def manifest_of(spark: SparkSession, path: str, spec: TableSpec, digest: str) -> DataFrame:
    """A row for each file: first and last token, rows, length and digest."""
    data = spark.read.parquet(path).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    return data.groupBy("file").agg(F.min("token").alias("start_token"), F.max("token").alias("end_token"), F.count("*").alias("rows")).join(file_digests(spark, path, digest), "file")


def bundles(manifest: DataFrame, most_bytes: int) -> DataFrame:
    """Files of a manifest packed, in token order, into bundles of at most most_bytes (a larger file is one of its own).

    A row for each bundle: start_token, end_token, components_checksum (file -> digest), bytes.
    """
    from pyspark.sql import Window

    order = Window.orderBy("start_token", "file")  # one row for each file, not for each row of data
    placed = manifest.withColumn("bundle", F.floor((F.sum("length").over(order) - 1) / F.lit(most_bytes)))
    sums = F.map_from_entries(F.array_sort(F.collect_list(F.struct("file", "digest"))))
    return placed.groupBy("bundle").agg(F.min("start_token").alias("start_token"), F.max("end_token").alias("end_token"), sums.alias("components_checksum"), F.sum("length").alias("bytes"))


class Transport(Protocol):
    """Hooks of a storage transport, driver side."""

    def started(self, job: str) -> None: ...
    def bundle_ready(self, job: str, bundle: dict) -> None: ...
    def finished(self, job: str, rows: int) -> None: ...
    def failed(self, job: str, error: BaseException) -> None: ...


@contextmanager
def time_limit(spark: SparkSession, job: str, what: str, seconds: int) -> Iterator[None]:
    """Cancels what runs inside after so many seconds, if there are any, and says so by a TimeoutError."""
    context, over = spark.sparkContext, threading.Event()

    def end() -> None:
        over.set()
        context.cancelJobGroup(job)

    if seconds <= 0:
        yield
        return
    timer = threading.Timer(seconds, end)
    context.setJobGroup(job, what, True)
    timer.start()
    try:
        yield
        if over.is_set():  # between two of its jobs
            raise TimeoutError(f"job {job} took more than {seconds} s")
    except Exception as e:
        if over.is_set() and not isinstance(e, TimeoutError):
            raise TimeoutError(f"job {job} was cancelled after {seconds} s") from e
        raise
    finally:
        timer.cancel()
        for name in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            context.setLocalProperty(name, None)


def estimated_bytes(df: DataFrame) -> int:
    """The size that the optimizer expects of df; 0 if it has no idea."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 0


def bulk_write(df: DataFrame, spec: TableSpec, path: str, options: dict[str, object] | None = None, ring: Ring | None = None, mode: str = "append", transport: Transport | None = None, now_micros: int | None = None) -> Written:
    """Writes df to a table's log under path as one more set of runs. Only mode append is there.

    With a ring, its ranges deal the work and its instances must be able to meet the consistency level at start, and
    again at the end; else the token space is cut evenly. There are as many runs as cores, and more where a run would be larger than
    RUN_SIZE_IN_MIB by the optimizer's estimate of df. JOB_TIMEOUT_SECONDS cancels the job; what it has written by then is removed.
    """
    if mode.lower() == "overwrite":
        raise ValueError("overwrite would need the table truncated; use append")
    if mode.lower() != "append":
        raise ValueError(f"unknown mode {mode}")
    o = write_options(options)
    if o["DATA_TRANSPORT"] != "DIRECT" and transport is None:
        raise ValueError(f"{o['DATA_TRANSPORT']} needs a transport")
    spark = df.sparkSession
    level, center = str(o["BULK_WRITER_CL"]), o["LOCAL_DC"]
    if ring:
        check_availability(ring, level, center)
    workers = max(spark.sparkContext.defaultParallelism, -(-estimated_bytes(df) // (int(o["RUN_SIZE_IN_MIB"]) << 20)))
    splits = int(o["NUMBER_SPLITS"])
    parts = TokenPartitioner.of_ring(ring, workers, splits=splits).parts if ring else split_range(MIN_TOKEN, MAX_TOKEN, splits if splits > 0 else workers)
    job = str(o["JOB_ID"] or uuid.uuid4())
    out, began = f"{path.rstrip('/')}/{job}", time.time()
    if transport:
        transport.started(job)
    try:
        with time_limit(spark, job, f"bulk write to {spec.keyspace}.{spec.name}", int(o["JOB_TIMEOUT_SECONDS"])):
            log = dealt_by_token(log_of(df, spec, options, now_micros), spec, parts).drop("_part")
            log.write.mode("append").parquet(out)
            manifest = manifest_of(spark, out, spec, str(o["DIGEST"]))
            totals = manifest.agg(F.sum("rows").alias("rows"), F.sum("length").alias("bytes")).first()
            if not o["SKIP_EXTENDED_VERIFY"]:
                verify(spark, out, spec)
            if ring:
                check_availability(ring, level, center)
        if transport:
            for row in bundles(manifest, int(o["MAX_SIZE_PER_BUNDLE_IN_BYTES"])).toLocalIterator():
                transport.bundle_ready(job, row.asDict(True))
            transport.finished(job, int(totals["rows"] or 0))
    except BaseException as e:
        if isinstance(e, TimeoutError) and not o["JOB_ID"]:  # a given job's folder may hold earlier runs
            target = spark._jvm.org.apache.hadoop.fs.Path(out)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        if transport:
            transport.failed(job, e)
        raise
    return Written(job, out, int(totals["rows"] or 0), int(totals["bytes"] or 0), time.time() - began, manifest)


def write_log(log: DataFrame, spec: TableSpec, path: str, parts: int | None = None) -> None:
    """Adds rows that are a log already (writes and deletes with their marks) to path as runs in order of tokens."""
    with_key = log.withColumn("_key", key_bytes(spec))
    ready = with_key.withColumn("token", murmur3_token(F.col("_key")))
    dealt_by_token(ready, spec, split_range(MIN_TOKEN, MAX_TOKEN, parts or log.sparkSession.sparkContext.defaultParallelism)).drop("_part").write.mode("append").parquet(path)


def verify(spark: SparkSession, path: str, spec: TableSpec) -> None:
    """Reads a set of runs back: every row must have its keys and the token that its key hashes to."""
    data = spark.read.parquet(path)
    wrong = data.filter(F.col("token").isNull() | (F.col("token") != murmur3_token(key_bytes(spec))))
    if n := wrong.count():
        raise RuntimeError(f"{n} rows of {path} don't have their key's token")


def coordinated_write(df: DataFrame, targets: dict[str, tuple[TableSpec, str, Ring]], options: dict[str, object] | None = None) -> dict[str, Written]:
    """One write to several clusters: {id: (spec, path, ring)}. Rings must share a partitioner; all are checked before any is written."""
    if len({r.partitioner for _, _, r in targets.values()}) > 1:
        raise ValueError("clusters with different partitioners can't be written together")
    o = write_options(options)
    conf = json.loads(str(o["COORDINATED_WRITE_CONFIG"] or "{}"))
    for name, (spec, _, ring) in targets.items():
        validate(df, spec, options)
        check_availability(ring, str(o["BULK_WRITER_CL"]), conf.get(name, {}).get("localDc", o["LOCAL_DC"]))
    now = int(time.time() * 1e6)
    return {name: bulk_write(df, spec, path, {**(options or {}), "LOCAL_DC": conf.get(name, {}).get("localDc", o["LOCAL_DC"])}, ring, now_micros=now) for name, (spec, path, ring) in targets.items()}
