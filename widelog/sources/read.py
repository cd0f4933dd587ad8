"""Reading tables: logs in files, snapshots of their file lists, options, and merged rows."""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tokens import with_token
from ..operators.merge import TTL, WRITETIME, merge_on_read, union_runs
from ..operators.stats import observed
from ..plans.consistency import DEFAULT_READ, split_replicas, validate_read
from ..plans.ring import Ring, TokenPartitioner, TokenRange, parts_of, split_range
from ..spec import LAST_MODIFIED, Replication, TableSpec
from ..types import Decimals

RUN = "_run"


# Options of the remote protocol and of the binary file format, without case and underscores.
REFUSED = frozenset("readindexoffset enableexpansionshrinkcheck sidecarcontactpoints sidecarport maxretries maxbuffersizebytes chunkbuffersizebytes keystorepath keystorepassword truststorepath truststorepassword".split())


@dataclass(frozen=True)
class ReadOptions:
    """Options of a read. Names are matched without regard to case or underscores.

    sizing: "dynamic" makes as many parts as hold max_partition_size GB each, whatever cores and parallelism are. quote_identifiers: names
    that differ in case only are told apart, which sets spark.sql.caseSensitive. enable_stats: the frame read has an observation, read_stats.
    """

    keyspace: str = ""
    table: str = ""
    snapshot_name: str = field(default_factory=lambda: f"sbr_{uuid.uuid4()}")
    create_snapshot: bool = True
    clear_snapshot: bool = True
    clear_snapshot_strategy: str = "onCompletionOrTTL 2d"
    dc: str | None = None
    default_parallelism: int = 1
    num_cores: int = 1
    consistency_level: str = DEFAULT_READ
    enable_stats: bool = False
    last_modified_timestamp: bool = False
    last_modified_column_name: str = LAST_MODIFIED
    sizing: str = "default"
    max_partition_size: int = 1
    use_incremental_repair: bool = True
    quote_identifiers: bool = False
    cache_data_layer: bool = False
    big_number_config: str | None = None

    @classmethod
    def of(cls, given: dict[str, object]) -> ReadOptions:
        plain = lambda s: s.replace("_", "").lower()
        known = {plain(f.name): f for f in fields(cls)}
        out = {}
        for name, value in given.items():
            f = known.get(plain(name))
            if plain(name) in REFUSED:
                raise ValueError(f"read option {name} belongs to a remote protocol or file format and has no effect here")
            if not f:
                raise ValueError(f"unknown read option {name}")
            if f.type == "bool" and isinstance(value, str):
                value = value.lower() == "true"
            out[f.name] = int(value) if f.type == "int" else value
        if plain("last_modified_column_name") in map(plain, given):
            out.setdefault("last_modified_timestamp", True)
        if out.get("sizing", "default") not in ("default", "dynamic"):
            raise ValueError(f"unknown sizing {out['sizing']}")
        return cls(**out)

    @property
    def features(self) -> tuple[str, ...]:
        return (LAST_MODIFIED,) if self.last_modified_timestamp else ()


# How snapshots end, with the time to live of those that have one.
STRATEGIES = {"noop": False, "oncompletion": False, "ttl": True, "oncompletionorttl": True}


@dataclass(frozen=True)
class ClearStrategy:
    name: str
    ttl_seconds: int | None = None

    @classmethod
    def of(cls, text: str) -> ClearStrategy:
        """From "noOp", "onCompletion", "TTL 2d" or "onCompletionOrTTL 2d"."""
        name, _, ttl = text.strip().partition(" ")
        if name.lower() not in STRATEGIES:
            raise ValueError(f"unknown strategy {name}")
        if STRATEGIES[name.lower()] != bool(ttl):
            raise ValueError(f"{name} {'needs' if STRATEGIES[name.lower()] else 'takes no'} time to live")
        if not ttl:
            return cls(name.lower())
        unit = {"s": 1, "m": 60, "h": 3600, "d": 86400}.get(ttl[-1])
        if unit is None or not ttl[:-1].isdigit():
            raise ValueError(f"cannot read time to live {ttl}")
        return cls(name.lower(), int(ttl[:-1]) * unit)


@dataclass
class Snapshot:
    """The files of a table as they were listed when a read was planned; later files don't change the read."""

    name: str
    files: tuple[str, ...]
    taken: float
    strategy: ClearStrategy
    clear: bool = True
    over: bool = False

    @classmethod
    def take(cls, spark: SparkSession, *paths: str, options: ReadOptions | None = None) -> Snapshot:
        options = options or ReadOptions()
        files = tuple(sorted(f for p in paths for f in spark.read.parquet(p).inputFiles()))
        return cls(options.snapshot_name, files, time.time(), ClearStrategy.of(options.clear_snapshot_strategy), options.clear_snapshot)

    def finish(self) -> None:
        """The read is complete: the snapshot goes, if it is to be cleared and its strategy is to clear it then."""
        self.over = self.over or (self.clear and self.strategy.name.startswith("oncompletion"))

    def expired(self, now: float | None = None) -> bool:
        return self.strategy.ttl_seconds is not None and (now or time.time()) > self.taken + self.strategy.ttl_seconds

    def read(self, spark: SparkSession) -> DataFrame:
        """The log, with the file of each row as its run."""
        if self.over or self.expired():
            raise RuntimeError(f"snapshot {self.name} has {'been cleared' if self.over else 'expired'}")
        return spark.read.option("mergeSchema", "true").parquet(*self.files).withColumn(RUN, F.input_file_name())


_CACHE: dict[str, tuple[float, DataFrame]] = {}
CACHE_SECONDS = 12 * 3600


def cached(key: dict[str, object], make) -> DataFrame:
    """The same frame for equal options (but whether a snapshot is made), for twelve hours."""
    text = json.dumps({k: v for k, v in key.items() if k.replace("_", "").lower() != "createsnapshot"}, sort_keys=True, default=str)
    now = time.time()
    for old in [k for k, (made, _) in _CACHE.items() if made < now - CACHE_SECONDS]:
        del _CACHE[old]
    if text not in _CACHE:
        _CACHE[text] = (now, make())
    return _CACHE[text][1]


def read_log(spark: SparkSession, spec: TableSpec, *paths: str, schema_evolution: bool = True) -> DataFrame:
    """A table's log from the files in paths. Columns that files lack are null, those that the table lost are dropped."""
    log = spark.read.option("mergeSchema", str(schema_evolution).lower()).parquet(*paths).withColumn(RUN, F.input_file_name())
    known = set(spec.names)
    return log.select(*[F.col(f"`{c}`") for c in log.columns if c in known or c.startswith("_") or c == "token"])


def read_table(spark: SparkSession, spec: TableSpec, *paths: str, options: dict[str, object] | None = None, replication: Replication | None = None, now: int | None = None, columns: list[str] | None = None, ranges: list[TokenRange] | None = None) -> DataFrame:
    """Current rows of a table from its logs in paths (its runs). now: reference time of expiry, fixed for the read.

    ranges: only partitions with tokens in these; a token column in the files is used for it and lets files be skipped.
    Catalyst puts filters on the partition key below the merge and into the scan, and prunes columns nobody reads.
    """
    opts = ReadOptions.of(options or {})
    if replication:
        validate_read(opts.consistency_level, replication, opts.dc)
    spec = prepared(spark, spec, opts)
    reference = int(time.time()) if now is None else now

    def make() -> DataFrame:
        log = Snapshot.take(spark, *paths, options=opts).read(spark) if opts.create_snapshot else read_log(spark, spec, *paths)
        if ranges is not None:
            if "token" not in log.columns:
                log = with_token(log, spec)
            keep = F.lit(False)
            for r in ranges:
                keep = keep | r.predicate(F.col("token"))
            log = log.filter(keep)
        return finished(merge_on_read(log, spec, reference, columns, opts.features, last_modified=opts.last_modified_column_name), spec, opts)

    return cached({**(options or {}), "spec": spec, "paths": paths, "now": now, "columns": columns, "ranges": ranges}, make) if opts.cache_data_layer else make()


def prepared(spark: SparkSession, spec: TableSpec, opts: ReadOptions) -> TableSpec:
    """spec as the options want it."""
    for name, wanted, own in (("keyspace", opts.keyspace, spec.keyspace), ("table", opts.table, spec.name)):
        if wanted and wanted != own:
            raise ValueError(f"{name} is {wanted}, the table's is {own}")
    if opts.quote_identifiers:
        spark.conf.set("spark.sql.caseSensitive", "true")
    return replace(spec, decimals=Decimals.from_json(opts.big_number_config)) if opts.big_number_config else spec


def finished(df: DataFrame, spec: TableSpec, opts: ReadOptions) -> DataFrame:
    if opts.enable_stats:
        df, seen = observed(df, spec)
        df.read_stats = seen
    return df


def replica_log(spark: SparkSession, spec: TableSpec, ring: Ring, paths: dict[str, str], options: dict[str, object] | None = None) -> DataFrame:
    """The log of a table that each node of a ring has a part of in a path of its own, as one read at a consistency level takes it.

    Every token range is read from as many replicas as the level needs, those that are up first. Rows marked _repaired, which all replicas
    have, come from one of them only, where the options ask for it. Replicas without a path count as down. Tokens are those of the files, or computed.
    """
    opts = ReadOptions.of(options or {})
    there = Ring([i if i.node in paths else replace(i, status="DOWN") for i in ring.instances], ring.replication, ring.partitioner)
    primary: dict[str, list[TokenRange]] = {}
    repaired: dict[str, list[TokenRange]] = {}
    for part, _ in there.ranges:
        if part.is_empty:
            continue
        chosen = split_replicas(opts.consistency_level, there, part, opts.dc, opts.use_incremental_repair)
        if missing := [i.node for i in chosen.primary if i.node not in paths]:
            raise RuntimeError(f"{opts.consistency_level} needs {missing} for {part}, which have no path")
        for i in chosen.primary:
            primary.setdefault(i.node, []).append(part)
            if chosen.repair_primary in (None, i):
                repaired.setdefault(i.node, []).append(part)
    logs = []
    for node, parts in sorted(primary.items()):
        log = spark.read.option("mergeSchema", "true").parquet(paths[node])
        log = log if "token" in log.columns else with_token(log, spec)
        if "_repaired" in log.columns:
            shared = F.coalesce(F.col("_repaired"), F.lit(False))
            logs.append(parts_of(log.filter(~shared), parts).drop("lower", "upper"))
            if node in repaired:
                logs.append(parts_of(log.filter(shared), repaired[node]).drop("lower", "upper"))
        else:
            logs.append(parts_of(log, parts).drop("lower", "upper"))
    return union_runs(*logs)


def read_replicas(spark: SparkSession, spec: TableSpec, ring: Ring, paths: dict[str, str], options: dict[str, object] | None = None, now: int | None = None, columns: list[str] | None = None) -> DataFrame:
    """Current rows of a table from the logs of a ring's replicas."""
    opts = ReadOptions.of(options or {})
    spec = prepared(spark, spec, opts)
    log = replica_log(spark, spec, ring, paths, options)
    return finished(merge_on_read(log, spec, int(time.time()) if now is None else now, columns, opts.features, last_modified=opts.last_modified_column_name), spec, opts)


def token_parts(spec: TableSpec, options: ReadOptions, ranges: list[TokenRange], table_bytes: int = 0) -> list[TokenRange]:
    """Sub-ranges of a read, as many by ring range as cores and parallelism ask for, or by the table's size if sizing is dynamic."""
    if options.sizing == "dynamic":
        return TokenPartitioner(ranges, max(1, -(-table_bytes // (max(1, options.max_partition_size) << 30)))).parts
    return TokenPartitioner(ranges, options.default_parallelism, options.num_cores).parts


def whole_ring(parts: int) -> list[TokenRange]:
    from ..functions.tokens import MAX_TOKEN, MIN_TOKEN

    return split_range(MIN_TOKEN, MAX_TOKEN, parts)


def union_of_runs(*logs: DataFrame) -> DataFrame:
    return union_runs(*logs)


def json_dump(df: DataFrame, path: str) -> None:
    """Rows as JSON lines."""
    df.write.mode("overwrite").json(path)


__all__ = ["ReadOptions", "Snapshot", "ClearStrategy", "read_log", "read_replicas", "read_table", "replica_log", "json_dump", "union_of_runs", "token_parts", "whole_ring", "TTL", "WRITETIME", "RUN"]
