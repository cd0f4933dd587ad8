"""The table as a source and sink of its own: spark.read.format("widelog") and df.write.format("widelog").

Reading. Options: ddl (CREATE TABLE), udts, path or paths (comma-separated; the runs of all of them count as one log), now (second at which
expiry is judged, by default the time of the read), columns (comma-separated, to return no others), and those of a read. Each task reads
one token range of all runs at once and merges it partition by partition by the rules of a table read; runs have to be in order of
tokens, as bulk writes and this sink leave them. Key filters (= and in, on every part of the partition key) are pushed and decide which
token ranges are read at all; row groups outside a task's tokens are skipped.

Writing. Options: ddl, udts, path, and those of a bulk write that say what is written (TIMESTAMP, TTL, WRITE_MODE, RUN_SIZE_IN_MIB). Each task
sorts what it gets, up to the size of a run at a time, into runs of their own; a job's runs appear in path together once all its tasks are
done. Only mode append is there. Columns have the table's types or ones that convert without loss; write.normalized makes them so.

Files are opened by Arrow's file systems. For analysis read_table is the faster way in: its merge runs in the JVM, and Catalyst prunes
its columns, which a Python source can't know.
"""

from __future__ import annotations

import heapq
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.tokens import murmur3_tokens
from ..plans.filters import EqualTo, In, key_product, key_values, split_filters
from ..plans.ring import TokenRange
from ..spec import LAST_MODIFIED, TableSpec
from .merging import FROM, MARKS, OP, SET, TO, TTL, WRITETIME, Row, merged
from .read import ReadOptions, whole_ring

#: Bytes of runs for each task of a read, and rows in a batch on their way out.
PART_BYTES, BATCH_ROWS = 64 << 20, 8192


def python_key_bytes(spec: TableSpec, key: tuple) -> bytes:
    """Key bytes of plain values, part by part."""
    import struct
    import uuid

    def one(value: object, kind: str) -> bytes:
        if kind in ("text", "varchar", "ascii"):
            return str(value).encode()
        if kind in ("uuid", "timeuuid"):
            return uuid.UUID(str(value)).bytes
        if kind == "boolean":
            return b"\x01" if value else b"\x00"
        if kind == "blob":
            return bytes(value)
        form = {"bigint": ">q", "int": ">i", "double": ">d"}.get(kind)
        if not form:
            raise ValueError(f"{kind} keys can't be pushed")
        return struct.pack(form, value)

    parts = [one(v, spec.column(n).type.name) for v, n in zip(key, spec.partition_key, strict=True)]
    return parts[0] if len(parts) == 1 else b"".join(struct.pack(">H", len(p)) + p + b"\x00" for p in parts)


def files_of(paths: list[str]) -> list[tuple[str, int]]:
    """(file, bytes) of the runs under paths; hidden files and those of jobs that aren't done are left out."""
    from pyarrow import fs

    out = []
    for path in paths:
        system, inner = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        info = system.get_file_info(inner)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner, recursive=True))
        prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
        for f in found:
            hidden = any(part[:1] in ("_", ".") for part in f.path[len(inner) :].split("/"))
            if f.type == fs.FileType.File and f.path.endswith(".parquet") and not hidden:
                out.append((prefix + f.path, f.size))
    return sorted(out)


class TablePartition(D.InputPartition):
    def __init__(self, part: TokenRange, tokens: tuple[int, ...] | None, files: tuple[str, ...]):
        self.part, self.tokens, self.files = part, tokens, files


class TableReader(D.DataSourceReader):
    """Current rows of the runs under paths."""

    def __init__(self, spec: TableSpec, paths: list[str], schema: T.StructType, options: ReadOptions, now: int):
        self.spec, self.paths, self.names, self.options, self.now = spec, paths, schema.names, options, now
        self.types = [to_arrow_type(f.dataType) for f in schema]
        self.modified = options.last_modified_column_name if options.last_modified_timestamp else None
        self.tokens: tuple[int, ...] | None = None

    def pushFilters(self, filters: list[D.Filter]) -> Iterator[D.Filter]:
        mine, of = [], {}
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else ""
            x = EqualTo(name, f.value) if isinstance(f, D.EqualTo) else In(name, tuple(f.value)) if isinstance(f, D.In) else None
            if x:
                mine.append(x)
                of[id(x)] = f
        pushed, _ = split_filters(mine, self.spec)
        if pushed:
            keys = key_product(list(key_values(pushed, self.spec).values()))
            self.tokens = tuple(sorted({int(t) for t in murmur3_tokens([python_key_bytes(self.spec, k) for k in keys])}))
        yield from filters  # tokens only narrow the read; Spark still evaluates every filter

    def partitions(self) -> list[TablePartition]:
        found = files_of(self.paths)
        files = tuple(f for f, _ in found)
        parts = whole_ring(max(1, self.options.default_parallelism, self.options.num_cores, -(-sum(n for _, n in found) // PART_BYTES)))
        if self.tokens is None:
            return [TablePartition(p, None, files) for p in parts]
        return [TablePartition(p, mine, files) for p in parts if (mine := tuple(t for t in self.tokens if t in p))]

    def _run(self, file: str, part: TokenRange, tokens: tuple[int, ...] | None) -> Iterator[tuple[int, Row]]:
        """(token, row) of one run, of a token range; only the columns that a merge for the schema reads."""
        import pyarrow.parquet as pq
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(file) if "://" in file or file.startswith("file:") else (fs.LocalFileSystem(), file)
        with system.open_input_file(inner) as opened:
            run = pq.ParquetFile(opened)
            have = run.schema_arrow.names
            if "token" not in have or WRITETIME not in have:
                raise ValueError(f"{file} is no run of this source: it lacks token or {WRITETIME}; use read_table")
            wanted = {*self.spec.primary_key, *self.spec.regulars, *self.spec.statics, *MARKS, "token"}
            columns = [n for n in have if n in wanted]
            at, last = have.index("token"), None
            for k in range(run.num_row_groups):
                stats = run.metadata.row_group(k).column(at).statistics if run.metadata.row_group(k).column(at).path_in_schema == "token" else None
                if stats is not None and stats.has_min_max and (stats.max <= part.lower or stats.min > part.upper):
                    continue
                for batch in run.iter_batches(BATCH_ROWS, row_groups=[k], columns=columns):
                    token = batch.column("token").to_numpy()
                    if len(token) and (np.any(token[1:] < token[:-1]) or (last is not None and token[0] < last)):
                        raise ValueError(f"{file} is not in order of tokens")
                    last = token[-1] if len(token) else last
                    keep = (token > part.lower) & (token <= part.upper)
                    if tokens is not None:
                        keep &= np.isin(token, tokens)
                    if keep.any():
                        for row in batch.filter(pa.array(keep)).to_pylist():
                            if not isinstance(row[WRITETIME], int):
                                raise ValueError(f"{WRITETIME} of {file} must be a long")
                            yield row["token"], row

    def read(self, partition: TablePartition) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        runs = [self._run(f, partition.part, partition.tokens) for f in partition.files]
        rows = merged(heapq.merge(*runs, key=lambda x: x[0]), self.spec, self.now, self.modified)
        held: list[Row] = []

        def batch() -> pa.RecordBatch:
            columns = [pa.array([r[n] for r in held], pa.int64() if n == self.modified else None if pa.types.is_timestamp(t) else t) for n, t in zip(self.names, self.types, strict=True)]
            held.clear()
            return pa.RecordBatch.from_arrays([c if c.type == t else c.cast(t) for c, t in zip(columns, self.types, strict=True)], names=self.names)

        for row in rows:
            held.append(row)
            if len(held) == BATCH_ROWS:
                yield batch()
        if held:
            yield batch()


@dataclass
class Runs(D.WriterCommitMessage):
    rows: int
    files: list[str]


class TableWriter(D.DataSourceArrowWriter):
    """Sorted runs of a job, first in a hidden folder."""

    def __init__(self, spec: TableSpec, path: str, schema: T.StructType, options: dict[str, object], now_micros: int):
        from .write import DELETE_PARTITION, PerWrite, check_columns

        check_columns(schema.names, spec, options)
        self.spec, self.path, self.names, self.options, self.now = spec, path.rstrip("/"), schema.names, options, now_micros
        self.kinds = {f.name: f.dataType for f in schema}
        self.ttl, self.at = PerWrite.of(options["TTL"]), PerWrite.of(options["TIMESTAMP"])
        self.op = "delete_partition" if options["WRITE_MODE"] == DELETE_PARTITION else "insert"
        self.job = str(options["JOB_ID"] or uuid.uuid4())

    def _system(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)

    def _run_of(self, batches: list[pa.RecordBatch]) -> pa.Table:
        """A run: the table's columns in its types, with token and marks, in order of token, key and clustering key."""
        given = pa.Table.from_batches(batches)
        types = {f.name: to_arrow_type(f.dataType) for f in self.spec.struct_type()}
        own = [n for n in self.names if n in types]
        columns = {n: given[n].combine_chunks().cast(types[n], safe=True) for n in own}
        keys = self.spec.primary_key if self.op == "insert" else self.spec.partition_key
        for n in keys:
            if columns[n].null_count:
                raise ValueError(f"null in key column {n}; all key columns must be non-null")
        count = given.num_rows
        raw = [python_key_bytes(self.spec, k) for k in zip(*(columns[n].to_pylist() for n in self.spec.partition_key), strict=True)]
        columns["_key"] = pa.array(raw, pa.binary())
        columns["token"] = pa.array(np.asarray(murmur3_tokens(raw), np.int64))
        columns[OP] = pa.array([self.op] * count)
        if self.at.column:
            at = given[self.at.column].combine_chunks()
            columns[WRITETIME] = at.cast(pa.timestamp("us")).cast(pa.int64()) if pa.types.is_timestamp(at.type) else at.cast(pa.int64())
            if columns[WRITETIME].null_count:
                raise ValueError("a write time is null")
        else:
            columns[WRITETIME] = pa.array(np.full(count, self.now if self.at.constant is None else self.at.constant, np.int64))
        columns[TTL] = given[self.ttl.column].combine_chunks().cast(pa.int32()) if self.ttl.column else pa.array([self.ttl.constant] * count, pa.int32())
        sets = [n for n in own if n not in keys]
        columns[SET] = pa.array([sets or None] * count, pa.list_(pa.string()))
        order = [("token", "ascending"), ("_key", "ascending"), *((n, "descending" if self.spec.column(n).descending else "ascending") for n in self.spec.clustering_key if n in columns)]
        return pa.table(columns).sort_by(order)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Runs:
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        system, inner = self._system()
        context = TaskContext.get()
        name = f"{context.partitionId()}-{context.attemptNumber()}" if context else uuid.uuid4().hex
        folder = f"{inner}/.{self.job}"
        system.create_dir(folder, recursive=True)
        done, held, size, rows = [], [], 0, 0
        most = int(self.options["RUN_SIZE_IN_MIB"]) << 20

        def run() -> None:
            table = self._run_of(held)
            held.clear()
            file = f"run-{name}-{len(done)}.parquet"
            with system.open_output_stream(f"{folder}/{file}") as out:
                pq.write_table(table, out, row_group_size=100_000)
            done.append(file)

        for batch in iterator:
            if batch.num_rows:
                held.append(batch)
                size, rows = size + batch.nbytes, rows + batch.num_rows
            if size >= most:
                run()
                size = 0
        if held:
            run()
        return Runs(rows, done)

    def commit(self, messages: list[Runs | None]) -> None:
        """Files of attempts that lost go, the others appear at once under the job's name."""
        from pyarrow import fs

        system, inner = self._system()
        hidden = f"{inner}/.{self.job}"
        system.create_dir(hidden, recursive=True)
        wanted = {f for m in messages if m for f in m.files}
        for f in system.get_file_info(fs.FileSelector(hidden)):
            if f.base_name not in wanted:
                system.delete_file(f.path)
        with system.open_output_stream(f"{hidden}/_manifest.json") as out:
            out.write(json.dumps({"job": self.job, "rows": sum(m.rows for m in messages if m), "files": sorted(wanted)}).encode())
        system.move(hidden, f"{inner}/{self.job}")

    def abort(self, messages: list[Runs | None]) -> None:
        from pyarrow import fs

        system, inner = self._system()
        if system.get_file_info(f"{inner}/.{self.job}").type == fs.FileType.Directory:
            system.delete_dir(f"{inner}/.{self.job}")


class TableSource(D.DataSource):
    #: Options that the source has beside those of a read or of a write.
    OWN = ("ddl", "udts", "paths", "path", "now", "columns")

    @classmethod
    def name(cls) -> str:
        return "widelog"

    def _spec(self) -> TableSpec:
        return TableSpec.from_ddl(self.options["ddl"], udts=tuple(x for x in self.options.get("udts", "").split("\n") if x))

    def _others(self) -> dict[str, str]:
        return {k: v for k, v in self.options.items() if k.lower() not in self.OWN}

    def schema(self) -> T.StructType:
        options = ReadOptions.of(self._others())
        chosen = [c.strip() for c in self.options.get("columns", "").split(",") if c.strip()]
        fields = [T.StructField(f.name, f.dataType, True) for f in self._spec().struct_type() if not chosen or f.name in chosen]
        if options.last_modified_timestamp:
            fields.append(T.StructField(options.last_modified_column_name or LAST_MODIFIED, T.TimestampType(), True))
        return T.StructType(fields)

    def reader(self, schema: T.StructType) -> TableReader:
        paths = [p for p in (self.options.get("paths") or self.options.get("path") or "").split(",") if p]
        if not paths:
            raise ValueError("a path is needed")
        return TableReader(self._spec(), paths, schema, ReadOptions.of(self._others()), int(self.options.get("now") or time.time()))

    def writer(self, schema: T.StructType, overwrite: bool) -> TableWriter:
        from .write import write_options

        if overwrite:
            raise ValueError("overwrite would need the table truncated; use append")
        return TableWriter(self._spec(), self.options["path"], schema, write_options(self._others()), int(time.time() * 1e6))


def register(spark: SparkSession) -> SparkSession:
    """Makes format("widelog") known to a session and lets it push filters."""
    spark.dataSource.register(TableSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def token_of(spec: TableSpec, key: tuple) -> int:
    return int(np.int64(murmur3_tokens([python_key_bytes(spec, key)])[0]))


__all__ = ["FROM", "TO", "TableSource", "files_of", "python_key_bytes", "register", "token_of"]
