"""What the operators share: column access over Arrow buffers, hashing, and folders.

Texts are handled as the UTF-8 bytes of Arrow's own buffers, in runs of whole documents of about
``CHUNK`` bytes, so that a worker's memory does not depend on the size of an Arrow batch. One document
longer than that is a run of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 1 << 20
#: \x09-\x0D and \x20
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


#: Bytes of an Arrow batch between the JVM and a worker; both sides hold a few at a time.
BATCH_BYTES = 4 << 20
#: Files of a written table for each core at most, and those of one that holds links or lists rather than texts.
FILES, FEW_FILES = 16, 4


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    limit = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    if limit is None or not limit.isdigit() or int(limit) > BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir; a folder in /tmp only where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = "file://" + os.path.join(tempfile.gettempdir(), "checkpoints")
        spark.conf.set("spark.checkpoint.dir", found)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def written(df: DataFrame, name: str, files: int = FILES) -> DataFrame:
    """df as a table in the shared folder: its lineage ends there, and a lost executor costs nothing.

    It gets no more than so many files for each core; beyond that a task takes several partitions in turn.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.coalesce(files * spark.sparkContext.defaultParallelism).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    for made in _MADE:
        made.append(out)
    return out


#: Tables made since each ``own_tables`` that has not ended yet.
_MADE: list[list[DataFrame]] = []


@contextmanager
def own_tables() -> Iterator[None]:
    """Removes, at the end or when it fails, all tables made inside by ``written``; what leaves has to be written outside."""
    made: list[DataFrame] = []
    _MADE.append(made)
    try:
        yield
    finally:
        _MADE.remove(made)
        dropped(*made)


def kept_table(df: DataFrame, name: str, files: int = FILES) -> DataFrame:
    """df as a written table that outlives the ``own_tables`` it is made in."""
    out = written(df, name, files)
    for made in _MADE:
        made.remove(out)
    return out


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared file system."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def dropped(*tables: DataFrame) -> None:
    """Removes tables made by ``written`` that nothing will read again."""
    for df in tables:
        removed(df.sparkSession, df.written_at)


def free(df: DataFrame, name: str) -> str:
    """name, or one like it that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(key: str, n: int) -> Column:
    """crc32 of the key's text, modulo n; a null key falls in fold 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % n, F.lit(0))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each row begins in them; a null row is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    at = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset :]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def runs(batches: Iterator[pa.RecordBatch], text: str, chunk: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, their bytes, where each begins) for runs of whole rows of about chunk bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        raw, at = bytes_of(batch.column(batch.schema.get_field_index(text)))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(at, at[first] + chunk, "right")) - 1)
            yield batch.slice(first, last - first), raw[at[first] : at[last]], at[first : last + 1] - at[first]
            first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHash:
    """64-bit hashes of words: differences of prefix sums of byte codes times powers of an odd base."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, lower: bool = True, space: np.ndarray = SPACE):
        self.code = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        if lower:
            self.code[65:91] = self.code[97:123]
        self.word = ~space
        self.grown = 0

    def grow(self, n: int) -> None:
        if n > self.grown:
            n = max(n, CHUNK + 1)
            base, back = self.BASE, pow(self.BASE, -1, 1 << 64)
            for name, step in (("power", base), ("inverse", back)):
                steps = np.full(n + 1, step, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
            self.grown = n

    def spans(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where words begin and end, and how many words each row has; words never cross rows."""
        n = len(raw)
        inside = np.zeros(n + 2, dtype=bool)
        inside[1:-1] = self.word[raw]
        edge = np.zeros(n + 1, dtype=bool)
        edge[at] = True
        begin = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
        end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
        return begin, end, np.diff(np.searchsorted(begin, at))

    def __call__(self, raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        self.grow(len(raw))
        total = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(self.code[raw] * self.power[: len(raw)], out=total[1:])
        return mix((total[end] - total[begin]) * self.inverse[begin])


def within(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... within each run of so many elements."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


#: Bytes of text for each shard at most, where shards are made for a whole table.
SHARD_BYTES = 32 << 20


def shards_for(rows: DataFrame, text: str) -> int:
    """How many shards a table's texts take: as many as shuffle partitions, more where those would hold more than SHARD_BYTES each."""
    size = rows.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    return max(partitions(rows.sparkSession), -(-size // SHARD_BYTES))


def dealt(df: DataFrame, n: int) -> DataFrame:
    """(shard, payload) rows with shard k of n in partition k: every task reads one shard."""
    return df.repartitionById(n, F.col("shard")).sortWithinPartitions("shard")


def by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of each value of the first column, from rows ordered by it."""
    held: list[pa.RecordBatch] = []

    def whole() -> pa.RecordBatch:
        out = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        held.clear()
        return out

    for batch in batches:
        key = batch.column(0).to_numpy()
        if held and len(key) and key[0] != held[-1].column(0)[-1].as_py():
            yield whole()
        cuts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]]) if len(key) else np.zeros(0, int)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            held.append(batch.slice(a, b - a))
            if b < len(key):
                yield whole()
    if held:
        yield whole()


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Each shard's payloads, from rows ordered by shard."""
    shard, got = None, []
    for batch in batches:
        for s, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if s != shard:
                if got:
                    yield shard, got
                shard, got = s, []
            got.append(x)
    if got:
        yield shard, got


def packed(*arrays: np.ndarray) -> bytes:
    """Sorted keys and their values as one compressed payload: keys go as differences, byte planes apart."""
    import zstandard

    out = []
    for k, a in enumerate(arrays):
        if k == 0 and len(a):
            a = np.concatenate([a[:1], np.diff(a)])
        plane = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
        out.append(plane.tobytes())
    head = np.array([len(arrays), len(arrays[0]), *(ord(a.dtype.char) for a in arrays)], dtype=np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(out))


def unpacked(payload: bytes) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(payload)
    many, n = np.frombuffer(raw, np.int64, 2)
    kinds = [np.dtype(chr(c)) for c in np.frombuffer(raw, np.int64, many, 16)]
    spot, out = 16 + 8 * int(many), []
    for k, kind in enumerate(kinds):
        a = np.frombuffer(raw, np.uint8, int(n) * kind.itemsize, spot).reshape(kind.itemsize, int(n)).T.copy().view(kind).reshape(-1)
        out.append(np.cumsum(a, dtype=kind) if k == 0 else a)
        spot += int(n) * kind.itemsize
    return out


def totals(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of their values."""
    if not len(keys):
        return keys, *values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], *(np.add.reduceat(v[order], first) for v in values)


def mounted(folder: str) -> str:
    """The path of a shared folder that workers can map files of; it must be a mounted one."""
    scheme, _, rest = folder.partition(":")
    if not rest:
        return folder
    if scheme != "file":
        raise ValueError(f"{folder}: memory mapping needs a mounted shared folder in spark.checkpoint.dir")
    return "/" + rest.lstrip("/")


def saved(path: str, array: np.ndarray) -> None:
    """Writes an array so that a task run twice leaves one whole file."""
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        np.save(f, array)
    os.replace(part, path)
