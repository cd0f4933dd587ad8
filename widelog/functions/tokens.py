"""Tokens of partition keys: key bytes, hashes, and the order of both."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import TableSpec

MIN_TOKEN, MAX_TOKEN = -(1 << 63), (1 << 63) - 1
RANDOM_MAX = (1 << 127) - 1
_C1, _C2 = np.uint64(0x87C37B91114253D5), np.uint64(0x4CF5AD432745937F)


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _final(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def murmur3_of_length(keys: np.ndarray) -> np.ndarray:
    """Tokens of keys of one length, a row of bytes each.

    This is the 128-bit Murmur3 of x64 with seed 0, of which the first half is taken, but for one thing: bytes after the last
    whole block of 16 count as signed. The least long is no token and becomes the largest.
    """
    n, size = keys.shape
    h1 = h2 = np.zeros(n, np.uint64)
    whole = size // 16
    words = np.ascontiguousarray(keys[:, : whole * 16]).view("<u8").reshape(n, whole * 2).astype(np.uint64)
    for b in range(whole):
        k1, k2 = words[:, 2 * b], words[:, 2 * b + 1]
        h1 = h1 ^ _rotated(k1 * _C1, 31) * _C2
        h1 = (_rotated(h1, 27) + h2) * np.uint64(5) + np.uint64(0x52DCE729)
        h2 = h2 ^ _rotated(k2 * _C2, 33) * _C1
        h2 = (_rotated(h2, 31) + h1) * np.uint64(5) + np.uint64(0x38495AB5)
    tail = keys[:, whole * 16 :].view(np.int8).astype(np.int64).view(np.uint64)
    parts = [np.zeros(n, np.uint64), np.zeros(n, np.uint64)]
    for i in range(tail.shape[1]):
        parts[i // 8] = parts[i // 8] ^ (tail[:, i] << np.uint64(8 * (i % 8)))
    if tail.shape[1] > 8:
        h2 = h2 ^ _rotated(parts[1] * _C2, 33) * _C1
    if tail.shape[1]:
        h1 = h1 ^ _rotated(parts[0] * _C1, 31) * _C2
    h1, h2 = h1 ^ np.uint64(size), h2 ^ np.uint64(size)
    h1 = h1 + h2
    h2 = h2 + h1
    h1, h2 = _final(h1), _final(h2)
    out = (h1 + h2).view(np.int64).copy()
    out[out == MIN_TOKEN] = MAX_TOKEN
    return out


def murmur3_tokens(keys: list[bytes]) -> np.ndarray:
    """Tokens of keys of any lengths."""
    size = np.array([len(k) for k in keys])
    out = np.zeros(len(keys), np.int64)
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        out[at] = murmur3_of_length(np.frombuffer(b"".join(keys[k] for k in at), np.uint8).reshape(len(at), int(n))) if n else 0
    return out


@F.pandas_udf(T.LongType())
def murmur3_token(keys: pd.Series) -> pd.Series:
    """Token of each key's bytes; null for null."""
    out = pd.Series([None] * len(keys), dtype="Int64")
    there = keys.notna().to_numpy()
    out[there] = murmur3_tokens([bytes(k) for k in keys[there]])
    return out


def random_token_of(key: bytes) -> int:
    """MD5 as a signed number, without its sign: 0 to 2**127."""
    return abs(int.from_bytes(hashlib.md5(key).digest(), "big", signed=True))


@F.pandas_udf(T.StringType())
def random_token(keys: pd.Series) -> pd.Series:
    """Token as 39 digits, so that text order is number order; it can exceed Spark's largest decimal."""
    return keys.map(lambda k: None if k is None else f"{random_token_of(bytes(k)):039d}")


@F.pandas_udf(T.BinaryType())
def _double_bytes(values: pd.Series) -> pd.Series:
    raw = values.to_numpy(dtype=">f8").tobytes()
    return pd.Series([None if pd.isna(v) else raw[8 * i : 8 * i + 8] for i, v in enumerate(values)])


@F.pandas_udf(T.BinaryType())
def _float_bytes(values: pd.Series) -> pd.Series:
    raw = values.to_numpy(dtype=">f4").tobytes()
    return pd.Series([None if pd.isna(v) else raw[4 * i : 4 * i + 4] for i, v in enumerate(values)])


def _big_endian(value: Column, size: int) -> Column:
    """The lowest size bytes of a number, JVM-side."""
    return F.unhex(F.lpad(F.right(F.hex(value.cast("long")), F.lit(2 * size)), 2 * size, "0"))


def value_bytes(column: Column, type_name: str) -> Column:
    """A key part's bytes by its type."""
    if type_name in ("text", "varchar", "ascii"):
        return F.encode(column, "UTF-8")
    if type_name in ("blob", "inet"):
        return column
    if type_name in ("uuid", "timeuuid"):
        return F.unhex(F.replace(column, F.lit("-"), F.lit("")))
    if type_name == "timestamp":
        return _big_endian(F.unix_millis(column.cast("timestamp")), 8)
    if type_name == "date":
        return _big_endian(F.unix_date(column).cast("long") + F.lit(1 << 31), 4)
    if type_name == "boolean":
        return F.when(column, F.unhex(F.lit("01"))).otherwise(F.when(~column, F.unhex(F.lit("00"))))
    if type_name in ("double", "float"):
        return (_double_bytes if type_name == "double" else _float_bytes)(column)
    sizes = {"bigint": 8, "time": 8, "int": 4, "smallint": 2, "tinyint": 1}
    if type_name not in sizes:
        raise ValueError(f"{type_name} can't be part of a key's bytes")
    return _big_endian(column, sizes[type_name])


def key_bytes(spec: TableSpec) -> Column:
    """A partition key's bytes: one part as it is, several each with a two-byte length before and a zero byte after."""
    parts = [value_bytes(F.col(f"`{n}`"), spec.column(n).type.name) for n in spec.partition_key]
    if len(parts) == 1:
        return parts[0]
    return F.concat(*[x for p in parts for x in (_big_endian(F.octet_length(p), 2), p, F.unhex(F.lit("00")))])


def with_token(df: DataFrame, spec: TableSpec, partitioner: str = "murmur3", column: str = "token") -> DataFrame:
    """df with each row's token; a null in a key part gives a null token."""
    return df.withColumn(column, (murmur3_token if partitioner == "murmur3" else random_token)(key_bytes(spec)))
