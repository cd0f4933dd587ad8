"""Which filters go down to partition keys, and what keys they name.

Names are resolved by one rule throughout: case does not matter unless the session says so.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tokens import key_bytes, murmur3_token, murmur3_tokens
from ..spec import TableSpec
from .ring import TokenRange


@dataclass(frozen=True)
class EqualTo:
    column: str
    value: object

    @property
    def values(self) -> tuple:
        return (self.value,)


@dataclass(frozen=True)
class In:
    column: str
    values: tuple


@dataclass(frozen=True)
class Other:
    """Any other filter; Spark evaluates it above the scan."""

    text: str
    column: str = ""


def split_filters(filters: list, spec: TableSpec, case_sensitive: bool = False) -> tuple[list, list]:
    """(pushed, left to Spark). All or nothing: filters are pushed only if they fix every part of the partition key."""
    same = (lambda s: s) if case_sensitive else str.lower
    missing = {same(k) for k in spec.partition_key}
    pushed, rest = [], []
    for f in filters:
        if isinstance(f, (EqualTo, In)) and same(f.column) in missing:
            missing.discard(same(f.column))
            pushed.append(f)
        else:
            rest.append(f)
    return ([], list(filters)) if missing else (pushed, rest)


def key_values(filters: list, spec: TableSpec, case_sensitive: bool = False) -> dict[str, list]:
    """Values of each partition key column, in key order."""
    same = (lambda s: s) if case_sensitive else str.lower
    names = {same(k): k for k in spec.partition_key}
    found: dict[str, list] = {}
    for f in filters:
        name = names.get(same(getattr(f, "column", "")))
        if name and isinstance(f, (EqualTo, In)):
            if name in found:
                raise ValueError(f"several filters on partition key column {name}")
            found[name] = list(f.values)
    if found and len(found) < len(names):
        raise ValueError("all partition key parts must be restricted by = or in")
    return {k: found[k] for k in spec.partition_key if k in found}


def key_product(values: list[list]) -> list[tuple]:
    """Every key that the values of its parts make."""
    if any(not v for v in values):
        raise ValueError("an empty list of key values")
    return list(product(*values)) if values else []


def filtered_keys(df: DataFrame, filters: list, spec: TableSpec) -> DataFrame:
    """df restricted to the keys that filters name, as plain predicates that reach the scan."""
    conditions = [F.col(f"`{name}`").isin(*values) for name, values in key_values(filters, spec).items()]
    return df.filter(reduce(lambda a, b: a & b, conditions)) if conditions else df


def keys_frame(df: DataFrame, keys: list[tuple], spec: TableSpec) -> DataFrame:
    """Rows of df with one of many keys, by a semi-join; a set of keys small enough is broadcast by its size."""
    wanted = df.sparkSession.createDataFrame(keys, df.select(*[f"`{k}`" for k in spec.partition_key]).schema)
    return df.join(wanted, spec.partition_key, "left_semi")


@dataclass(frozen=True)
class KeyFilter:
    """One partition key by its bytes and token."""

    key: bytes
    token: int

    @classmethod
    def of(cls, key: bytes) -> KeyFilter:
        return cls(key, int(murmur3_tokens([key])[0]))

    @property
    def range(self) -> TokenRange:
        return TokenRange.singleton(self.token)

    def overlaps(self, part: TokenRange) -> bool:
        return self.token in part

    def matches(self, key: bytes) -> bool:
        return self.key == key


def key_filters(df: DataFrame, keys: list[tuple], spec: TableSpec) -> list[KeyFilter]:
    """Bytes and tokens of a list of keys."""
    frame = df.sparkSession.createDataFrame(keys, df.select(*[f"`{k}`" for k in spec.partition_key]).schema)
    return [KeyFilter(bytes(r["k"]), r["t"]) for r in frame.select(key_bytes(spec).alias("k"), murmur3_token(key_bytes(spec)).alias("t")).collect()]


def tasks_for(filters: list[KeyFilter], parts: list[TokenRange]) -> list[TokenRange]:
    """Parts that some key filter falls in; all of them without key filters."""
    return [p for p in parts if not filters or any(f.overlaps(p) for f in filters)]


def in_range(part: TokenRange, token: str = "token") -> Column:
    return part.predicate(F.col(token))
