"""Token ranges, rings of replicas, and how ranges are dealt to tasks. All ranges are open below and closed above."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.tokens import MAX_TOKEN, MIN_TOKEN, RANDOM_MAX
from ..spec import Replication

BOUNDS = {"murmur3": (MIN_TOKEN, MAX_TOKEN), "random": (-1, RANDOM_MAX)}


@dataclass(frozen=True, order=True)
class TokenRange:
    lower: int
    upper: int

    def __post_init__(self) -> None:
        if self.lower > self.upper:
            raise ValueError("a token range doesn't wrap around")

    @classmethod
    def closed(cls, first: int, last: int) -> TokenRange:
        return cls(first - 1, last)

    @classmethod
    def singleton(cls, token: int) -> TokenRange:
        return cls(token - 1, token)

    @property
    def size(self) -> int:
        return self.upper - self.lower

    @property
    def is_empty(self) -> bool:
        return self.lower == self.upper

    def __contains__(self, token: int) -> bool:
        return self.lower < token <= self.upper

    def encloses(self, other: TokenRange) -> bool:
        return self.lower <= other.lower and other.upper <= self.upper

    def is_connected(self, other: TokenRange) -> bool:
        """Whether nothing lies between the two."""
        return self.lower <= other.upper and other.lower <= self.upper

    def overlaps(self, other: TokenRange) -> bool:
        return max(self.lower, other.lower) < min(self.upper, other.upper)

    def intersection(self, other: TokenRange) -> TokenRange:
        if not self.is_connected(other):
            raise ValueError(f"{self} and {other} are apart")
        return TokenRange(max(self.lower, other.lower), min(self.upper, other.upper))

    def span(self, other: TokenRange) -> TokenRange:
        return TokenRange(min(self.lower, other.lower), max(self.upper, other.upper))

    def predicate(self, token: Column) -> Column:
        return (token > F.lit(self.lower)) & (token <= F.lit(self.upper))


def split_range(lower: int, upper: int, parts: int) -> list[TokenRange]:
    """Parts of nearly equal size, the larger ones first; fewer than asked for if there aren't as many tokens."""
    whole = TokenRange(lower, upper)
    if parts < 1:
        raise ValueError("at least one part")
    parts = min(parts, whole.size)
    if not parts:
        return []
    each, more = divmod(whole.size, parts)
    ends = [lower]
    for k in range(parts):
        ends.append(ends[-1] + each + (k < more))
    return [TokenRange(a, b) for a, b in zip(ends, ends[1:], strict=False)]


@dataclass(frozen=True)
class Instance:
    token: int
    node: str
    data_center: str = ""
    status: str = "UP"
    state: str = "NORMAL"
    cluster: str = ""


def token_ranges(instances: list[Instance], replicas: int, partitioner: str = "murmur3") -> dict[Instance, list[TokenRange]]:
    """Ranges that each instance holds when each range has so many replicas around the ring."""
    if replicas < 1:
        raise ValueError("a replication factor of 0 has no ranges")
    if instances and replicas > len(instances):
        raise ValueError(f"{replicas} replicas of {len(instances)} instances")
    low, high = BOUNDS[partitioner]
    ring = sorted(instances, key=lambda i: i.token)
    out: dict[Instance, list[TokenRange]] = {}
    for k, owner in enumerate(ring):
        start, end = ring[k - replicas].token, owner.token
        if start < end:
            out[owner] = [TokenRange(start, end)]
        else:
            out[owner] = [r for r in (TokenRange(start, high), TokenRange(low, end)) if not r.is_empty]
    return out


def overlay(held: dict[Instance, list[TokenRange]], whole: TokenRange | None = None) -> list[tuple[TokenRange, tuple[Instance, ...]]]:
    """Disjoint ranges in order, each with the instances that hold it."""
    cuts = {x for ranges in held.values() for r in ranges for x in (r.lower, r.upper)} | ({whole.lower, whole.upper} if whole else set())
    points = sorted(cuts)
    at = {p: k for k, p in enumerate(points)}
    owners: list[list[Instance]] = [[] for _ in points[1:]]
    for i, ranges in held.items():
        for r in ranges:
            for k in range(at[r.lower], at[r.upper]):
                owners[k].append(i)
    return [(TokenRange(a, b), tuple(o)) for a, b, o in zip(points, points[1:], owners, strict=False)]


class Ring:
    """Instances with their replication: which nodes hold which range."""

    def __init__(self, instances: Iterable[Instance], replication: Replication, partitioner: str = "murmur3"):
        self.instances, self.replication, self.partitioner = tuple(sorted(instances, key=lambda i: i.token)), replication, partitioner
        low, high = BOUNDS[partitioner]
        if replication.strategy == "NetworkTopologyStrategy":
            held: dict[Instance, list[TokenRange]] = {}
            for center, n in replication.options.items():
                if n:
                    held |= token_ranges([i for i in self.instances if i.data_center == center], n, partitioner)
        elif replication.strategy == "SimpleStrategy":
            held = token_ranges(list(self.instances), replication.total, partitioner)
        else:
            held = {i: [TokenRange(low, high)] for i in self.instances}
        self.held = held
        self.ranges = overlay(held, TokenRange(low, high))

    def replicas(self, token: int) -> tuple[Instance, ...]:
        k = bisect_left([r.upper for r, _ in self.ranges], token)
        return self.ranges[k][1] if k < len(self.ranges) and token in self.ranges[k][0] else ()

    def within(self, whole: TokenRange) -> list[tuple[TokenRange, tuple[Instance, ...]]]:
        return [(r.intersection(whole), o) for r, o in self.ranges if r.overlaps(whole)]

    def to_df(self, spark: SparkSession) -> DataFrame:
        """(lower, upper, node, data_center, status, state), a row for each range and replica. Murmur3 rings only."""
        rows = [(r.lower, r.upper, i.node, i.data_center, i.status, i.state) for r, o in self.ranges for i in o]
        return spark.createDataFrame(rows, "lower long, upper long, node string, data_center string, status string, state string")


class TokenPartitioner:
    """Sub-ranges for tasks, in order; each ring range is cut into so many that all cores have work."""

    def __init__(self, ranges: list[TokenRange], parallelism: int, cores: int = 1, splits: int = -1, partitioner: str = "murmur3"):
        if splits < 0:
            splits = -(-max(parallelism, cores, 1) // max(len(ranges), 1))
        self.splits = max(splits, 1)
        self.parts = [p for r in sorted(ranges) for p in split_range(r.lower, r.upper, self.splits)]
        low, high = BOUNDS[partitioner]
        ends = [low, *(p.upper for p in self.parts)]
        if [p.lower for p in self.parts] != ends[:-1] or ends[-1] != high:
            raise ValueError("token ranges overlap or leave gaps")

    @classmethod
    def of_ring(cls, ring: Ring, parallelism: int, cores: int = 1, splits: int = -1) -> TokenPartitioner:
        return cls([r for r, _ in ring.ranges], parallelism, cores, splits, ring.partitioner)

    def __len__(self) -> int:
        return len(self.parts)

    def part_of(self, token: int) -> int:
        k = bisect_left([p.upper for p in self.parts], token)
        if k >= len(self.parts) or token not in self.parts[k]:
            raise ValueError(f"no range holds token {token}")
        return k


#: Up to so many parts are found by an expression; beyond it would outgrow code generation.
IN_AN_EXPRESSION = 256


def range_number(parts: list[TokenRange], token: Column) -> Column:
    """The number of the part that each token is in, by halving the sorted upper ends: in an expression, or in Arrow batches where there are many."""
    ends = [p.upper for p in parts]
    if len(parts) > IN_AN_EXPRESSION:
        sorted_ends = np.array(ends, np.int64)  # 8 bytes a part go along with the plan

        @F.pandas_udf(T.IntegerType())
        def place(tokens: pd.Series) -> pd.Series:
            return pd.Series(np.minimum(np.searchsorted(sorted_ends, tokens.to_numpy(np.int64)), len(sorted_ends) - 1).astype(np.int32))

        return F.when(token.isNotNull(), place(F.coalesce(token.cast("long"), F.lit(0).cast("long"))))

    def halved(a: int, b: int) -> Column:
        if a == b:
            return F.lit(a)
        mid = (a + b) // 2
        return F.when(token <= F.lit(ends[mid]), halved(a, mid)).otherwise(halved(mid + 1, b))

    return F.when(token.isNotNull(), halved(0, len(ends) - 1))


#: Up to so many parts go to every task; beyond it they meet rows in a shuffled join.
BROADCAST_PARTS = 500_000


def parts_of(df: DataFrame, parts: list[TokenRange], token: str = "token") -> DataFrame:
    """df with lower and upper of the range that each row's token is in; rows outside all leave.

    Ranges are listed under the leading bits of the tokens they hold, some four such numbers for each range, so that a row meets
    the one or two ranges of its own number in a hash join. The list is a few times as long as parts.
    """
    some = [p for p in parts if not p.is_empty]
    span = max((p.upper for p in some), default=1) - min((p.lower for p in some), default=0)
    drop = max(0, span.bit_length() - (4 * len(some)).bit_length())
    rows = [(b, p.lower, p.upper) for p in some for b in range((p.lower + 1) >> drop, (p.upper >> drop) + 1)]
    ranges = df.sparkSession.createDataFrame(rows, "__leading long, lower long, upper long")
    within = (F.shiftright(F.col(token).cast("long"), drop) == F.col("__leading")) & (F.col(token) > F.col("lower")) & (F.col(token) <= F.col("upper"))
    return df.join(F.broadcast(ranges) if len(rows) <= BROADCAST_PARTS else ranges, within).drop("__leading")


def consolidated(*rings: Ring) -> list[tuple[TokenRange, tuple[Instance, ...]]]:
    """One map of ranges to replicas over several clusters that share a partitioner."""
    if len({r.partitioner for r in rings}) > 1:
        raise ValueError("clusters with different partitioners can't be written together")
    held: dict[Instance, list[TokenRange]] = {}
    for r in rings:
        for i, ranges in r.held.items():
            held.setdefault(i, []).extend(ranges)
    return overlay(held)
