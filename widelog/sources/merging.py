"""Merge on read of one partition at a time in plain Python, for the table source. It follows the rules of ``operators.merge``."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

from ..spec import TableSpec

# Marks of a log; as operators.merge names them, which workers of the source don't import.
WRITETIME, OP, TTL, SET, FROM, TO = "_writetime", "_op", "_ttl", "_set", "_from", "_to"
MARKS = (WRITETIME, OP, TTL, SET, FROM, TO)
WRITES = ("insert", "update")
Row = dict[str, object]


def order(value: object) -> tuple:
    """A key by which values of one type order as the engine orders them: null first, NaN last, collections by their parts."""
    if value is None:
        return (0,)
    if isinstance(value, float) and math.isnan(value):
        return (2,)
    if isinstance(value, dict):
        return (1, tuple(map(order, value.values())))
    if isinstance(value, (list, tuple)):
        return (1, tuple(map(order, value)))
    return (1, value)


class Cell:
    """The newest write of one thing."""

    def __init__(self) -> None:
        self.rank: tuple | None = None
        self.at, self.until, self.gone, self.value = 0, None, False, None

    def offer(self, at: int, until: int | None, gone: bool, value: object, is_map: bool) -> None:
        rank = (at, gone, order(sorted(value, key=order) if is_map and value is not None else value), order(until))
        if self.rank is None or rank > self.rank:
            self.rank, self.at, self.until, self.gone, self.value = rank, at, until, gone, value

    def live(self, deleted: float, now: int) -> bool:
        return self.rank is not None and not self.gone and self.at > deleted and (self.until is None or self.until > now)


class Partition:
    """All that a log says about one partition key."""

    def __init__(self, spec: TableSpec):
        self.spec = spec
        self.maps = {c.name for c in spec.columns if c.type.kind == "map"}
        self.first = spec.clustering_key[0] if spec.clustering_key else None
        self.gone = -math.inf
        self.ranges: list[tuple[object, object, int]] = []
        self.rows: dict[tuple, tuple[dict[str, Cell], Cell, list[float], tuple]] = {}
        self.statics = {n: Cell() for n in spec.statics}

    def add(self, row: Row) -> None:
        at, op, ttl = row[WRITETIME], row.get(OP) or "insert", row.get(TTL)
        ttl = self.spec.default_ttl if ttl is None else ttl
        until = at // 1_000_000 + ttl if ttl and ttl > 0 else None
        if op == "delete_partition":
            self.gone = max(self.gone, at)
            return
        if op == "delete_range":
            self.ranges.append((row.get(FROM), row.get(TO), at))
            return
        named = row.get(SET)

        def sets(name: str) -> bool:
            return name in named if named is not None else op in WRITES

        def offer(cell: Cell, name: str) -> None:
            value = row.get(name)
            cell.offer(at, until, op == "delete_columns" or value is None, value, name in self.maps)

        if op != "delete_row":
            for name, cell in self.statics.items():
                if sets(name):
                    offer(cell, name)
        key = tuple(row.get(n) for n in self.spec.clustering_key)
        if None in key:
            return
        same = tuple(map(order, key))
        if same not in self.rows:
            self.rows[same] = ({n: Cell() for n in self.spec.regulars}, Cell(), [-math.inf], key)
        cells, marker, deleted, _ = self.rows[same]
        if op == "delete_row":
            deleted[0] = max(deleted[0], at)
            return
        for name, cell in cells.items():
            if sets(name):
                offer(cell, name)
        if op == "insert":
            marker.offer(at, until, False, None, False)

    def _range_deleted(self, key: tuple) -> float:
        here = order(key[0]) if key else ()
        covering = [at for low, high, at in self.ranges if key and (low is None or here >= order(low)) and (high is None or here < order(high))]
        return max(covering, default=-math.inf)

    def current(self, key: dict[str, object], now: int, modified: str | None) -> Iterator[Row]:
        """Rows that are there at second now; modified names a column for the time of a row's last write, in microseconds."""
        static = {n: c for n, c in self.statics.items() if c.live(self.gone, now)}
        shared: Row = {n: static[n].value if n in static else None for n in self.statics}
        newest_static = max((c.at for c in static.values()), default=None)
        found = False
        for same in sorted(self.rows):
            cells, marker, deleted, clustering = self.rows[same]
            end = max(self.gone, deleted[0], self._range_deleted(clustering))
            alive = {n: c for n, c in cells.items() if c.live(end, now)}
            marked = marker.live(end, now)
            if not alive and not marked:
                continue
            found = True
            out = {**key, **dict(zip(self.spec.clustering_key, clustering, strict=True)), **shared, **{n: alive[n].value if n in alive else None for n in cells}}
            if modified:
                others = [t for t in (newest_static, marker.at if marked else None) if t is not None]
                out[modified] = max((c.at for c in alive.values()), default=max(others, default=None))
            yield out
        if static and not found:
            out = {**key, **dict.fromkeys(self.spec.clustering_key), **shared, **dict.fromkeys(self.spec.regulars)}
            if modified:
                out[modified] = newest_static
            yield out


def merged(rows: Iterable[tuple[int, Row]], spec: TableSpec, now: int, modified: str | None) -> Iterator[Row]:
    """Current rows from (token, row) in order of tokens; what is held is the partitions of one token."""
    token, held = None, {}

    def out() -> Iterator[Row]:
        for part, key in held.values():
            yield from part.current(key, now, modified)

    for t, row in rows:
        if t != token:
            yield from out()
            token, held = t, {}
        key = {n: row.get(n) for n in spec.partition_key}
        if None in key.values():
            continue
        same = tuple(map(order, key.values()))
        if same not in held:
            held[same] = (Partition(spec), key)
        held[same][0].add(row)
    yield from out()
