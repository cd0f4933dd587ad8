"""Suffix arrays by external induced sorting.

A text's suffixes are of type L (larger than the next) or S; an S suffix after an L one is a star. Sorted stars induce the
order of all L suffixes in one scan upward, and those induce all S suffixes in one scan downward. What a scan finds for a
larger (or smaller) first symbol waits in a priority queue of (first symbol, arrival) that keeps a block of each bucket in
memory and the rest in files. Queued tuples are (position, common prefix with the tuple queued before in that bucket);
a suffix's common prefix is one more than the least value passed since, so prefixes are carried along by the same scans.

Stars are sorted by the scans themselves: seeded in any order they sort the substrings between stars, whose names make a
string of at most half the length, which is ranked by doubling. Symbols are bytes plus two, 1 closes each text,
and 0 closes the whole. Common prefixes are capped at ``cap``.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator

import numpy as np

SYMBOLS = 258
Sink = Callable[[np.ndarray, np.ndarray], None]


class BucketQueue:
    """Tuples by bucket, first in first out; beyond ``budget`` bytes, what waits goes to a file for each bucket."""

    def __init__(self, folder: str, name: str, budget: int):
        self.path, self.budget, self.held = os.path.join(folder, name), budget, 0
        self.waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.spilled: dict[int, list[int]] = {}

    def push(self, bucket: int, position: np.ndarray, prefix: np.ndarray) -> None:
        if not len(position):
            return
        self.waiting.setdefault(bucket, []).append((position, prefix))
        self.held += 5 * len(position)
        if self.held > self.budget:
            for b in list(self.waiting):
                self._spill(b)
            self.held = 0

    def _spill(self, bucket: int) -> None:
        blocks = self.waiting.pop(bucket)
        with open(f"{self.path}-{bucket}", "ab") as f:
            for position, prefix in blocks:
                self.spilled.setdefault(bucket, []).append(len(position))
                f.write(position.tobytes())
                f.write(prefix.tobytes())

    def pop(self, bucket: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks that wait for a bucket, in order of arrival; also those that arrive while it is read."""
        while bucket in self.spilled or bucket in self.waiting:
            if sizes := self.spilled.pop(bucket, None):
                path = f"{self.path}-{bucket}"
                os.rename(path, path + "-read")
                with open(path + "-read", "rb") as f:
                    for n in sizes:
                        yield np.frombuffer(f.read(4 * n), np.int32), np.frombuffer(f.read(n), np.uint8)
                os.remove(path + "-read")
            else:
                blocks = self.waiting.pop(bucket)
                self.held -= 5 * sum(len(p) for p, _ in blocks)
                if len(blocks) > 1:
                    yield np.concatenate([p for p, _ in blocks]), np.concatenate([x for _, x in blocks])
                else:
                    yield blocks[0]


class LeastSince:
    """For tuples sent on to buckets: the least common prefix passed since the last one sent to the same bucket."""

    def __init__(self) -> None:
        self.least = np.full(SYMBOLS, -1, dtype=np.int16)  # nothing was sent yet: the first one shares nothing

    def __call__(self, passed: np.ndarray, sent: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """passed: prefixes of a block in scan order; sent: which of them send something; bucket: where to.

        Returns the order of sent tuples by bucket, and each one's prefix in that order.
        """
        order = np.argsort(bucket, kind="stable")
        at, to = sent[order], bucket[order]
        fresh = np.concatenate([[True], to[1:] != to[:-1]])
        low = np.where(fresh, 0, np.concatenate([[0], at[:-1] + 1]))
        out = self._range_minimum(passed, low, at).astype(np.int16)
        out[fresh] = np.minimum(out[fresh], self.least[to[fresh]])
        self.least = np.minimum(self.least, int(passed.min()))
        last = np.concatenate([fresh[1:], [True]])
        after = np.append(np.minimum.accumulate(passed[::-1])[::-1].astype(np.int16), 255)  # least from a place on
        self.least[to[last]] = after[at[last] + 1]
        return order, out + 1

    @staticmethod
    def _range_minimum(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """min(x[low..high]), ends included."""
        out = np.empty(len(low), x.dtype)
        width = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        level = x
        for k in range(int(width.max()) + 1 if len(width) else 0):
            mine = np.flatnonzero(width == k)
            out[mine] = np.minimum(level[low[mine]], level[high[mine] - (1 << k) + 1])
            step = 1 << k
            level = np.minimum(level[:-step], level[step:]) if len(level) > step else level
        return out


class InducedSort:
    def __init__(self, text: np.ndarray, cap: int, folder: str, budget: int = 64 << 20):
        """text: uint16 symbols, closed by the only 0."""
        self.text, self.cap, self.folder, self.budget = text, cap, folder, budget
        n = len(text)
        turn = np.flatnonzero(text[:-1] != text[1:])
        where = np.searchsorted(turn, np.arange(n - 1)).astype(np.int32)
        self.run = np.ones(n, np.int32)  # equal symbols from a place on
        self.run[:-1] = turn[where] - np.arange(n - 1) + 1
        small = np.ones(n, bool)
        small[:-1] = (text[:-1] < text[1:])[turn[where]]
        del where
        self.stars = np.flatnonzero(small[1:] & ~small[:-1]).astype(np.int32) + 1
        self.is_star = np.zeros(n, bool)
        self.is_star[self.stars] = True
        self.before = np.concatenate([text[-1:], text[:-1]])

    def scans(self, stars: np.ndarray, prefix: np.ndarray, sink: Sink) -> None:
        """Induces the order of all suffixes from stars in order; sink gets blocks in falling order, each with the
        common prefix of a suffix and the one that sink got before it."""
        text, before, run, cap = self.text, self.before, self.run, self.cap
        queue, kept = BucketQueue(self.folder, "up", self.budget), BucketQueue(self.folder, "large", self.budget)
        first = np.searchsorted(text[stars], np.arange(SYMBOLS + 1))
        least = LeastSince()

        def send(where: BucketQueue, since: LeastSince, position: np.ndarray, passed: np.ndarray, chosen: np.ndarray) -> None:
            sent = np.flatnonzero(chosen & (position > 0))
            if not len(sent):
                since.least = np.minimum(since.least, int(passed.min()))
                return
            order, value = since(passed, sent, before[position[sent]])
            to, position, value = before[position[sent]][order], position[sent][order] - 1, np.minimum(value, cap).astype(np.uint8)
            cuts = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1], [True]]))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                where.push(int(to[a]), position[a:b].astype(np.int32), value[a:b])

        last_large = np.full(SYMBOLS, -1, np.int64)
        for c in range(SYMBOLS):
            for position, passed in queue.pop(c):
                kept.push(c, position, passed)
                last_large[c] = position[-1]
                send(queue, least, position, passed, before[position] >= c)
            a, b = first[c], first[c + 1]
            if a < b:
                passed = prefix[a:b].copy()
                passed[0] = min(run[last_large[c]], run[stars[a]], cap) if last_large[c] >= 0 else 0
                send(queue, least, stars[a:b], passed, np.ones(b - a, bool))

        queue, least = BucketQueue(self.folder, "down", self.budget), LeastSince()
        for c in range(SYMBOLS - 1, -1, -1):
            last = -1
            for position, passed in queue.pop(c):
                last = position[-1]
                sink(position, passed)
                send(queue, least, position, passed, before[position] <= c)
            blocks = list(kept.pop(c))
            for k in range(len(blocks) - 1, -1, -1):
                position, up = blocks[k][0][::-1], blocks[k][1][::-1]
                above = blocks[k + 1][1][0] if k + 1 < len(blocks) else 0 if last < 0 else min(run[position[0]], run[last], cap)
                passed = np.concatenate([[above], up[:-1]]).astype(np.uint8)
                sink(position, passed)
                send(queue, least, position, passed, before[position] < c)

    def sorted_stars(self) -> np.ndarray:
        text, stars = self.text, self.stars
        found: list[np.ndarray] = []
        seeds = stars[np.argsort(text[stars], kind="stable")]
        self.scans(seeds, np.zeros(len(seeds), np.uint8), lambda position, _: found.append(position[self.is_star[position]]))
        order = np.concatenate([*found, stars[-1:]])[::-1]  # the closing symbol is a star that nothing induces
        place = np.searchsorted(stars, order)
        size = np.diff(np.append(stars, stars[-1]))[place] + 1
        same = np.zeros(len(order), bool)
        same[1:] = size[1:] == size[:-1]
        alive, offset = np.flatnonzero(same), 0
        while len(alive):
            equal = text[order[alive] + offset] == text[order[alive - 1] + offset]
            same[alive[~equal]] = False
            alive = alive[equal]
            offset += 1
            alive = alive[size[alive] > offset]
        name = np.empty(len(stars), np.int64)
        name[place] = np.cumsum(~same) - 1
        reach, m = 1, len(stars)
        while int(name.max()) < m - 1:
            key = name * (m + 1)
            key[:-reach] += name[reach:] + 1
            name = np.unique(key, return_inverse=True)[1]
            reach *= 2
        out = np.empty(m, np.int32)
        out[name] = stars
        return out

    def common_prefixes(self, order: np.ndarray) -> np.ndarray:
        """Of each suffix and the one before it, by comparison; the closing 0 ends every one."""
        out = np.zeros(len(order), np.uint8)
        alive = np.arange(1, len(order))
        for k in range(self.cap):
            equal = self.text[order[alive] + k] == self.text[order[alive - 1] + k]
            alive = alive[equal]
            out[alive] = k + 1
            alive = alive[(order[alive] + k + 1 < len(self.text)) & (order[alive - 1] + k + 1 < len(self.text))]
            if not len(alive):
                break
        return out

    def sort(self, sink: Sink) -> None:
        """All suffixes but the closing one in falling order, to sink."""
        if len(self.text) > 1:
            order = self.sorted_stars()
            self.scans(order, self.common_prefixes(order), sink)


def suffixes(raw: np.ndarray, ends: np.ndarray, cap: int, sink: Sink, folder: str | None = None, budget: int = 64 << 20) -> None:
    """Sorts the suffixes of texts that lie end to end in raw; positions count one closing symbol for each text before."""
    text = np.ones(len(raw) + len(ends) + 1, np.uint16)
    text[-1] = 0
    begins = np.concatenate([[0], ends[:-1]])
    text[np.arange(len(raw)) + np.repeat(np.arange(len(ends)), ends - begins)] = raw.astype(np.uint16) + 2
    with tempfile.TemporaryDirectory(dir=folder) as own:
        InducedSort(text, cap, own, budget).sort(sink)
