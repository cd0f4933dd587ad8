"""Benchmark decontamination by a generalised suffix automaton of the benchmark's items.

Words are maximal runs of bytes other than \\x00-\\x2F, \\x3A-\\x60 and \\x7B-\\x7F after A-Z went to lower case. The automaton
holds every run of words of every item; training text streams through it word by word, and the state and match length
tell the longest run of item words that ends at the current word. A match of WINDOW words or more ends a window; so does
a whole item of fewer words. Every word inside any occurrence of a window is hit.

The automaton goes to every worker, as flat arrays of some 40 bytes a word of the items; only states with several ways on, a few
in a hundred, have a dictionary. Two bounds are checked: ``max_bytes`` of item text before it is read, and of the automaton
once it is built. A larger benchmark has to be cut in parts by its caller.

A null or empty text has no words, no hits, and is clean; items without words, null items included, never occur. Items that share an id
count as one, and repeated items as often as they have ids. Repeated rows are judged one by one. Columns other than the key and the
text are ignored, or kept by ``cleaned``, whatever their names.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, free

WINDOW = 10
#: A-Z to lower case, and bytes that end words to spaces.
TABLE = bytes(32 if b <= 0x2F or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


class SuffixAutomaton:
    """States of all runs of words of a list of items, with what occurs at each.

    A state's only or first way on is in ``word`` and ``to``; further ones are in ``more``.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.word, self.to, self.link, self.length = (array("i", [x]) for x in (0, 0, -1, 0))
        self.more: dict[int, dict[int, int]] = {}
        self.names = sorted({name for name, words in items if words})
        number = {name: k for k, name in enumerate(self.names)}
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, self.ids.setdefault(w, len(self.ids) + 1))
        # by state: the items that have its window; those shorter than a window that end there, as (words, item)
        holds: set[tuple[int, int]] = set()
        shorts: dict[int, set[tuple[int, int]]] = {}
        for name, words in items:
            numbers = [self.ids[w] for w in words]
            for _, s, n in self.walk(numbers):
                if n == window:
                    holds.add((s, number[name]))
            if 0 < len(numbers) < window:
                shorts.setdefault(s, set()).add((len(numbers), number[name]))
        ordered = sorted(holds)
        self.held = array("i", [k for _, k in ordered])
        self.first = array("i", bytes(4 * (len(self.link) + 1)))
        for s, _ in ordered:
            self.first[s + 1] += 1
        for s in range(len(self.link)):
            self.first[s + 1] += self.first[s]
        self.shorts: dict[int, tuple[tuple[int, int], ...]] = {}
        if shorts:
            for s in sorted(range(1, len(self.link)), key=self.length.__getitem__):  # what ends at a shorter state ends here too
                if mine := shorts.get(s, set()) | set(self.shorts.get(self.link[s], ())):
                    self.shorts[s] = tuple(sorted(mine))
        self.shortest = min([window, *(n for x in shorts.values() for n, _ in x)])

    @property
    def nbytes(self) -> int:
        """About what a worker needs for it."""
        arrays = sum(len(x) * x.itemsize for x in (self.word, self.to, self.link, self.length, self.held, self.first))
        return arrays + 100 * len(self.ids) + sum(232 + 60 * len(x) for x in self.more.values()) + sum(120 + 70 * len(x) for x in self.shorts.values())

    def step(self, s: int, w: int) -> int:
        """Where w leads from s; -1 if nowhere."""
        if self.word[s] == w:
            return self.to[s]
        ways = self.more.get(s)
        return ways.get(w, -1) if ways else -1

    def _lead(self, s: int, w: int, to: int) -> None:
        if self.word[s] in (0, w):
            self.word[s], self.to[s] = w, to
        else:
            self.more.setdefault(s, {})[w] = to

    def _state(self, n: int, link: int, like: int = -1) -> int:
        new = len(self.link)
        self.word.append(self.word[like] if like >= 0 else 0)
        self.to.append(self.to[like] if like >= 0 else 0)
        self.link.append(link)
        self.length.append(n)
        if like in self.more:
            self.more[new] = dict(self.more[like])
        return new

    def _extend(self, last: int, w: int) -> int:
        link, length, step = self.link, self.length, self.step

        def split(p: int, q: int) -> int:
            clone = self._state(length[p] + 1, link[q], q)
            link[q] = clone
            while p >= 0 and step(p, w) == q:
                self._lead(p, w, clone)
                p = link[p]
            return clone

        q = step(last, w)
        if q >= 0:
            return q if length[q] == length[last] + 1 else split(last, q)
        new = self._state(length[last] + 1, 0)
        p = last
        while p >= 0 and step(p, w) < 0:
            self._lead(p, w, new)
            p = link[p]
        if p >= 0:
            q = step(p, w)
            link[new] = q if length[q] == length[p] + 1 else split(p, q)
        return new

    def walk(self, words: Iterable[int | None]) -> Iterator[tuple[int, int, int]]:
        """(place, state, length) of the longest run of item words, up to a window, that ends at each word; places without one are left out."""
        word, to, link, length, window, more = self.word, self.to, self.link, self.length, self.window, self.more
        s = n = 0
        for i, w in enumerate(words):
            if w is None:
                s = n = 0
                continue
            while True:
                if word[s] == w:
                    s = to[s]
                    break
                ways = more.get(s)
                if ways and w in ways:
                    s = ways[w]
                    break
                if not s:
                    n = -1
                    break
                s = link[s]
                n = length[s]
            n += 1
            if n > window:
                n = window
                while length[link[s]] >= window:
                    s = link[s]
            if n:
                yield i, s, n

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans of hit words (first, end), overlapping ones joined, and the items whose windows occur."""
        window, shortest, first, held, shorts = self.window, self.shortest, self.first, self.held, self.shorts
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        for i, s, n in self.walk(map(self.ids.get, words)):
            if n < shortest:
                continue
            most = 0
            if n == window:
                most = window
                items.update(held[first[s] : first[s + 1]])
            for m, k in shorts.get(s, ()):
                if m <= n:
                    items.add(k)
                    most = max(most, m)
            if most:
                start = i + 1 - most
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        return spans, items


def automaton(benchmark: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW, max_bytes: int = 200 << 20) -> SuffixAutomaton:
    rows = benchmark.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).filter("t is not null").distinct()
    size = rows.agg(F.sum(F.octet_length("t")).alias("n")).first()["n"] or 0
    if 4 * size > max_bytes:  # a word takes five bytes of text or so
        raise ValueError(f"the benchmark has {size} bytes of text; {max_bytes // 4} fit on each worker")
    items = sorted((r["k"] or "", r["t"].encode().translate(TABLE).split()) for r in rows.collect())
    machine = SuffixAutomaton(items, window)
    if machine.nbytes > max_bytes:
        raise ValueError(f"the benchmark's automaton takes {machine.nbytes} bytes; {max_bytes} fit on each worker")
    return machine


def contamination(docs: DataFrame, machine: SuffixAutomaton, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    shipped = docs.sparkSession.sparkContext.broadcast(machine)
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for batch in batches:
            raw, at = bytes_of(batch.column(1))
            whole, out = raw.tobytes().translate(TABLE), []
            for k in range(batch.num_rows):
                words = whole[at[k] : at[k + 1]].split()
                spans, items = m.hits(words)
                said = ",".join(sorted({m.names[x] for x in items}))
                out.append((len(words), sum(b - a for a, b in spans), len(items), hashlib.sha256(said.encode()).hexdigest()))
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names=names)

    found = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("t")).mapInArrow(judge, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string")
    return found.withColumn("contaminated", F.col("n_hit") > 0)


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return contamination(read(spark, sf_dir, "documents"), automaton(read(spark, sf_dir, "benchmark")))


def cut(text: bytes, machine: SuffixAutomaton, coverage: float) -> bytes | None:
    """text without its hit words; None where they are more than the share coverage of all words."""
    plain = text.translate(TABLE)
    words = plain.split()
    spans, _ = machine.hits(words)
    if not spans:
        return text
    if sum(b - a for a, b in spans) > coverage * len(words):
        return None
    spot, begins = 0, []
    for w in words:
        spot = plain.index(w, spot)
        begins.append(spot)
        spot += len(w)
    out, done = [], 0
    for a, b in spans:
        out.append(text[done : begins[a]])
        done = begins[b - 1] + len(words[b - 1])
    return b"".join([*out, text[done:]])


def cleaned(docs: DataFrame, machine: SuffixAutomaton, coverage: float = 0.5) -> DataFrame:
    """docs without hit words in their texts and without rows of which they are more than coverage; n_chars follows."""
    shipped = docs.sparkSession.sparkContext.broadcast(machine)
    names = list(docs.columns)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for batch in batches:
            raw, at = bytes_of(batch.column(batch.num_columns - 1))
            whole = raw.tobytes()
            texts = [cut(whole[at[k] : at[k + 1]], m, coverage) for k in range(batch.num_rows)]
            null = np.array(batch.column(batch.num_columns - 1).is_null())
            keep = pa.array([t is not None for t in texts])
            texts = [None if null[k] or t is None else t.decode() for k, t in enumerate(texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=batch.schema.names).filter(keep)

    new = free(docs, "__text")
    shape = docs.withColumn(new, F.lit(None).cast("string"))
    out = shape.withColumn(new, F.col("text")).mapInArrow(clean, shape.schema)
    told = {"text": F.col(new)}
    if "n_chars" in names:
        changed = ~F.col("text").eqNullSafe(F.col(new))
        told["n_chars"] = F.when(changed, F.length(new)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.withColumns(told).select(*names)
