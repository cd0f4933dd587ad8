"""Language identification by prediction by partial matching.

Each language has a context tree over bytes: nodes for the contexts of up to ORDER preceding bytes with the counts of
the bytes that followed. A byte costs -log2 of its share in the longest context that the tree has; a byte that was not seen
there costs the escape (method C: distinct / (total + distinct)) and then its cost in the context shorter by a byte
among the bytes not excluded, down to a uniform order -1. Statistics are frozen after training, so a text's code
length is exact and does not depend on the order of texts. Continuations of three bytes and more that were met fewer than
LEAST times in training are pruned. Costs in contexts of up to two bytes unroll into one array (of up to one byte where there are
more than UNROLLED languages); deeper nodes are found by hashing, with all languages' costs side by side.

A null text or one without any letter is ``und`` with score 0, as are all texts when nothing could be learned.
Other texts get the language of the smallest code length (ties: the alphabetically first); the score is that
language's posterior probability under equal priors. Rows are scored one by one: repeated ids give repeated rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fold, mix, runs, totals
from .sample import bounded

#: Symbols of the compact alphabet: 0 stands before a text, 1 for every byte that is not among the commonest.
SYMBOLS, BITS = 128, 7
#: Longest context, and how often a deep continuation must have been met.
ORDER, LEAST = 4, 2
#: Up to this many languages, the array of costs has triples of symbols, 8 MB a language; beyond, it has pairs.
UNROLLED = 32
LETTER = re.compile(r"[^\W\d_]")
ASCII_LETTER = np.zeros(256, dtype=bool)
ASCII_LETTER[65:91] = ASCII_LETTER[97:123] = True


def folded(raw: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and of the accented capitals U+00C0 to U+00DE, byte by byte."""
    out = raw.copy()
    out[(raw >= 65) & (raw <= 90)] += 32
    accent = np.flatnonzero(raw[:-1] == 0xC3) + 1
    accent = accent[(raw[accent] >= 0x80) & (raw[accent] <= 0x9E) & (raw[accent] != 0x97)]
    out[accent] += 32
    return out


def histories(symbol: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The n symbols that end at each place, in one number; before a text's first there are zeros."""
    place = np.arange(len(symbol)) - np.repeat(at[:-1], np.diff(at))
    out = symbol.astype(np.int64)
    for back in range(1, n):
        here = place >= back
        here[:back] = False
        before = np.zeros(len(symbol), np.int64)
        before[back:] = symbol[:-back]
        out |= np.where(here, before, 0) << (BITS * back)
    return out


class HashIndex:
    """Places of numbers in a list of distinct ones, by open addressing."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(4 * max(len(keys), 1) - 1).bit_length())
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.place = np.full(1 << self.bits, -1, np.int32)
        slot, todo = self._slots(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.place[slot[todo]] < 0]
            self.place[slot[free]] = free  # the last of those that want one slot gets it
            won = free[self.place[slot[free]] == free]
            self.key[slot[won]] = keys[won]
            todo = todo[self.place[slot[todo]] != todo]
            slot[todo] = (slot[todo] + 1) & (len(self.key) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each number's place, or -1."""
        out = np.full(len(keys), -1, np.int32)
        slot, todo = self._slots(keys), None
        while True:
            mine = slot if todo is None else slot[todo]
            there = self.key[mine]
            wanted = keys if todo is None else keys[todo]
            hit, go = there == wanted, there != -1
            if todo is None:
                out[hit] = self.place[mine[hit]]
                todo = np.flatnonzero(go & ~hit)
            else:
                out[todo[hit]] = self.place[mine[hit]]
                todo = todo[go & ~hit]
            if not len(todo):
                return out
            slot[todo] = (slot[todo] + 1) & (len(self.key) - 1)


class Level:
    """Nodes of one depth: costs of the continuations that some language has, and what leaving a context costs."""

    def __init__(self, keys: np.ndarray, bits: np.ndarray, contexts: np.ndarray, leave: np.ndarray):
        self.bits, self.leave = bits, leave
        self.keys, self.contexts = HashIndex(keys), HashIndex(contexts)


class ContextTrees:
    """Counts by language, and the costs they unroll into."""

    def __init__(self, texts: dict[str, list[bytes]], order: int = ORDER):
        self.languages, self.order = sorted(texts), max(order, 2)
        flat = {k: (np.frombuffer(b"".join(v), np.uint8), np.cumsum([0, *map(len, v)])) for k, v in texts.items()}
        seen = sum((np.bincount(folded(raw), minlength=256) for raw, _ in flat.values()), np.zeros(256, np.int64))
        common = [b for b in np.argsort(-seen, kind="stable") if seen[b]][: SYMBOLS - 2]
        self.symbol = np.ones(256, dtype=np.uint8)
        self.symbol[common] = np.arange(2, 2 + len(common))
        self.others = 256 - len(common)
        self.counts: dict[int, dict[str, tuple[np.ndarray, np.ndarray]]] = {n: {} for n in range(3, self.order + 2)}
        for name, (raw, at) in flat.items():
            whole = histories(self.symbol[folded(raw)], at, self.order + 1)
            for n in self.counts:
                self.counts[n][name] = np.unique(whole & ((1 << (BITS * n)) - 1), return_counts=True)
        for n in range(4, self.order + 2):
            keys, total = totals(*(np.concatenate([c[k] for c in self.counts[n].values()] or [np.zeros(0, np.int64)]) for k in (0, 1)))
            kept = keys[total >= LEAST]
            self.counts[n] = {name: (k[np.isin(k, kept)], c[np.isin(k, kept)]) for name, (k, c) in self.counts[n].items()}
        self.base = 3 if len(self.languages) <= UNROLLED else 2
        self.table: np.ndarray | None = None
        self.levels: list[Level] = []

    def __getstate__(self) -> dict:
        return self.__dict__ | {"table": None, "levels": []}  # workers unroll the counts themselves

    def costs(self) -> np.ndarray:
        """Bits of the last of ``base`` symbols by language; deeper levels are made along with it."""
        if self.table is None:
            self.table = np.zeros((SYMBOLS**self.base, len(self.languages)), dtype=np.float32)
            for k, name in enumerate(self.languages):
                n = np.zeros(SYMBOLS**3)
                n[self.counts[3][name][0]] = self.counts[3][name][1]
                n = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
                p = np.zeros((1, SYMBOLS))
                p[0, 1], p[0, 2 : 258 - self.others] = self.others / 256, 1 / 256
                for order in range(self.base):
                    have = n.sum(axis=tuple(range(2 - order))).reshape(-1, SYMBOLS)
                    p = self.blended(have, np.tile(p, (SYMBOLS, 1)) if order else p)
                self.table[:, k] = -np.log2(np.maximum(p, 1e-12)).reshape(-1)
            for n in range(self.base + 1, self.order + 2):
                self.levels.append(self.level(n))
        return self.table

    @staticmethod
    def blended(have: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        """Shares in each context; what the escape leaves goes to unseen symbols as the shorter context has them."""
        total, distinct = have.sum(1, keepdims=True), (have > 0).sum(1, keepdims=True)
        unseen = np.where(have > 0, 0, shorter)
        left = unseen.sum(1, keepdims=True)
        escape = np.where(left > 0, distinct / np.maximum(total + distinct, 1), 0)
        escape = np.where(total == 0, 1, escape)
        return np.where(have > 0, have * (1 - escape) / np.maximum(total, 1), unseen * escape / np.maximum(left, 1e-300))

    def level(self, n: int) -> Level:
        """Continuations of n symbols, the last of which follows a context of n - 1."""
        keys = np.unique(np.concatenate([k for k, _ in self.counts[n].values()]))
        contexts, of = np.unique(keys >> BITS, return_inverse=True)
        bits = self.bits(keys & ((1 << (BITS * (n - 1))) - 1), n - 1)
        leave = np.zeros((len(contexts), len(self.languages)), np.float32)
        for k, name in enumerate(self.languages):
            mine, count = self.counts[n][name]
            have = np.zeros(len(keys))
            have[np.searchsorted(keys, mine)] = count
            total, distinct = np.bincount(of, have, len(contexts)), np.bincount(of[have > 0], minlength=len(contexts))
            left = np.maximum(1 - np.bincount(of, np.where(have > 0, np.exp2(-bits[:, k].astype(np.float64)), 0), len(contexts)), 1e-6)
            escape = np.where(total > 0, distinct / np.maximum(total + distinct, 1), 1.0)
            leave[:, k] = np.where(total > 0, -np.log2(escape / left), 0)
            seen = have > 0
            bits[:, k] = np.where(seen, -np.log2(np.maximum(have * (1 - escape[of]) / np.maximum(total[of], 1), 1e-12)), bits[:, k] + leave[of, k])
        return Level(keys, bits, contexts, leave)

    def bits(self, key: np.ndarray, n: int) -> np.ndarray:
        """Costs by language of the last of n symbols after the others."""
        if n == self.base:
            return self.costs()[key] if self.table is None else self.table[key]
        level = self.levels[n - self.base - 1]
        place = level.keys.find(key)
        found, missed = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
        out = np.empty((len(key), len(self.languages)), np.float32)
        out[found] = level.bits[place[found]]
        if len(missed):
            rest = self.bits(key[missed] & ((1 << (BITS * (n - 1))) - 1), n - 1)
            context = level.contexts.find(key[missed] >> BITS)
            known = np.flatnonzero(context >= 0)
            rest[known] += level.leave[context[known]]
            out[missed] = rest
        return out

    def lengths(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Code length in bits of each text by language."""
        out = np.zeros((len(at) - 1, len(self.languages)))
        full = np.flatnonzero(at[1:] > at[:-1])
        if len(full) and self.languages:
            self.costs()
            symbol = self.symbol[folded(raw)]
            bits = self.bits(histories(symbol, at, self.order + 1), self.order + 1)
            bits[symbol == 1] += np.float32(np.log2(self.others or 1))  # stands for many bytes, each equally likely
            out[full] = np.add.reduceat(bits, at[:-1][full], axis=0, dtype=np.float64)
        return out


def train(df: DataFrame, text: str, lang: str, key: str, per_language: int = 400, max_chars: int = 20_000) -> ContextTrees:
    """Context trees from a bounded sample: per_language texts of every language, those of up to max_chars characters first.

    Where a language has too few of these, the first max_chars characters of longer texts stand in for the rest.
    """
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l")).filter("t is not null and l is not null")
    long = F.length("t") > max_chars
    rows = rows.select("k", "l", F.substring("t", 1, max_chars).alias("t"), F.concat(F.when(long, "1").otherwise("0"), "l").alias("part"))
    rows, _ = bounded(rows, "part", "k", per_language, None)
    rank = F.row_number().over(Window.partitionBy("l").orderBy(F.substring("part", 1, 1), F.xxhash64("k"), "k", "t"))
    texts: dict[str, list[bytes]] = {}
    for row in rows.withColumn("rank", rank).filter(F.col("rank") <= per_language).orderBy("l", "k", "t").collect():
        texts.setdefault(row["l"], []).append(row["t"].encode())
    return ContextTrees(texts)


def identify(df: DataFrame, trees: ContextTrees, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of df: key, lang_pred, score."""
    shipped = df.sparkSession.sparkContext.broadcast(trees)
    schema = df.select(F.col(key)).withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        names = np.array(model.languages or ["und"], dtype=object)
        for rows, raw, at in runs(batches, "__text", (1 << 19) * UNROLLED // max(UNROLLED, len(model.languages))):
            bits = model.lengths(raw, at)
            letters = np.concatenate([[0], np.cumsum(ASCII_LETTER[raw])])
            none = letters[at[1:]] == letters[at[:-1]]
            for k in np.flatnonzero(none):
                none[k] = not LETTER.search(raw[at[k] : at[k + 1]].tobytes().decode("utf-8", "replace"))
            if bits.shape[1]:
                best = bits.argmin(1)
                posterior = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -60)).sum(1)
                lang, posterior = names[best], np.where(none, 0.0, posterior)
                lang[none] = "und"
            else:
                lang, posterior = np.full(len(none), "und", dtype=object), np.zeros(len(none))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(lang, pa.string()), pa.array(posterior)], names=[key, "lang_pred", "score"])

    return df.select(F.col(key), F.col(text).alias("__text")).mapInArrow(score, schema)


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    from .common import read

    docs = read(spark, sf_dir, "documents")
    trees = train(docs.filter(fold("doc_id", 5) != 0), "text", "lang", "doc_id")
    return identify(docs, trees).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
