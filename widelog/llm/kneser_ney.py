"""Language-model scores by an interpolated modified Kneser-Ney bigram model, counted in Spark.

Training makes three passes over packed, pre-summed counts, each dealt to shards of equal load:

1. words: 64-bit word hashes with their counts, sharded by ranges of the hash. All shards in order are one sorted array;
   a word's place in it is its number.
2. pairs: (context number, word number) with counts, sharded by a hash of the pair, so that no frequent context lands in
   one place. Each shard is a sorted array.
3. contexts: from each shard of pairs, per context the sums that discounts need and per word the number of distinct
   contexts, already summed within the shard, sharded by ranges of the number.

The arrays lie as plain files in the shared folder, which must be mounted; workers map them into memory and look up
sorted, distinct keys, so lookups walk each file in order. What a worker holds besides does not grow with the
corpus, since the number of shards does. A file that was written and is not there is an error. The model's files are removed once
scores are written, or when the job fails.

Words are maximal runs of bytes other than \\x09-\\x0D and \\x20 with A-Z in lower case; each text ends in one end
token. The context of the first token is the start of text. A null or empty text is its end token alone. Words
unseen in training get the uniform share of the lowest order; contexts unseen in training leave the lowest
order alone. With nothing to learn from, all words are unseen: base_score has N = V = 0, and score is 0 for every
token's factor of 1. Repeated rows are counted and scored each. Only the key and the text are read.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHash, by_shard, dealt, dropped, fold, mix, mounted, packed, runs, saved, shards_for, shared_folder, totals, unpacked, written

HASH = WordHash()
END = np.uint64(0x5EED0E4D00000001)
#: Tokens that are summed up before they are sent on.
BUFFER = 500_000
#: Files that one worker keeps mapped at a time, by kind.
OPEN_FILES = 1024
#: Rows are (shard, payload) between stages; a payload is one packed set of arrays.
SENT = "shard int, payload binary"


def tokens(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all rows, each row closed by END, and how many each row has."""
    begin, end, counts = HASH.spans(raw, at)
    out = np.full(len(begin) + len(counts), END, dtype=np.uint64)
    if len(begin):
        out[np.arange(len(begin)) + np.repeat(np.arange(len(counts)), counts)] = HASH(raw, begin, end)
    return out, counts + 1


def range_of(keys: np.ndarray, n: int) -> np.ndarray:
    """The shard of each hash, by equal ranges."""
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def sent(shard: np.ndarray, *arrays: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Payloads of arrays that are ordered by shard, then by key."""
    cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else np.zeros(0, int)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield pa.RecordBatch.from_arrays([pa.array([int(shard[a])], pa.int32()), pa.array([packed(*(x[a:b] for x in arrays))], pa.binary())], names=["shard", "payload"])


class Lookup:
    """Sorted arrays in files, one by shard. Shards that were written must be there; the others hold nothing."""

    def __init__(self, folder: str, kind: str, written_shards: frozenset[int]):
        self.folder, self.kind, self.there = folder, kind, written_shards
        self.open: OrderedDict[int, np.ndarray] = OrderedDict()

    def part(self, k: int) -> np.ndarray:
        if k in self.open:
            self.open.move_to_end(k)
            return self.open[k]
        if len(self.open) >= OPEN_FILES:
            self.open.popitem(last=False)
        if k in self.there:
            path = f"{self.folder}/{self.kind}-{k}.npy"
            if not os.path.exists(path):
                raise FileNotFoundError(f"{path} was written and is not there; spark.checkpoint.dir has to be mounted on all nodes")
            self.open[k] = np.load(path, mmap_mode="r")
        else:
            self.open[k] = np.zeros(0, np.uint64)
        return self.open[k]

    def find(self, keys: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places within their shards of keys that are ordered by shard, then key; and which were found."""
        place, found = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else np.zeros(0, int)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            have = self.part(int(shard[a]))
            if len(have):
                p = np.searchsorted(have, keys[a:b])
                place[a:b] = np.minimum(p, len(have) - 1)
                found[a:b] = have[place[a:b]] == keys[a:b]
        return place, found

    def at(self, place: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """Values at places ordered as above."""
        out = np.zeros(len(place), self.part(int(shard[0])).dtype if len(shard) else np.int64)
        cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else np.zeros(0, int)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            out[a:b] = self.part(int(shard[a]))[place[a:b]]
        return out


class Model:
    """Where the arrays are, and the few numbers that all of them share."""

    def __init__(self, folder: str, shards: int):
        self.folder, self.shards = folder, shards
        self.offsets = np.zeros(shards + 1, np.int64)
        #: Shards written, by kind of array.
        self.there: dict[str, frozenset[int]] = {}
        self.tokens = 0
        self.pair_discounts = self.word_discounts = np.zeros(4)
        self.pair_kinds = 0
        self.word_spare = 1.0

    def lookup(self, kind: str) -> Lookup:
        return Lookup(self.folder, kind, self.there[kind])

    @property
    def vocabulary(self) -> int:
        return int(self.offsets[-1])

    @property
    def stride(self) -> int:
        """Numbers by shard of contexts; two more than words stand for the start of text and for unknown words."""
        return -(-(self.vocabulary + 2) // self.shards)

    def numbers(self, keys: np.ndarray, words: Lookup) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of sorted distinct hashes (unknown: vocabulary + 1), with shard and place for known ones."""
        shard = range_of(keys, self.shards)
        place, found = words.find(keys, shard)
        return np.where(found, self.offsets[shard] + place, self.vocabulary + 1), shard, place

    def pair_keys(self, number: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """context << 32 | word for each token; numbers stay below 2**32."""
        before = np.empty_like(number)
        before[1:] = number[:-1]
        before[np.cumsum(counts) - counts] = self.vocabulary
        return before.astype(np.uint64) << np.uint64(32) | number.astype(np.uint64)


def pair_shard(keys: np.ndarray, n: int) -> np.ndarray:
    return range_of(mix(keys), n)


def buffered(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens and counts by row, some BUFFER tokens at a time."""
    got, counts, size = [], [], 0
    for _, raw, at in runs(batches, text):
        t, c = tokens(raw, at)
        got.append(t)
        counts.append(c)
        size += len(t)
        if size >= BUFFER:
            yield np.concatenate(got), np.concatenate(counts)
            got, counts, size = [], [], 0
    if got:
        yield np.concatenate(got), np.concatenate(counts)


def count_words(train: DataFrame, model: Model) -> None:
    n, folder = model.shards, model.folder

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, _ in buffered(batches, "t"):
            keys, c = np.unique(t, return_counts=True)
            yield from sent(range_of(keys, n), keys, c.astype(np.uint32))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, parts in by_shard(batches):
            keys, counts = (np.concatenate(x) for x in zip(*map(unpacked, parts), strict=True))
            keys, counts = totals(keys, counts.astype(np.int64))
            saved(f"{folder}/words-{shard}.npy", keys)
            saved(f"{folder}/counts-{shard}.npy", counts)
            yield pa.RecordBatch.from_pydict({"shard": [shard], "n": [len(keys)], "total": [int(counts.sum())]}, schema=pa.schema({"shard": pa.int32(), "n": pa.int64(), "total": pa.int64()}))

    sizes = np.zeros(n, np.int64)
    for row in dealt(train.mapInArrow(count, SENT), n).mapInArrow(merge, "shard int, n long, total long").collect():  # one row a shard
        sizes[row["shard"]] = row["n"]
        model.tokens += row["total"]
    model.there["words"] = model.there["counts"] = frozenset(np.flatnonzero(sizes).tolist())
    model.offsets = np.concatenate([[0], np.cumsum(sizes)])
    if model.vocabulary >= (1 << 32) - 2:
        raise ValueError("more distinct words than numbers")


def numbered(model: Model, words: Lookup, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each token's number; distinct hashes' shards and places; each token's index among them."""
    keys, inverse = np.unique(t, return_inverse=True)
    number, shard, place = model.numbers(keys, words)
    return number[inverse], shard, place, inverse


def count_pairs(train: DataFrame, model: Model) -> DataFrame:
    """Writes the arrays of pairs; returns packed sums by context and word, still to be merged, with counts of counts."""
    n, folder = model.shards, model.folder

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = model.lookup("words")
        for t, counts in buffered(batches, "t"):
            keys, c = np.unique(model.pair_keys(numbered(model, words, t)[0], counts), return_counts=True)
            shard = pair_shard(keys, n)
            order = np.argsort(shard, kind="stable")
            yield from sent(shard[order], keys[order], c[order].astype(np.uint32))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, parts in by_shard(batches):
            keys, counts = (np.concatenate(x) for x in zip(*map(unpacked, parts), strict=True))
            keys, counts = totals(keys, counts.astype(np.int64))
            saved(f"{folder}/pairs-{shard}.npy", keys)
            saved(f"{folder}/times-{shard}.npy", counts.astype(np.uint32))
            yield pa.RecordBatch.from_pydict({"shard": [-1], "payload": [np.array([(counts == k).sum() for k in (1, 2, 3, 4)] + [shard], np.int64).tobytes()]}, schema=pa.schema({"shard": pa.int32(), "payload": pa.binary()}))
            del parts
            context, word = (keys >> np.uint64(32)).astype(np.uint32), keys.astype(np.uint32)
            first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))  # keys are ordered by context
            by, met, times = context[first], *np.unique(word, return_counts=True)
            both = np.union1d(by, met).astype(np.int64)
            spot = np.searchsorted(both, by)
            columns = []
            for values in (counts, counts == 1, counts == 2, counts > 2):
                x = np.zeros(len(both), np.uint32)
                x[spot] = np.add.reduceat(values, first, dtype=np.int64)
                columns.append(x)
            columns.append(np.zeros(len(both), np.uint32))
            columns[-1][np.searchsorted(both, met)] = times
            del context, word, keys, counts
            yield from sent(both // model.stride, both, *columns)

    return dealt(train.mapInArrow(count, SENT), n).mapInArrow(merge, SENT)


def discounts(n: np.ndarray) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, from how often counts 1 to 4 occur."""
    n1, n2, n3, n4 = map(float, n[:4])
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.0
    d = [k - (k + 1) * y * more / these if these else 0.0 for k, these, more in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return np.array([0.0, *(float(np.clip(x, 0, k + 0.95)) for k, x in enumerate(d))])


def merge_contexts(sums: DataFrame, model: Model) -> None:
    n, folder, stride = model.shards, model.folder, model.stride

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, parts in by_shard(batches):
            table = np.zeros((stride, 5), np.int64)
            for part in parts:
                key, *values = unpacked(part)
                table[key - shard * stride] += np.stack(values, axis=1)  # keys are distinct within a part
            saved(f"{folder}/sums-{shard}.npy", table)
            met = table[:, 4]
            counts = [int((met == k).sum()) for k in (1, 2, 3, 4)] + [int((met > 2).sum()), int(met.sum())]
            yield pa.RecordBatch.from_pydict({"shard": [shard], "counts": [counts]}, schema=pa.schema({"shard": pa.int32(), "counts": pa.list_(pa.int64())}))

    pair_counts, there = np.zeros(4, np.int64), set()
    for row in sums.filter("shard < 0").collect():  # one row a shard
        *counts, shard = np.frombuffer(row["payload"], np.int64).tolist()
        pair_counts += counts
        there.add(shard)
    model.there["pairs"] = model.there["times"] = frozenset(there)
    met, there = np.zeros(6, np.int64), set()
    for row in dealt(sums.filter("shard >= 0"), n).mapInArrow(merge, "shard int, counts array<long>").collect():  # one row a shard
        met += np.array(row["counts"])
        there.add(row["shard"])
    model.there["sums"] = frozenset(there)
    model.pair_discounts, model.word_discounts = discounts(pair_counts), discounts(met)
    model.pair_kinds = int(met[5])
    d = model.word_discounts
    model.word_spare = float((d[1] * met[0] + d[2] * met[1] + d[3] * met[4]) / max(met[5], 1)) if met[5] else 1.0


def train(docs: DataFrame, text: str) -> Model:
    spark = docs.sparkSession
    rows = docs.select(F.col(text).alias("t"))
    model = Model(f"{mounted(shared_folder(spark))}/kneser-ney-{uuid.uuid4().hex}", shards_for(rows, "t"))
    os.makedirs(model.folder)
    try:
        count_words(rows, model)
        sums = written(count_pairs(rows, model), "sums")
        merge_contexts(sums, model)
        dropped(sums)
    except BaseException:
        shutil.rmtree(model.folder, ignore_errors=True)
        raise
    return model


def scores(docs: DataFrame, model: Model, key: str, text: str) -> DataFrame:
    """key, n_tokens, n_known, base_score, score."""
    names = ["doc_id", "n_tokens", "n_known", "base_score", "score"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts_of, pairs, times, sums = map(model.lookup, ("words", "counts", "pairs", "times", "sums"))
        size, lowest = model.vocabulary, model.word_spare / (model.vocabulary + 1)
        d, u = model.pair_discounts, model.word_discounts

        def rows_of(numbers: np.ndarray) -> np.ndarray:
            """The five sums of each distinct number, in order."""
            shard = numbers // model.stride
            out = np.zeros((len(numbers), 5), np.int64)
            cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]]))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                have = sums.part(int(shard[a]))
                if have.ndim == 2:
                    out[a:b] = have[numbers[a:b] - shard[a] * model.stride]
            return out

        for rows, raw, at in runs(batches, "t"):
            t, counts = tokens(raw, at)
            number, shard, place, inverse = numbered(model, words, t)
            known = number < size
            c = np.zeros(len(shard), np.int64)
            some = np.zeros(len(shard), bool)
            some[inverse[known]] = True
            c[some] = counts_of.at(place[some], shard[some])
            base = np.log10((c + 1) / (model.tokens + size + 1))[inverse]

            keys, spot = np.unique(model.pair_keys(number, counts), return_inverse=True)
            where = pair_shard(keys, model.shards)
            order = np.argsort(where, kind="stable")
            place, found = pairs.find(keys[order], where[order])
            n = np.zeros(len(keys), np.int64)
            n[order[found]] = times.at(place[found], where[order][found])

            every, back = np.unique(np.concatenate([keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)]).astype(np.int64), return_inverse=True)
            table = rows_of(every)
            context, word = table[back[: len(keys)]], table[back[len(keys) :]]
            met = word[:, 4]
            low = (met - u[np.minimum(met, 3)]) / max(model.pair_kinds, 1) + lowest
            total = np.maximum(context[:, 0], 1)
            p = (n - d[np.minimum(n, 3)]) / total + (context[:, 1:4] @ d[1:]) / total * low
            p = np.where(context[:, 0] > 0, p, low)
            logs = np.log10(np.maximum(p, 1e-300))[spot]

            begin = np.cumsum(counts) - counts
            out = [counts, np.add.reduceat(known.astype(np.int64), begin), np.add.reduceat(base, begin), np.add.reduceat(logs, begin)]
            yield pa.RecordBatch.from_arrays([rows.column(0), *map(pa.array, out)], names=names)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("t")).mapInArrow(score, "doc_id long, n_tokens long, n_known long, base_score double, score double")


def op7_kneser_ney(spark, sf_dir: str) -> DataFrame:
    from .common import read

    docs = read(spark, sf_dir, "documents")
    held_out = fold("doc_id", 7) == 2
    model = train(docs.filter(~held_out), "text")
    try:
        out = written(scores(docs, model, "doc_id", "text"), "scores")
    finally:
        shutil.rmtree(model.folder)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
