"""Exact removal of repeated byte strings by suffix arrays over shards.

A string of WIDTH bytes is *repeated* in a document if it also starts in a document with a smaller id; every byte that a
repeated string covers goes. Equal strings have to meet in one shard without all suffixes of the corpus being shuffled:

1. Each window of WIDTH bytes has an anchor, the least hash of the K-byte strings within it, so equal windows have
   equal anchors wherever they are. Windows next to each other mostly share theirs; such a run is one stretch of text.
   Anchors are counted by documents over packed, pre-summed payloads; those of two documents or more are left in sorted files in the
   shared folder (which must be mounted), and workers look their own anchors up in them. An anchor of one
   document can't belong to a repeated window.
2. Stretches with shared anchors go to the anchors' shards. Equal stretches are one text there, with the least id that
   has it. Anchors with several texts have their texts' suffixes sorted by external induced sorting, which carries common
   prefixes along; suffixes that share WIDTH bytes stand together, and the least id of all of them tells which
   windows are repeated. Anchors are taken together up to ``SYMBOLS_AT_ONCE`` bytes of text; queues and with them larger
   groups go to disk.
3. Covered spans return to their documents by shards of ids, are joined up and cut out.

A null or empty text has 0 bytes. Documents of equal ids never count against each other. Rows with a null id neither lose bytes
nor count against others. Matches don't cross documents. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
import os
import shutil
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK, WordHash, by_shard, bytes_of, dealt, mix, mounted, packed, runs, saved, shards_for, shared_folder, totals, unpacked, within, written
from .kneser_ney import SENT, Lookup, range_of, sent
from .suffix_array import suffixes

WIDTH, K = 50, 24
SYMBOLS_AT_ONCE, QUEUE_BYTES = 600_000, 16 << 20
HASH = WordHash(lower=False)
#: Anchors keep so many bits; an accidental match costs time, never a wrong result.
ANCHOR_BITS = 48


def stretches(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, begin, end) of runs of windows with one anchor; a run's text goes from its first to its last byte."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(raw) < WIDTH:
        return none
    HASH.grow(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(HASH.code[raw] * HASH.power[: len(raw)], out=total[1:])
    grams = mix((total[K:] - total[:-K]) * HASH.inverse[: len(raw) - K + 1])
    del total
    wide = WIDTH - K + 1
    least, step = grams, 1
    while 2 * step <= wide:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    rest = wide - step
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    inside = np.ones(len(least), bool)  # windows that lie in one document
    edges = at[1:-1]
    for back in range(1, WIDTH):
        spot = edges - back
        inside[spot[(spot >= 0) & (spot < len(inside))]] = False
    fresh = np.ones(len(least), bool)
    fresh[1:] = (least[1:] != least[:-1]) | ~inside[:-1]
    fresh[edges[edges < len(fresh)]] = True
    first = np.flatnonzero(fresh & inside)
    if not len(first):
        return none
    stop = np.flatnonzero(inside & np.append(fresh[1:] | ~inside[1:], True))
    # least hashes are small numbers; mixed anew they spread evenly over shards
    return mix(least[first]) >> np.uint64(64 - ANCHOR_BITS), first, stop + WIDTH


def owners(at: np.ndarray, begin: np.ndarray) -> np.ndarray:
    return np.searchsorted(at, begin, "right") - 1


def anchor_shard(anchor: np.ndarray, n: int) -> np.ndarray:
    return range_of(anchor << np.uint64(64 - ANCHOR_BITS), n)


def shared_anchors(rows: DataFrame, folder: str, n: int) -> frozenset[int]:
    """Writes files of the anchors that occur in two documents or more; which shards have one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            anchor, times = np.unique(np.concatenate(held), return_counts=True)
            yield from sent(anchor_shard(anchor, n), anchor, np.minimum(times, 2).astype(np.uint8))

        for _, raw, at in runs(batches, "t"):
            anchor, begin, _ = stretches(raw, at)
            own = owners(at, begin)
            order = np.lexsort((anchor, own))
            anchor, own = anchor[order], own[order]
            once = np.ones(len(anchor), bool)
            once[1:] = (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1])
            held.append(anchor[once])
            size += int(once.sum())
            if size > 500_000:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, parts in by_shard(batches):
            anchor, times = (np.concatenate(x) for x in zip(*map(unpacked, parts), strict=True))
            anchor, times = totals(anchor, times.astype(np.int64))
            saved(f"{folder}/anchors-{shard}.npy", anchor[times > 1])
            yield pa.RecordBatch.from_pydict({"shard": [shard]}, schema=pa.schema({"shard": pa.int32()}))

    return frozenset(r["shard"] for r in dealt(rows.mapInArrow(count, SENT), n).mapInArrow(merge, "shard int").collect())  # one row a shard


def gathered(raw: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of slices, end to end."""
    return raw[np.repeat(begin, size) + within(size)]


def body(arrays: tuple[np.ndarray, ...], text: np.ndarray) -> bytes:
    import zstandard

    head = packed(*arrays)
    return len(head).to_bytes(8, "little") + head + zstandard.ZstdCompressor(level=1).compress(text.tobytes())


def opened(payload: bytes) -> tuple[list[np.ndarray], bytes]:
    import zstandard

    cut = 8 + int.from_bytes(payload[:8], "little")
    return unpacked(payload[8:cut]), zstandard.ZstdDecompressor().decompress(payload[cut:])


def stretches_sent(rows: DataFrame, folder: str, there: frozenset[int], n: int, shards: int) -> DataFrame:
    """(shard, payload): stretches whose anchors are shared, with document, offset and length."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Lookup(folder, "anchors", there)
        for batch, raw, at in runs(batches, "t", 2 * CHUNK):
            anchor, begin, end = stretches(raw, at)
            keys, back = np.unique(anchor, return_inverse=True)
            found = anchors.find(keys, anchor_shard(keys, n))[1]
            keep = np.flatnonzero(found[back])
            if not len(keep):
                continue
            keep = keep[np.argsort(anchor[keep], kind="stable")]
            anchor, begin, size = anchor[keep], begin[keep], (end - begin)[keep]
            own = owners(at, begin)
            docs, offset = batch.column(0).to_numpy()[own], begin - at[own]
            shard = anchor_shard(anchor, shards)
            cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]]))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                payload = body((anchor[a:b], docs[a:b], offset[a:b].astype(np.int32), size[a:b].astype(np.int32)), gathered(raw, begin[a:b], size[a:b]))
                yield pa.RecordBatch.from_arrays([pa.array([int(shard[a])], pa.int32()), pa.array([payload], pa.binary())], names=["shard", "payload"])

    return rows.mapInArrow(send, SENT)


def repeated_windows(texts: list[bytes], least: np.ndarray, folder: str | None = None, budget: int = QUEUE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(text, begin) of windows that some text of a smaller id has too, by the texts' suffix array."""
    size = np.array([len(t) for t in texts])
    ends = np.cumsum(size)
    starts = np.concatenate([[0], ends[:-1] + np.arange(1, len(texts))])  # in positions with closing symbols
    hit_text, hit_at = [], []
    tail: list[tuple[np.ndarray, np.ndarray]] = []  # the group that the next block may go on with

    def judge(position: np.ndarray, fresh: np.ndarray) -> None:
        text = np.searchsorted(starts, position, "right") - 1
        offset = position - starts[text]
        first = np.flatnonzero(fresh)
        low = np.minimum.reduceat(least[text], first)
        low = np.repeat(low, np.diff(np.append(first, len(position))))
        found = np.flatnonzero((low < least[text]) & (offset + WIDTH <= size[text]))
        hit_text.append(text[found])
        hit_at.append(offset[found])

    def sink(position: np.ndarray, prefix: np.ndarray) -> None:
        tail.append((position, prefix >= WIDTH))
        if sum(len(p) for p, _ in tail) < 200_000:
            return
        closed(False)

    def closed(all_of_it: bool) -> None:
        if not tail:
            return
        position, same = (np.concatenate(x) for x in zip(*tail, strict=True))
        tail.clear()
        fresh = ~same
        fresh[0] = True
        cut = len(position) if all_of_it else int(np.flatnonzero(fresh)[-1])
        if cut:
            alone = fresh[:cut] & np.append(fresh[1:cut], True)  # groups of one can't be hit
            keep = np.flatnonzero(~alone)
            if len(keep):
                judge(position[keep], fresh[keep])
        if cut < len(position):
            tail.append((position[cut:], ~fresh[cut:]))

    suffixes(np.frombuffer(b"".join(texts), np.uint8), ends, WIDTH, sink, folder, budget)
    closed(True)
    return np.concatenate([*hit_text, np.zeros(0, np.int64)]), np.concatenate([*hit_at, np.zeros(0, np.int64)])


def covered(anchor: np.ndarray, doc: np.ndarray, offset: np.ndarray, size: np.ndarray, text: bytes, folder: str | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, begin, end) of what repeated windows cover, of all stretches of some whole anchors, ordered by anchor."""
    ends = np.cumsum(size)
    known: dict[bytes, int] = {}
    of = np.array([known.setdefault(text[b - s : b], len(known)) for b, s in zip(ends.tolist(), size.tolist(), strict=True)], np.int64)
    texts = list(known)
    least = np.full(len(texts), np.iinfo(np.int64).max)
    np.minimum.at(least, of, doc)
    whole = doc > least[of]
    out = [(doc[whole], offset[whole], offset[whole] + size[whole])]

    # texts in order of their anchors; anchors of one text are done
    anchors = np.zeros(len(texts), np.uint64)
    anchors[of] = anchor
    order = np.argsort(anchors, kind="stable")
    _, group, many = np.unique(anchors[order], return_inverse=True, return_counts=True)
    order = order[many[group] > 1]
    first = np.flatnonzero(np.concatenate([[True], anchors[order][1:] != anchors[order][:-1]])) if len(order) else np.zeros(0, int)
    length = np.array([len(t) for t in texts])
    filled = np.add.reduceat(length[order], first) if len(order) else np.zeros(0, int)
    hit_text, hit_at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    a = 0
    while a < len(first):
        b = max(a + 1, int(np.searchsorted(np.cumsum(filled[a:]), SYMBOLS_AT_ONCE, "right")) + a)
        some = order[first[a] : first[b] if b < len(first) else len(order)]
        t, w = repeated_windows([texts[k] for k in some], least[some], folder)
        hit_text.append(some[t])
        hit_at.append(w)
        a = b
    t, w = np.concatenate(hit_text), np.concatenate(hit_at)
    if len(t):
        sort = np.lexsort((w, t))
        t, w = t[sort], w[sort]
        fresh = np.concatenate([[True], (t[1:] != t[:-1]) | (w[1:] > w[:-1] + WIDTH)])
        begin = np.flatnonzero(fresh)
        stop = np.append(begin[1:], len(t)) - 1
        t, low, high = t[begin], w[begin], w[stop] + WIDTH
        # every span of a text, for every stretch that is this text and was not covered whole
        lists = np.searchsorted(t, np.arange(len(texts) + 1))
        rest = np.flatnonzero(~whole)
        many = (lists[1:] - lists[:-1])[of[rest]]
        at = np.repeat(lists[of[rest]], many) + within(many)
        rest = np.repeat(rest, many)
        out.append((doc[rest], offset[rest] + low[at], offset[rest] + high[at]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def doc_shard(doc: np.ndarray, n: int) -> np.ndarray:
    return (doc ^ (doc >> 15) ^ (doc >> 31)) % n


def spans_found(sent_rows: DataFrame, folder: str, n: int, shards: int) -> DataFrame:
    """(shard, payload): spans by shards of documents."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in by_shard(batches):
            arrays, texts = zip(*map(opened, parts), strict=True)
            anchor, doc, offset, size = (np.concatenate(x) for x in zip(*arrays, strict=True))
            del parts, arrays
            text = np.frombuffer(b"".join(texts), np.uint8)
            del texts
            begin = np.cumsum(size) - size
            order = np.argsort(anchor, kind="stable")
            edge = np.concatenate([[True], anchor[order][1:] != anchor[order][:-1]])
            filled = np.cumsum(size[order])
            a = 0
            while a < len(order):  # whole anchors, some bytes at a time
                b = int(np.searchsorted(filled, (filled[a - 1] if a else 0) + 8 * SYMBOLS_AT_ONCE, "right"))
                b = max(b, a + 1)
                while b < len(order) and not edge[b]:
                    b += 1
                some = order[a:b]
                got = covered(anchor[some], doc[some], offset[some].astype(np.int64), size[some].astype(np.int64), gathered(text, begin[some], size[some]).tobytes(), folder)
                a = b
                shard = doc_shard(got[0], n)
                order_out = np.lexsort((got[1], got[0], shard))
                d, low, high = (x[order_out] for x in got)
                yield from sent(shard[order_out], d, low.astype(np.int32), (high - low).astype(np.int32))

    return dealt(sent_rows, shards).mapInArrow(find, SENT)


def cut(rows: DataFrame, spans: DataFrame, n: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    doc = F.col("doc")
    shard = F.coalesce(F.pmod(doc.bitwiseXOR(F.shiftright(doc, 15)).bitwiseXOR(F.shiftright(doc, 31)), F.lit(n)), F.pmod(F.xxhash64("t"), F.lit(n))).cast("int")  # rows without an id have no spans to meet
    texts = rows.select(shard.alias("shard"), F.lit(1).alias("kind"), "doc", "t", F.lit(None).cast("binary").alias("payload"))
    told = spans.select("shard", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("doc"), F.lit(None).cast("string").alias("t"), "payload")
    met = texts.unionByName(told).repartitionById(n, F.col("shard")).sortWithinPartitions("kind").drop("shard")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[list[np.ndarray]] = []
        ready = None
        for batch in batches:
            kind = batch.column(0).to_numpy()
            split = int(np.searchsorted(kind, 1))
            found += [unpacked(x) for x in batch.column(3).slice(0, split).to_pylist()]
            batch = batch.slice(split)
            if not batch.num_rows:
                continue
            if ready is None:
                d, low, size = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32))
                order = np.lexsort((low, d))
                ready = d[order], low[order].astype(np.int64), (low[order] + size[order]).astype(np.int64)
                found.clear()
            d, low, high = ready
            ids = batch.column(1).to_pylist()
            raw, at = bytes_of(batch.column(2))
            out = []
            for k, i in enumerate(ids):
                text = raw[at[k] : at[k + 1]]
                a, b = (0, 0) if i is None else (int(np.searchsorted(d, i)), int(np.searchsorted(d, i, "right")))
                if a == b:
                    out.append((len(text), 0, 0, hashlib.sha256(text.tobytes()).hexdigest()))
                    continue
                begin, reach = low[a:b], np.maximum.accumulate(high[a:b])
                fresh = np.flatnonzero(np.concatenate([[True], begin[1:] > reach[:-1]]))
                begin, end = begin[fresh], reach[np.append(fresh[1:], b - a) - 1]
                digest = hashlib.sha256()
                done = 0
                for x, y in zip(begin.tolist(), end.tolist(), strict=True):
                    digest.update(text[done:x].tobytes())
                    done = y
                digest.update(text[done:].tobytes())
                out.append((len(text), int((end - begin).sum()), len(begin), digest.hexdigest()))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names=names)

    return met.mapInArrow(keep, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    folder = f"{mounted(shared_folder(docs.sparkSession))}/anchors-{uuid.uuid4().hex}"
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("t"))
    some = rows.filter("doc is not null")
    n = shards_for(some, "t")
    os.makedirs(folder)
    try:
        there = shared_anchors(some, folder, n)
        spans = written(spans_found(stretches_sent(some, folder, there, n, 2 * n), folder, n, 2 * n), "spans")
    finally:
        shutil.rmtree(folder)
    return cut(rows, spans, n)


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return without_repeats(read(spark, sf_dir, "documents"))
