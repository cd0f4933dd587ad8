import hashlib
import random

import numpy as np

from tests.llm.helpers import LONG, SCHEMA, awkward, empty, prose
from widelog.llm import substring_dup
from widelog.llm.substring_dup import op3_substring_dedup, repeated_windows, stretches, without_repeats
from widelog.llm.suffix_array import suffixes


def brute(texts):
    """{id: (bytes, removed, spans, digest)} with windows kept in a plain dictionary."""
    first, out = {}, {}
    for i in sorted(texts):
        b = (texts[i] or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first.setdefault(b[k : k + 50], i) < i:
                gone[k : k + 50] = b"\1" * 50
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(b)))
        out[i] = len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()
    return out


def got(df):
    return {r["doc_id"]: tuple(r)[1:] for r in df.collect()}


def test_whole_small_table(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert got(op3_substring_dedup(spark, small)) == brute(texts)


def test_periodic_texts_and_small_shards(spark, monkeypatch):
    monkeypatch.setattr(substring_dup, "SYMBOLS_AT_ONCE", 500)
    monkeypatch.setattr(substring_dup, "QUEUE_BYTES", 200)
    rng, base = random.Random(2), prose(4, 1, 400)[0]
    texts = {0: "ab" * 200, 1: "ab" * 90 + "c" + "ab" * 40, 2: "a" * 300, 3: "a" * 49, 4: "a" * 51}
    for k in range(5, 60):
        a, b = sorted(rng.sample(range(len(base)), 2))
        texts[k] = f"{k} " + base[a:b] + f" é{k}漢 " + base[b : b + rng.randint(0, 200)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts.items()], SCHEMA)
    assert got(without_repeats(docs)) == brute(texts)


def test_awkward_rows(spark):
    rows = without_repeats(awkward(spark)).collect()
    assert len(rows) == 14
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_removed"] == 0 and by[2]["n_removed"] == by[2]["n_bytes"] and by[2]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert by[3]["n_removed"] == by[1]["n_bytes"] and by[4]["n_bytes"] == 0 and by[None]["n_removed"] == 0
    assert by[9]["n_removed"] == 0 and by[12]["n_removed"] == len(LONG)
    assert without_repeats(empty(spark)).count() == 0


def test_stretches_hold_each_window_once():
    texts = [t.encode() for t in prose(9, 20, 30)] + [b"", b"x" * 50, b"y" * 49, b"z" * 500]
    raw, at = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    anchor, begin, end = stretches(raw, at)
    windows = sorted(p for b, e in zip(begin, end) for p in range(b, e - 49))
    assert windows == [at[k] + p for k, t in enumerate(texts) for p in range(len(t) - 49)]
    by = {}
    for a, b, e in zip(anchor, begin, end):
        for p in range(b, e - 49):
            assert by.setdefault(raw[p : p + 50].tobytes(), a) == a


def test_induced_order_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(250):
        letters = rng.choice([b"ab", b"abc", bytes(range(256)), b"a"])
        texts = [bytes(rng.choices(letters, k=rng.randint(0, rng.choice([3, 12, 40])))) for _ in range(rng.randint(1, 6))]
        cap, found = rng.choice([2, 5, 50]), []
        ends = np.cumsum([len(t) for t in texts])
        suffixes(np.frombuffer(b"".join(texts), np.uint8), ends, cap, lambda p, x: found.extend(zip(p.tolist(), x.tolist())), budget=rng.choice([1, 100, 1 << 20]))
        whole = [s for t in texts for s in [*(x + 2 for x in t), 1]] + [0]
        order = sorted(range(len(whole) - 1), key=lambda i: whole[i:], reverse=True)
        assert [p for p, _ in found] == order
        for (p, _), (q, x) in zip(found, found[1:]):
            n = 0
            while n < cap and whole[p + n] == whole[q + n]:
                n += 1
            assert x == n


def test_windows_of_texts():
    a, b = bytes(range(60, 120)), bytes(range(65, 125))
    text, at = repeated_windows([a, b], np.array([3, 1]))
    assert sorted(zip(text.tolist(), at.tolist())) == [(0, k) for k in range(5, 11)]
