import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import SCHEMA, awkward, empty
from widelog.llm import common, kneser_ney
from widelog.llm.kneser_ney import op7_kneser_ney, scores, train

START, END = "<start>", "<end>"


def tokens(text):
    return (text or "").encode().lower().split() + [END]


class Brute:
    def __init__(self, texts):
        self.words, self.pairs = Counter(), Counter()
        for t in texts:
            w = tokens(t)
            self.words.update(w)
            self.pairs.update(zip([START, *w[:-1]], w))
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.met = Counter(w for _, w in self.pairs)
        self.d, self.u = self.discounts(self.pairs), self.discounts(self.met)
        self.spare = sum(self.u[min(c, 3)] for c in self.met.values())
        self.total, self.kinds = Counter(), defaultdict(lambda: [0] * 4)
        for (v, _), c in self.pairs.items():
            self.total[v] += c
            self.kinds[v][min(c, 3)] += 1

    @staticmethod
    def discounts(counts):
        n = [0] + [sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0
        return [0] + [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0), k - 0.05) if n[k] else 0 for k in (1, 2, 3)]

    def low(self, w):
        return (self.met[w] - self.u[min(self.met[w], 3)] + self.spare / (self.v + 1)) / len(self.pairs)

    def p(self, v, w):
        if not self.total[v]:
            return self.low(w)
        c = self.pairs[v, w]
        return (c - self.d[min(c, 3)] + sum(self.d[k] * self.kinds[v][k] for k in (1, 2, 3)) * self.low(w)) / self.total[v]

    def row(self, text):
        w = tokens(text)
        return len(w), sum(x in self.words for x in w), sum(math.log10((self.words[x] + 1) / (self.n + self.v + 1)) for x in w), sum(math.log10(self.p(a, b)) for a, b in zip([START, *w[:-1]], w))


def test_whole_small_table(spark, small, monkeypatch):
    monkeypatch.setattr(kneser_ney, "BUFFER", 2_000)
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    held_out = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2 for r in docs}
    brute = Brute(r["text"] for r in docs if not held_out[r["doc_id"]])
    got = {r["doc_id"]: r for r in op7_kneser_ney(spark, small).collect()}
    for r in docs:
        g, (n, known, base, score) = got[r["doc_id"]], brute.row(r["text"])
        assert (g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) == (held_out[r["doc_id"]], n, known, brute.n)
        assert np.allclose([g["base_score"], g["score"]], [base, score], rtol=1e-9)
    words = [*brute.words, "never"]
    assert abs(sum(brute.p(b"the", w) for w in words) - 1) < 1e-9


def test_awkward_rows(spark):
    model = train(awkward(spark), "text")
    rows = scores(awkward(spark), model, "doc_id", "text").collect()
    assert len(rows) == 14 and all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    got = {r["doc_id"]: r for r in rows}
    assert [got[k]["n_tokens"] for k in (4, 5, 6, 7)] == [1, 1, 1, 3] and got[9]["n_tokens"] == 24_001
    assert scores(empty(spark), model, "doc_id", "text").count() == 0


def test_nothing_to_learn_from(spark):
    model = train(empty(spark), "text")
    docs = spark.createDataFrame([(1, "some words", "en", "s", 1)], SCHEMA)
    row = scores(docs, model, "doc_id", "text").first()
    assert (row["n_tokens"], row["n_known"], row["base_score"], row["score"]) == (3, 0, 0.0, 0.0)


def test_missing_file_is_an_error(tmp_path):
    np.save(tmp_path / "words-0.npy", np.array([3, 5], np.uint64))
    look = kneser_ney.Lookup(str(tmp_path), "words", frozenset({0, 2}))
    assert look.find(np.array([3, 4], np.uint64), np.array([0, 0]))[1].tolist() == [True, False]
    assert look.find(np.array([3], np.uint64), np.array([1]))[1].tolist() == [False]
    with pytest.raises(FileNotFoundError):
        look.find(np.array([3], np.uint64), np.array([2]))


def test_shards_follow_the_size(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert common.shards_for(docs, "text") == 4
    monkeypatch.setattr(common, "SHARD_BYTES", 10_000)
    assert common.shards_for(docs, "text") > 20
    rows = {r["doc_id"]: r["score"] for r in op7_kneser_ney(spark, small).collect()}
    monkeypatch.undo()
    assert all(abs(rows[r["doc_id"]] - r["score"]) < 1e-6 for r in op7_kneser_ney(spark, small).collect())
