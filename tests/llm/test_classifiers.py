import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import SCHEMA, awkward, by_id, empty, prose
from widelog.llm.common import fold
from widelog.llm.language_id import ContextTrees, HashIndex, folded, identify, op10_language_id
from widelog.llm.language_id import train as train_languages
from widelog.llm.quality import FactorisationMachine, features, keep_good, op1_quality, scored, train
from widelog.llm.sample import bounded

DATA = "/root/testdata/sf0.01"


def test_quality_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet").dropna().dropDuplicates(["doc_id"])
    rows = op1_quality(spark, DATA).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 50 and sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_pairwise_identity():
    rng = np.random.default_rng(0)
    machine = FactorisationMachine(0.3, rng.normal(size=50), rng.normal(size=(50, 8)))
    ids, x = np.array([1, 4, 9, 20]), np.array([0.5, 1.0, 2.0, 0.1])
    plain = 0.3 + machine.linear[ids] @ x + sum(machine.factors[ids[a]] @ machine.factors[ids[b]] * x[a] * x[b] for a in range(4) for b in range(a + 1, 4))
    assert abs(machine.score(ids, x) - 1 / (1 + np.exp(-plain))) < 1e-9


def test_scores_against_all_pairs(spark, small):
    """Every row's score, with all pairs of its features written out."""
    from widelog.llm.quality import trained

    machine = trained(spark, small)
    got = by_id(op1_quality(spark, small))
    for r in spark.read.parquet(f"{small}/documents.parquet").collect()[:60]:
        ids, x = features((r["text"] or "").encode(), r["n_chars"], {})
        weights = np.triu(machine.factors[ids].astype(float) @ machine.factors[ids].T.astype(float), 1)
        raw = machine.bias + machine.linear[ids] @ x + x @ weights @ x
        assert abs(got[r["doc_id"]]["score"] - 1 / (1 + np.exp(-np.clip(raw, -30, 30)))) < 1e-5


def test_labels_that_disagree_and_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "good text here", "en", "s", 1), (1, "another good one", "en", "s", 1), (2, "b*d b*d", "en", "s", 1), (3, "both", "en", "s", 1)], SCHEMA)
    many = docs.unionByName(docs.filter("doc_id = 1").crossJoin(spark.range(50)).select(*docs.columns))
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    a, b = train(docs, labels), train(many.repartition(7), labels.filter("doc_id != 3"))
    assert a.bias == b.bias and (a.linear == b.linear).all() and (a.factors == b.factors).all()


def test_quality_of_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, 0), (10, 0, 0), (7, 0, 1), (None, 1, 0), (99, 1, 0), (1, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    model = train(awkward(spark), labels)
    out = scored(awkward(spark), model)
    assert out.columns == [*awkward(spark).columns, "__quality"]
    assert out.filter("__quality between 0 and 1").count() == 14
    assert keep_good(awkward(spark), model, 0.0).count() == 14 and keep_good(awkward(spark), model).columns == awkward(spark).columns
    assert scored(empty(spark), model).count() == 0
    none = train(awkward(spark), labels.limit(0))
    assert {r["__quality"] for r in scored(awkward(spark), none).collect()} == {0.5}
    assert len(features(b"", None, {})[0]) == len(features("é".encode(), 1, {})[0]) - 1


def test_language_of_held_out_rows(spark):
    rows = op10_language_id(spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 100 and sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.97


class BruteTree:
    """A context tree of one language in dictionaries."""

    def __init__(self, trees, texts, kept):
        self.trees, self.order = trees, trees.order
        self.counts = {}
        for t in texts:
            s = [0] * self.order + trees.symbol[folded(np.frombuffer(t, np.uint8))].tolist()
            for i in range(self.order, len(s)):
                for n in range(self.order + 1):
                    gram = tuple(s[i - n : i + 1])
                    if n < 3 or gram in kept:
                        at = self.counts.setdefault(gram[:-1], {})
                        at[gram[-1]] = at.get(gram[-1], 0) + 1

    def p(self, context, c):
        if context is None:
            return 0 if c == 0 else self.trees.others / 256 if c == 1 else 1 / 256
        shorter = context[1:] if context else None
        have = self.counts.get(context)
        if not have:
            return self.p(shorter, c)
        total, distinct = sum(have.values()), len(have)
        left = 1 - sum(self.p(shorter, x) for x in have)
        escape = distinct / (total + distinct)
        return have[c] * (1 - escape) / total if c in have else self.p(shorter, c) * escape / left


def test_code_lengths_against_dictionaries():
    texts = {"a": [b"abracadabra abracadabra", b"abba abra"], "b": [b"zyx zyx zyxabra", "éé éé é".encode(), b"zyzzy"]}
    trees = ContextTrees(texts)
    trees.costs()
    grams = {}
    for ts in texts.values():
        for t in ts:
            s = [0] * 4 + trees.symbol[folded(np.frombuffer(t, np.uint8))].tolist()
            for i in range(4, len(s)):
                for n in (3, 4):
                    g = tuple(s[i - n : i + 1])
                    grams[g] = grams.get(g, 0) + 1
    kept = {g for g, n in grams.items() if n >= 2}
    brute = [BruteTree(trees, texts[k], kept) for k in ("a", "b")]
    probes = [b"abracadabra", b"zyx", b"abraxyz ~~", "éé".encode(), b"", b"zyzzyabra abra"]
    got = trees.lengths(np.frombuffer(b"".join(probes), np.uint8), np.cumsum([0, *map(len, probes)]))
    for row, t in zip(got, probes):
        s = [0] * 4 + trees.symbol[folded(np.frombuffer(t, np.uint8))].tolist()
        want = [sum(-np.log2(b.p(tuple(s[i - 4 : i]), s[i]) / (trees.others if s[i] == 1 else 1)) for i in range(4, len(s))) for b in brute]
        assert np.allclose(row, want, atol=1e-3), t
    assert got[0, 0] < got[0, 1] and got[1, 1] < got[1, 0] and not got[4].any()
    for context in ((0, 0, 0, 0), (2, 3, 4, 2), (9, 9, 9, 9)):
        assert abs(sum(brute[0].p(context, c) for c in range(2 + 256 - trees.others)) - 1) < 1e-9


def test_hash_index():
    rng = np.random.default_rng(3)
    keys = rng.permutation(np.unique(rng.integers(0, 1 << 35, 5000)))
    index = HashIndex(keys)
    assert (index.find(keys) == np.arange(len(keys))).all()
    assert (index.find(np.setdiff1d(rng.integers(0, 1 << 35, 5000), keys)) == -1).all() and (HashIndex(keys[:0]).find(keys) == -1).all()


def test_language_of_awkward_rows(spark):
    trees = train_languages(awkward(spark), "text", "lang", "doc_id")
    rows = identify(awkward(spark), trees).collect()
    assert len(rows) == 14
    got = {r["doc_id"]: r for r in rows}
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 for k in (4, 5, 6, 10))
    assert got[11]["lang_pred"] == "fr" and got[2]["lang_pred"] == "en" and got[9]["lang_pred"] != "und"
    assert identify(empty(spark), trees).count() == 0
    nothing = train_languages(empty(spark), "text", "lang", "doc_id")
    assert {r["lang_pred"] for r in identify(awkward(spark), nothing).collect()} == {"und"}


def test_samples_are_bounded_and_repeatable(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 10 == 0, "rare").otherwise("common").alias("y"))
    one, labels = bounded(df, "y", "id", 100, 2)
    assert labels == ["common", "rare"] and {r["y"]: r["count"] for r in one.groupBy("y").count().collect()} == {"common": 100, "rare": 100}
    assert sorted(r["id"] for r in one.collect()) == sorted(r["id"] for r in bounded(df.repartition(7), "y", "id", 100, 2)[0].collect())


def test_folds(spark):
    got = by_id(spark.createDataFrame([(5,), (None,)], "doc_id long").withColumn("f", fold("doc_id", 5)))
    import zlib

    assert got[5]["f"] == zlib.crc32(b"5") % 5 and got[None]["f"] == 0


def test_every_language_is_learned(spark):
    rng = random.Random(11)
    rows = []
    for k in range(41):
        words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)]
        size = 12_000 if k == 40 else 30  # one language has long texts only
        rows += [(10 * k + j, " ".join(rng.choices(words, k=size)), f"l{k:02}", "s", 1) for j in range(3 if k < 33 else 2)]
    docs = spark.createDataFrame(rows, SCHEMA)
    trees = train_languages(docs, "text", "lang", "doc_id")
    assert trees.languages == [f"l{k:02}" for k in range(41)]
    got = by_id(identify(docs, trees))
    assert all(got[i]["lang_pred"] == lang for i, _, lang, _, _ in rows)


def test_pairs_and_triples_cost_the_same(monkeypatch):
    texts = {"a": [t.encode() for t in prose(1, 20)], "b": [t.encode() for t in prose(2, 20)]}
    raw = np.frombuffer(" ".join(prose(1, 3) + prose(3, 3)).encode(), np.uint8)
    at = np.array([0, 100, 101, len(raw)])
    want = ContextTrees(texts).lengths(raw, at)
    monkeypatch.setattr("widelog.llm.language_id.UNROLLED", 1)
    assert ContextTrees(texts).base == 2 and np.allclose(ContextTrees(texts).lengths(raw, at), want, rtol=1e-4)
