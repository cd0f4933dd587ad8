import hashlib
import random
import re

import pytest

from tests.llm.helpers import SCHEMA, awkward, by_id, empty
from widelog.llm.decontaminate import SuffixAutomaton, automaton, cleaned, contamination, cut, op5_decontaminate

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for name, item in items:
        x = words(item)
        n = min(10, len(x))
        windows = {tuple(x[k : k + n]) for k in range(len(x) - n + 1)} if n else set()
        for k in range(len(w) - n + 1 if n else 0):
            if tuple(w[k : k + n]) in windows:
                hit |= set(range(k, k + n))
                found.add(str(name))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_whole_small_table(spark, small):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in op5_decontaminate(spark, small).collect()}
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        assert got[r["doc_id"]] == brute(r["text"], items)


def test_short_and_overlapping_items(spark):
    items = [(1, "alpha beta gamma"), (2, "beta gamma"), (3, "a b c d e f g h i j k l"), (4, "c d e f g h i j k l m n"), (5, None), (6, "..."), (10, "Alpha, BETA gamma")]
    texts = ["x alpha beta gamma y", "Beta: GAMMA", "a b c d e f g h i j k l m n", "b c d e f g h i j", "alpha beta", "beta gamma beta gamma", "", "a b c d e f g h i j x c d e f g h i j k l m n"]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], SCHEMA)
    got = by_id(contamination(docs, automaton(spark.createDataFrame(items, "item_id long, text string"))))
    for k, t in enumerate(texts):
        assert tuple(got[k].values())[1:] == brute(t, items), t


def test_items_are_counted_by_id(spark):
    items = [(1, "alpha beta gamma"), (1, "alpha beta gamma"), (1, "gamma delta"), (2, "alpha beta gamma"), (None, "zeta eta")]
    docs = spark.createDataFrame([(1, "alpha beta gamma delta", "en", "s", 1), (2, "zeta eta", "en", "s", 1)], SCHEMA)
    got = by_id(contamination(docs, automaton(spark.createDataFrame(items, "item_id long, text string"))))
    assert (got[1]["n_items"], got[1]["items_sha256"], got[1]["n_hit"]) == (2, hashlib.sha256(b"1,2").hexdigest(), 4)
    assert (got[2]["n_items"], got[2]["n_hit"]) == (1, 2)


def test_random_items_and_texts():
    rng = random.Random(4)
    for _ in range(200):
        items = [(str(k), " ".join(rng.choices("abc", k=rng.choice([1, 3, 9, 10, 11, 14])))) for k in range(rng.randint(1, 5))]
        machine = SuffixAutomaton([(k, words(t)) for k, t in items])
        text = " ".join(rng.choices("abcd", weights=[5, 5, 5, 1], k=60))
        spans, found = machine.hits(words(text))
        want = brute(text, items)
        assert (sum(b - a for a, b in spans), len(found)) == want[1:3]


def test_size_is_checked(spark):
    words_of = [" ".join(f"w{rng}x{k}" for k in range(2000)) for rng in range(10)]
    benchmark = spark.createDataFrame([(k, t) for k, t in enumerate(words_of)], "item_id long, text string")
    machine = automaton(benchmark)
    assert len(machine.link) <= 2 * 20_000 and machine.nbytes < 20_000 * 400
    for least in (1000, machine.nbytes - 1):
        with pytest.raises(ValueError):
            automaton(benchmark, max_bytes=least)


def test_cut_takes_exactly_the_hit_words():
    machine = SuffixAutomaton([("1", b"alpha beta gamma".split())])
    assert cut(b"Say: Alpha, beta gamma! Then more words follow here.", machine, 0.5) == b"Say: ! Then more words follow here."
    assert cut(b"alpha beta gamma", machine, 0.5) is None
    assert cut(b"nothing", machine, 0.5) == b"nothing"


def test_awkward_rows_and_empty_tables(spark):
    none = automaton(spark.createDataFrame([], "item_id long, text string"))
    assert not any(r["contaminated"] for r in contamination(awkward(spark), none).collect())
    machine = automaton(spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog and then")], "item_id long, text string"))
    rows = contamination(awkward(spark), machine).collect()
    assert len(rows) == 14 and sum(r["contaminated"] for r in rows) == 4
    assert {r["doc_id"]: r["n_words"] for r in rows}[4] == 0
    out = cleaned(awkward(spark), machine)
    assert out.columns == awkward(spark).columns
    kept = {r["doc_id"]: r for r in out.collect()}
    assert 1 not in kept and kept[4]["text"] is None and kept[9]["n_chars"] > 3
    assert contamination(empty(spark), machine).count() == 0 and cleaned(empty(spark), machine).count() == 0
