import random
from math import comb

from tests.llm.helpers import SCHEMA, awkward, by_id, empty, prose
from widelog.llm.components import components
from widelog.llm import near_dup
from widelog.llm.near_dup import keep_first, near_duplicates


def shingles(text):
    w = text.encode().lower().split() if text else []
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[k : k + 5]) for k in range(len(w) - 4)])


def brute(texts):
    """(set size, component) of {id: text}, over all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                    x, y = find(a), find(b)
                    top[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_whole_small_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = brute({r["doc_id"]: r["text"] for r in docs.collect()})
    got = near_duplicates(docs).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_large_group_is_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", 16)
    rng, base = random.Random(3), prose(1, 1, 150)[0].split()
    texts = {}
    for k in range(100):
        w = list(base)
        for _ in range(rng.randint(0, 7)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        texts[k] = " ".join(w)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts.items()], SCHEMA)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(docs).collect()} == brute(texts)


def test_whole_sets_meet_sampled_ones(spark):
    rng, texts = random.Random(7), {}
    word = lambda: f"w{rng.randrange(10**9)}"
    for k, (n, m) in enumerate([(64, 85), (63, 84), (62, 82), (64, 82), (60, 80), (55, 73), (58, 70), (64, 86)] * 30):
        base = [word() for _ in range(n + 4)]
        texts[2 * k], texts[2 * k + 1] = " ".join(base), " ".join(base + [word() for _ in range(m - n)])
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts.items()], SCHEMA)
    want = {i: (len(shingles(t)), i - i % 2 if 4 * len(shingles(texts[i - i % 2])) >= 3 * len(shingles(texts[i - i % 2 + 1])) else i) for i, t in texts.items()}
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(docs).collect()} == want


def test_sizes_around_the_sketch_against_all_pairs(spark):
    """Pairs of sizes 40 to 130 at and just under the threshold: recall of links is 1, and nothing else is linked."""
    rng, texts = random.Random(11), {}
    word = lambda: f"w{rng.randrange(10**9)}"
    for n in range(40, 131, 2):
        for m in {-(-100 * n // 75) - 1, -(-100 * n // 75), -(-100 * n // 75) + 1, n + 3}:
            base, k = [word() for _ in range(n + 4)], len(texts)
            at = rng.randrange(2)
            texts[k], texts[k + 1] = " ".join(base), " ".join(([word() for _ in range(m - n)] if at else []) + base + ([] if at else [word() for _ in range(m - n)]))
    sizes = {i: len(shingles(t)) for i, t in texts.items()}
    want = {i: (sizes[i], i - i % 2 if 100 * sizes[i - i % 2] >= 75 * sizes[i - i % 2 + 1] else i) for i in texts}
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts.items()], SCHEMA)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(docs).collect()}
    links = [i for i in texts if want[i][1] != i]
    assert len(links) > 90 and sum(got[i] == want[i] for i in links) / len(links) == 1 and got == want


def test_bounds():
    assert all(near_dup.fewest_shared(n) >= -(-3 * n // 4) - 6 for n in range(1, 49)) and near_dup.fewest_shared(65) == near_dup.fewest_of_sample()
    t, k = 0.75, near_dup.fewest_of_sample()
    assert sum(comb(near_dup.K, j) * t**j * (1 - t) ** (near_dup.K - j) for j in range(k)) < near_dup.MISS


def test_awkward_rows(spark):
    rows = near_duplicates(awkward(spark)).collect()
    assert len(rows) == 14
    got = {r["doc_id"]: r for r in rows}
    assert got[2]["component_id"] == 1 and not got[2]["kept"] and got[1]["kept"]
    assert (got[4]["n_shingles"], got[4]["component_id"], got[4]["kept"]) == (0, 4, True)
    assert got[5]["component_id"] == 5 and got[6]["n_shingles"] == 0
    assert got[8]["component_id"] == 7 and got[7]["n_shingles"] == 1
    assert got[12]["component_id"] == 9
    assert got[None]["component_id"] == 1 and got[None]["kept"] is False


def test_keep_first_keeps_columns_and_one_row(spark):
    out = keep_first(awkward(spark))
    assert out.columns == awkward(spark).columns
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 4, 5, 6, 7, 9, 10, 11]


def test_rows_without_ids_and_with_shared_ids(spark):
    a, b, c, d = prose(21, 4)
    rows = [(None, a), (None, a + " x"), (None, b), (5, c), (5, d), (6, d + " y"), (7, c + " z"), (None, ""), (None, ""), (None, None), (5, d)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    kept = [(r["doc_id"], r["text"]) for r in keep_first(docs).collect()]
    assert sorted(t for i, t in kept if i is None and t) in (sorted([a, b]), sorted([a + " x", b]))
    assert sorted(t for i, t in kept if i is not None) == sorted([c, d]) and {i for i, _ in kept} == {None, 5}
    assert sum(not t for _, t in kept) == 3
    got = near_duplicates(docs).collect()
    assert len(got) == len(rows) and {r["component_id"] for r in got if r["doc_id"] in (6, 7)} == {5}


def test_empty_table(spark):
    assert near_duplicates(empty(spark)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(5, 5)]
    got = by_id(components(spark.createDataFrame(links, "a long, b long"), "a", "b"), "node")
    assert all(got[k]["component"] == 0 for k in range(1, 41)) and all(got[k]["component"] == 100 for k in range(101, 130))
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_few_links_are_settled_without_rounds(spark):
    links = spark.createDataFrame([(k * 37 % 200, k * 37 % 200 + 1) for k in range(200)], "a long, b long").repartition(4)
    spark.sparkContext.setJobGroup("few links", "")
    try:
        got = by_id(components(links, "a", "b"), "node")
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("few links")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {k: r["component"] for k, r in got.items()} == dict.fromkeys(range(1, 201), 0)
    assert len(jobs) <= 8


def test_many_links_are_settled_by_rounds(spark, monkeypatch):
    from widelog.llm import components as module

    monkeypatch.setattr(module, "AT_ONCE", 20)
    links = [(k * 37 % 200, k * 37 % 200 + 1) for k in range(200)] + [(300, k) for k in range(301, 500)] + [(7, 7)]
    got = by_id(components(spark.createDataFrame(links, "a long, b long").repartition(4), "a", "b"), "node")
    assert {k: r["component"] for k, r in got.items()} == dict.fromkeys(range(1, 201), 0) | dict.fromkeys(range(301, 500), 300)
