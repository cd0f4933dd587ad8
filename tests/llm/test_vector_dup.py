import numpy as np
import pytest

from widelog.llm import vector_dup
from widelog.llm.vector_dup import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, kept boolean"


def brute(rows):
    good = {i: np.array(v, np.float64) for i, v in rows.items() if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ids = sorted(good)
    links = {i: set() for i in rows}
    for a in ids:
        for b in ids:
            if a < b and len(good[a]) == len(good[b]) and good[a] @ good[b] / (np.linalg.norm(good[a]) * np.linalg.norm(good[b])) >= 0.9:
                links[a].add(b)
                links[b].add(a)
    out = {}
    for i in rows:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = len(links[i]), min(seen)
    return out


def frame(spark, rows):
    as_list = lambda v: None if v is None else [None if x is None else float(x) for x in v]
    return spark.createDataFrame([(i, as_list(v), 0, False) for i, v in rows.items()], SCHEMA)


def check(spark, rows):
    got = near_vectors(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = brute({i: None if v is None else [None if x is None else np.float32(x) for x in v] for i, v in rows.items()})
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_groups_of_many_sizes_and_spreads(spark, monkeypatch):
    monkeypatch.setattr(vector_dup, "BLOCK", 8)
    rng = np.random.default_rng(1)
    rows, k = {}, 0
    for size, spread in ((1, 0), (1, 0), (2, 0.02), (30, 0.02), (25, 0.055), (12, 0.08), (40, 0.0)):
        centre = rng.normal(size=32)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            rows[k] = list(centre * rng.uniform(0.5, 2) + rng.normal(size=32) * spread) if spread else list(centre)
            k += 1
    for _ in range(150):
        rows[k] = list(rng.normal(size=32))
        k += 1
    order = rng.permutation(k).tolist()
    check(spark, {order[i]: v for i, v in rows.items()})


def test_awkward_rows(spark):
    base = np.arange(1, 9).tolist()
    rows = {1: base, 2: base, 3: [2 * x for x in base], 4: None, 5: [], 6: [0] * 8, 7: [None, *base[1:]], 8: [float("nan"), *base[1:]], 9: [float("inf"), *base[1:]], 10: base[:4], 11: base[:4], 12: [-x for x in base]}
    check(spark, rows)
    assert near_vectors(frame(spark, {})).count() == 0
    twice = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0]), (2, [1.0, -2.0])], "vec_id long, embedding array<double>")
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(twice).collect())
    assert got == [(0, 2, 1, False), (1, 2, 1, True), (1, 2, 1, True), (2, 0, 2, True)]


def test_audit_counts_each_node_alike(spark):
    rng = np.random.default_rng(4)
    hot, pairs = rng.normal(size=32), rng.normal(size=(20, 32))
    rows = [hot + rng.normal(size=32) * 0.01 for _ in range(160)] + [p + rng.normal(size=32) * 0.01 for p in pairs for _ in range(2)]
    nodes = spark.createDataFrame([(i, 1, v.tobytes()) for i, v in enumerate(rows)], "id long, weight long, raw binary")
    counted = spark.createDataFrame([(i, 159 if i < 160 else 0) for i in range(len(rows))], "id long, n_links long")
    assert vector_dup.audited(nodes, counted, 0.9) < vector_dup.RECALL
    whole = spark.createDataFrame([(i, 159 if i < 160 else 1) for i in range(len(rows))], "id long, n_links long")
    assert vector_dup.audited(nodes, whole, 0.9) == 1


def test_failed_audits_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(vector_dup, "AUDITS", 1)
    monkeypatch.setattr(vector_dup, "audited", lambda *_: 0.9)
    with pytest.raises(RuntimeError, match="recall"):
        near_vectors(frame(spark, {k: [1.0, float(k)] for k in range(4)}))


def test_orders_grow_with_rows():
    few, many, more = (vector_dup.orders(n, 0.9, 8, 6) for n in (1_000, 40_000, 4_000_000))
    assert 6 <= few < many < more < 100


def cloud(rng, n, cosine, dims=64):
    """n unit vectors whose pairs have about that cosine."""
    centre, noise = rng.normal(size=dims), rng.normal(size=(n, dims))
    centre /= np.linalg.norm(centre)
    noise -= np.outer(noise @ centre, centre)
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    return cosine**0.5 * centre + (1 - cosine) ** 0.5 * noise


def test_dense_groups_that_form_no_balls(spark, monkeypatch):
    """Groups whose pairs are mostly linked, none near enough for a ball, among them two that only some links connect; lists stay at 8."""
    monkeypatch.setattr(vector_dup, "BLOCK", 256)
    rng = np.random.default_rng(3)
    near = cloud(rng, 2, 0.9)
    rows = np.concatenate([cloud(rng, 900, 0.927), cloud(rng, 300, 0.905), rng.normal(size=(300, 64)), near, near[:1]]).astype(np.float32)
    rows = rows[rng.permutation(len(rows))]
    u = rows.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    label = np.arange(len(u))
    while True:
        least = np.minimum(label, np.where(link, label[None, :], len(u)).min(1))
        if (least == label).all():
            break
        label = least
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors(frame(spark, {i: list(v) for i, v in enumerate(rows)})).collect()}
    assert got == {i: (int(link[i].sum()), int(label[i])) for i in range(len(u))}
