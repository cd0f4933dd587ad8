import pytest

from widelog.functions.tokens import MAX_TOKEN, MIN_TOKEN
from widelog.plans.consistency import ClusterFailures, FailureHandler, ReplicaSet, block_for, can_be_satisfied, check_availability, split_replicas, validate_read, write_availability
from widelog.plans.filters import EqualTo, In, KeyFilter, Other, key_product, key_values, split_filters, tasks_for
from widelog.plans.ring import Instance, Ring, TokenPartitioner, TokenRange, consolidated, overlay, parts_of, range_number, split_range, token_ranges
from widelog.spec import Replication, TableSpec

SIMPLE = Replication("SimpleStrategy", {"replication_factor": 3})
TWO = Replication("NetworkTopologyStrategy", {"dc1": 3, "dc2": 3})
NODES = [Instance(t, f"n{k}", "dc1" if k % 2 == 0 else "dc2") for k, t in enumerate(range(-600, 600, 200))]


def test_ranges():
    r = TokenRange(0, 11)
    assert 11 in r and 0 not in r and r.size == 11 and TokenRange.singleton(5) == TokenRange.closed(5, 5)
    assert r.intersection(TokenRange(5, 20)) == TokenRange(5, 11) and r.span(TokenRange(20, 21)) == TokenRange(0, 21)
    assert r.is_connected(TokenRange(11, 12)) and not r.overlaps(TokenRange(11, 12)) and r.encloses(TokenRange(3, 11))
    with pytest.raises(ValueError):
        r.intersection(TokenRange(12, 13))


@pytest.mark.parametrize("low,high,n,ends", [(0, 11, 4, [3, 6, 9, 11]), (0, 3, 5, [1, 2, 3]), (0, 10, 1, [10]), (4, 4, 3, []), (MIN_TOKEN, MAX_TOKEN, 2, [-1 + 1, MAX_TOKEN])])
def test_split(low, high, n, ends):
    got = split_range(low, high, n)
    assert [r.upper for r in got] == ends and (not got or got[0].lower == low)


def test_replica_ranges_wrap_around():
    got = token_ranges([Instance(0, "a"), Instance(100, "b"), Instance(200, "c")], 1)
    assert {i.node: r for i, r in got.items()} == {"a": [TokenRange(200, MAX_TOKEN), TokenRange(MIN_TOKEN, 0)], "b": [TokenRange(0, 100)], "c": [TokenRange(100, 200)]}
    low = token_ranges([Instance(MIN_TOKEN, "a"), Instance(0, "b")], 1)
    assert [r for i, r in low.items() if i.node == "a"] == [[TokenRange(0, MAX_TOKEN)]]
    for bad in (0, 4):
        with pytest.raises(ValueError):
            token_ranges([Instance(0, "a"), Instance(1, "b")], bad)


def test_ring_covers_all_tokens_with_all_replicas():
    for replication in (SIMPLE, TWO):
        ring = Ring(NODES, replication)
        assert ring.ranges[0][0].lower == MIN_TOKEN and ring.ranges[-1][0].upper == MAX_TOKEN
        assert all(a.upper == b.lower for (a, _), (b, _) in zip(ring.ranges, ring.ranges[1:]))
        assert all(len(o) == replication.total for _, o in ring.ranges)
        assert len(ring.replicas(5)) == replication.total
    assert {len(o) for _, o in consolidated(Ring(NODES, SIMPLE), Ring([Instance(7, "m", cluster="x")], Replication("SimpleStrategy", {"replication_factor": 1})))} == {4}
    with pytest.raises(ValueError):
        consolidated(Ring(NODES, SIMPLE), Ring([Instance(7, "m")], Replication("LocalStrategy"), "random"))


def test_task_ranges(spark):
    p = TokenPartitioner.of_ring(Ring(NODES, SIMPLE), parallelism=20)
    assert p.splits == 3 and len(p) == 21 and p.part_of(MAX_TOKEN) == 20
    tokens = [MIN_TOKEN + 1, -600, -599, 0, 1, 599, MAX_TOKEN]
    rows = spark.createDataFrame([(t,) for t in [*tokens, None]], "t long")
    assert [r[0] for r in rows.select(range_number(p.parts, rows["t"])).collect()] == [*map(p.part_of, tokens), None]
    with pytest.raises(ValueError):
        TokenPartitioner([TokenRange(0, 5)], 1)
    assert TokenPartitioner.of_ring(Ring(NODES, SIMPLE), 1, splits=5).splits == 5


def test_rows_meet_their_range(spark):
    import random

    rng = random.Random(2)
    cuts = sorted({MIN_TOKEN, MAX_TOKEN, *(rng.randrange(MIN_TOKEN, MAX_TOKEN) for _ in range(50)), 5, 6, 7, 1000})
    ranges = [TokenRange(a, b) for a, b in zip(cuts, cuts[1:])][1:]
    tokens = [rng.randrange(MIN_TOKEN, MAX_TOKEN) for _ in range(300)] + cuts + [MIN_TOKEN + 1, 0, 8]
    got = parts_of(spark.createDataFrame([(t,) for t in tokens], "token long"), ranges)
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
    want = [(t, r.lower, r.upper) for t in tokens for r in ranges if t in r]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert parts_of(spark.createDataFrame([(1,)], "token long"), []).count() == 0


def test_many_parts_are_found_without_an_expression(spark, monkeypatch):
    from widelog.plans import ring

    parts, tokens = split_range(MIN_TOKEN, MAX_TOKEN, 700), [MIN_TOKEN + 1, -5, 0, 17, MAX_TOKEN, None, *(p.upper for p in split_range(MIN_TOKEN, MAX_TOKEN, 700)[::50])]
    df = spark.createDataFrame([(t,) for t in tokens], "token long")
    many = [r[0] for r in df.select(range_number(parts, df.token)).collect()]
    monkeypatch.setattr(ring, "IN_AN_EXPRESSION", 1000)
    assert many == [r[0] for r in df.select(range_number(parts, df.token)).collect()] and many[5] is None
    monkeypatch.setattr(ring, "BROADCAST_PARTS", 0)
    assert parts_of(df.dropna(), parts).count() == len(tokens) - 1


def test_block_for():
    want = {"ONE": 1, "LOCAL_ONE": 1, "ANY": 1, "TWO": 2, "THREE": 3, "QUORUM": 4, "LOCAL_QUORUM": 2, "EACH_QUORUM": 4, "ALL": 6}
    assert {k: block_for(k, TWO, "dc1") for k in want} == want
    assert block_for("QUORUM", SIMPLE) == 2 and block_for("LOCAL_QUORUM", SIMPLE) == 2
    for bad in ("SERIAL", "EACH_QUORUM", "nothing"):
        with pytest.raises((ValueError, NotImplementedError)):
            validate_read(bad, TWO, "dc1")
    with pytest.raises(ValueError):
        validate_read("QUORUM", TWO)
    validate_read("LOCAL_QUORUM", TWO, "dc2")


def test_replica_choice_prefers_those_that_are_up():
    nodes = [Instance(0, "a", "", "DOWN"), Instance(100, "b", "", "UP", "MOVING"), Instance(200, "c")]
    ring = Ring(nodes, SIMPLE)
    got = split_replicas("QUORUM", ring, TokenRange(0, 100))
    assert [i.node for i in got.primary] == ["c", "b"] and [i.node for i in got.backup] == ["a"] and got.repair_primary.node == "c"
    after = got.replaced(nodes[2])
    assert [i.node for i in after.primary] == ["a", "b"] and after.repair_primary.node == "a"
    with pytest.raises(RuntimeError):
        after.replaced(nodes[1])
    many = split_replicas("ONE", Ring(NODES, Replication("SimpleStrategy", {"replication_factor": 1})), TokenRange(-600, 600))
    assert len(many.primary) == 6 and many.repair_primary is None
    with pytest.raises(RuntimeError):
        split_replicas("THREE", Ring(NODES[:2], Replication("SimpleStrategy", {"replication_factor": 2})), TokenRange(0, 1))
    assert ReplicaSet([], []).repair_primary is None


def test_write_levels():
    dc1, dc2 = [i for i in NODES if i.data_center == "dc1"], [i for i in NODES if i.data_center == "dc2"]
    assert can_be_satisfied("EACH_QUORUM", dc1[:2] + dc2[:2], [], TWO) and not can_be_satisfied("EACH_QUORUM", dc1 + dc2[:1], [], TWO)
    assert not can_be_satisfied("EACH_QUORUM", dc1[:2] + dc2[:2], [dc1[2]], TWO)
    assert can_be_satisfied("LOCAL_QUORUM", dc1[:2], [dc2[0]], TWO, "dc1") and not can_be_satisfied("LOCAL_QUORUM", dc1[:1] + dc2, [], TWO, "dc1")
    assert can_be_satisfied("QUORUM", dc1 + dc2[:1], [], TWO) and not can_be_satisfied("ALL", dc1 + dc2[:2], [], TWO)
    assert can_be_satisfied("TWO", dc1[:2], [], TWO) and not can_be_satisfied("ONE", dc1[:1], dc2[:1], TWO) and can_be_satisfied("LOCAL_ONE", dc1[:1], [], TWO, "dc1")
    for bad in (("LOCAL_ONE", SIMPLE, None), ("LOCAL_QUORUM", TWO, None), ("SERIAL", TWO, "dc1")):
        with pytest.raises(ValueError):
            can_be_satisfied(bad[0], [], [], bad[1], bad[2])


def test_failures_by_range():
    ring = Ring(NODES, SIMPLE)
    part, owners = ring.ranges[2]
    handler = FailureHandler(ring)
    handler.add(part, owners[0], "one")
    assert handler.failed_ranges("QUORUM") == [] and len(handler.failed_ranges("ALL")) == 1
    half = TokenRange(part.lower, part.lower + 10)
    handler.add(half, owners[1], "two")
    (failed, why), = handler.failed_ranges("QUORUM")
    assert failed == half and {f.message for f in why} == {"one", "two"}
    several = ClusterFailures({"x": Ring([Instance(i.token, i.node, cluster="x") for i in NODES], SIMPLE), "y": ring})
    several.add(part, Instance(owners[0].token, owners[0].node, cluster="x"), "down")
    assert several.failed_ranges("ALL").keys() == {"x"}
    with pytest.raises(ValueError):
        several.add(part, owners[0], "no cluster")
    with pytest.raises(ValueError):
        ClusterFailures({"": ring, "x": ring})


def test_availability():
    assert [write_availability(Instance(0, "n", "", *x)) for x in (("UP", "NORMAL"), ("UP", "JOINING"), ("DOWN", "NORMAL"), ("UP", "GONE"))] == ["AVAILABLE", "AVAILABLE", "UNAVAILABLE_DOWN", "INVALID_STATE"]
    one_down = [Instance(i.token, i.node, i.data_center, "DOWN" if i.node == "n0" else "UP") for i in NODES]
    check_availability(Ring(one_down, SIMPLE), "QUORUM")
    with pytest.raises(RuntimeError):
        check_availability(Ring(one_down, SIMPLE), "ALL")
    assert len(overlay({NODES[0]: [TokenRange(0, 10)], NODES[1]: [TokenRange(5, 20)]})) == 3


SPEC = TableSpec.of("t", {"a": "int", "b": "int"}, {}, {"c": "int"})


def test_pushdown():
    eq, isin = EqualTo("a", 1), In("B", (1, 2))
    assert split_filters([eq, isin, EqualTo("c", 3)], SPEC) == ([eq, isin], [EqualTo("c", 3)])
    assert split_filters([eq], SPEC) == ([], [eq])
    assert split_filters([eq, isin, EqualTo("A", 2)], SPEC) == ([eq, isin], [EqualTo("A", 2)])
    assert split_filters([eq, isin], SPEC, case_sensitive=True) == ([], [eq, isin])
    assert split_filters([Other("a > 1", "a"), isin], SPEC)[0] == []


def test_key_values_and_products():
    assert key_values([In("b", (2, 3, 4)), In("A", (2, 3)), EqualTo("c", 1)], SPEC) == {"a": [2, 3], "b": [2, 3, 4]}
    assert key_product([[2, 3], [2, 3, 4]]) == [(2, 2), (2, 3), (2, 4), (3, 2), (3, 3), (3, 4)]
    for bad in ([EqualTo("a", 1)], [EqualTo("a", 1), EqualTo("a", 2), EqualTo("b", 1)]):
        with pytest.raises(ValueError):
            key_values(bad, SPEC)
    with pytest.raises(ValueError):
        key_product([[1], []])


def test_tasks_without_keys_are_skipped():
    f = KeyFilter.of(b"\0\0\0\1")
    parts = split_range(MIN_TOKEN, MAX_TOKEN, 8)
    assert [p for p in parts if f.token in p] == tasks_for([f], parts) and tasks_for([], parts) == parts
    assert f.matches(b"\0\0\0\1") and f.overlaps(f.range)
