import pytest
from pyspark.sql import functions as F

from widelog.operators.stats import observed
from widelog.plans.checks import TopologyMonitor, check_time_skew, run_checks
from widelog.plans.ring import Instance, Ring
from widelog.spec import Replication, TableSpec


def test_report_tells_all():
    def bad():
        raise ValueError("no")

    report = run_checks({"a": bad, "b": lambda: None, "c": bad})
    assert report.failed == {"a": "no", "c": "no"} and str(report).splitlines()[1] == "PASSED b"
    with pytest.raises(RuntimeError, match="2 of 3"):
        report.raise_if_failed()
    run_checks({"b": lambda: None}).raise_if_failed()


def test_time_skew():
    check_time_skew(100, 5, now=104)
    with pytest.raises(RuntimeError):
        check_time_skew(100, 5, now=106)


def test_topology_monitor():
    ring = lambda *tokens: Ring([Instance(t, f"n{t}") for t in tokens], Replication("SimpleStrategy", {"replication_factor": 1}))
    answers, said = [ring(1, 5), ring(1, 5), OSError("down"), ring(1, 5), ring(1, 6)], []

    def ask():
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    m = TopologyMonitor(ask, said.append, most_failures=1)
    assert [m.check(), m.check(), m.check(), m.check(), m.check()] == [True, True, True, False, False] and said == ["the ring changed"]
    answers[:] = [ring(1), OSError(), OSError()]
    m = TopologyMonitor(ask, said.append, most_failures=1)
    assert [m.check(), m.check()] == [True, False] and "could not be read" in said[-1]


def test_observed(spark):
    spec = TableSpec.of("t", {"id": "bigint"}, {}, {"v": "text"})
    df, seen = observed(spark.range(10).withColumn("v", F.lit("ab")), spec, most=F.max("id"))
    assert df.filter("id < 3").count() == 3
    assert seen.get["rows"] == 10 and seen.get["bytes"] == 100 and seen.get["most"] == 9
