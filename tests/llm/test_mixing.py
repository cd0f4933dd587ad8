from math import exp

import duckdb

from tests.llm.helpers import SCHEMA, awkward, empty
from widelog.llm.mixing import SQL, mixed, op8_mixing


def test_same_as_sql(spark, small):
    got = sorted((r["doc_id"], r["replica"], r["text"]) for r in op8_mixing(spark, small).collect())
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{small}/documents.parquet'")
    assert got == sorted((r[0], r[5], r[1]) for r in con.sql(f"select doc_id, text, lang, source, n_chars, replica from ({SQL})").fetchall())


def test_rates_and_poisson_shape(spark):
    docs = spark.createDataFrame([(k, "t", "en", "a" if k % 4 else "b", 1) for k in range(8000)], SCHEMA)
    out = mixed(docs, targets={"a": 1.0, "b": 1.0})
    counts = {(r["source"], r["doc_id"]): r["n"] for r in out.groupBy("source", "doc_id").count().withColumnRenamed("count", "n").collect()}
    a, b = ([counts.get((s, k), 0) for k in range(8000) if (k % 4 > 0) == (s == "a")] for s in "ab")
    assert abs(sum(a) / 6000 - 2 / 3) < 0.04 and abs(sum(b) / 2000 - 2) < 0.1
    assert abs(b.count(0) / 2000 - exp(-2)) < 0.03


def test_order_is_shuffled_and_repeatable(spark):
    docs = spark.createDataFrame([(k, "t", "en", "a", 1) for k in range(500)], SCHEMA)
    first, second = ([r["doc_id"] for r in mixed(d).collect()] for d in (docs, docs.orderBy("doc_id", ascending=False)))
    assert first == second and first != sorted(first)


def test_awkward_rows(spark):
    out = mixed(awkward(spark), epochs=3.0)
    assert sorted(out.columns) == sorted(awkward(spark).columns)
    rows = out.collect()
    assert {r["doc_id"] for r in rows} <= {*range(1, 13), None} and all(r["replica"] >= 1 for r in rows)
    assert mixed(empty(spark)).count() == 0
    assert mixed(awkward(spark), targets={"missing": 1.0}).count() == 0


def test_large_rates_don_t_underflow(spark):
    docs = spark.createDataFrame([(k, "t", "en", "rare" if k == 0 else "rest", 1) for k in range(1000)], SCHEMA)
    n = mixed(docs, targets={"rare": 0.9, "rest": 0.1}).filter("source = 'rare'").count()
    assert 750 < n < 1050
