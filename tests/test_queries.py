import duckdb
import pytest

import __spark_entry__ as entry
from widelog.queries import HEADLINES, QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    return con


def plain(v):
    return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else None if v is None else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
    if name not in SQL:
        assert got
        return
    found = duck.execute(SQL[name])
    have = [d[0] for d in found.description]
    assert sorted(have) == names
    assert got == sorted((tuple(plain(r[have.index(n)]) for n in names) for r in found.fetchall()), key=repr)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(QUERIES) <= set(entry.queries()) and set(HEADLINES) <= set(QUERIES) and set(entry.oracle_sql()) <= set(entry.queries())
