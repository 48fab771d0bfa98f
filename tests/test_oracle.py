"""Every query of the engine against its SQL, on the same tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tidewright.plans.queries import QUERIES
from tidewright.plans.sql import ORACLE_SQL


def normal(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(str(round(r[i], 6) if isinstance(r[i], float) else r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(small):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{small}/{name}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, duck, small, name):
    df = entry.queries()[name](spark, small)
    want = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    assert got == normal(want.fetchall(), names)


def test_queries_without_sql(spark, small):
    for name in sorted(set(QUERIES) - set(ORACLE_SQL)):
        assert QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
