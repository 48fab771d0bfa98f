"""The operators' queries against their SQL."""

import os

import duckdb
import pytest

from tidewright.llm.queries import QUERIES
from tidewright.llm.sql import ORACLE_SQL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, small, name):
    con = duckdb.connect()
    for table in os.listdir(small):
        con.execute(f"CREATE VIEW {table.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{small}/{table}')")
    want = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    df = QUERIES[name](spark, small)
    assert sorted(df.columns) == sorted(names)
    key = lambda r: tuple(map(str, r))
    assert sorted([tuple(r) for r in df.select(*names).collect()], key=key) == sorted(want.fetchall(), key=key)
