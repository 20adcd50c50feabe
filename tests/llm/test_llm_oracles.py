"""Queries with SQL against DuckDB on whole tables."""

import duckdb
import pytest

from cartpulse.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    rows = sorted(tuple(r[c] for c in columns) for r in got.collect())
    assert rows and rows == sorted(want.select(*columns).fetchall())
