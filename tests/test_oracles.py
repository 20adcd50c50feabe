"""Every registered query against its DuckDB oracle on the driver tables."""

import os

import duckdb
import pytest

from conftest import MEDIUM, SMALL

import __spark_entry__ as entry
from tools.compare import TABLES, rows_of, type_family

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


def _duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.fixture(scope="module")
def duck_small():
    return _duck(SMALL)


@pytest.fixture(scope="module")
def duck_medium():
    return _duck(MEDIUM)


def _check(spark, con, key, sf_dir):
    sdf = QUERIES[key](spark, sf_dir)
    rel = con.sql(ORACLES[key])
    assert {f.name: type_family(f.dataType.simpleString()) for f in sdf.schema.fields} == \
        {n: type_family(str(t)) for n, t in zip(rel.columns, rel.types)}
    got = sdf.toPandas()
    want = rel.df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert len(got) == len(want)
    assert rows_of(got, cols) == rows_of(want, cols)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_oracle_small(spark, duck_small, key):
    _check(spark, duck_small, key, SMALL)


@pytest.mark.parametrize("key", ["category_conversion", "product_conversion", "top_conversion_products",
                                 "bottom_conversion_products", "flash_sale_alerts", "top_products_daily",
                                 "dedup_events", "segmentation_summary"])
def test_oracle_medium(spark, duck_medium, key):
    _check(spark, duck_medium, key, MEDIUM)


def test_rows_only_queries_run(spark):
    for key in sorted(set(QUERIES) - set(ORACLES)):
        assert QUERIES[key](spark, MEDIUM).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "conversion_rate" in df.columns
