"""Every query with oracle SQL agrees with DuckDB at sf0.001 (the driver's check runs sf0.01)."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as E
from stayflow.sources.testmap import TEST_TABLES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle_check import _hash, _rows  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TEST_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _hash(_rows(got)) == _hash(_rows(want))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "heart_rate_avg" in df.columns
