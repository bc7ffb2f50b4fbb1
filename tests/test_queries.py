"""Queries against their reference SQL at the smallest scale."""

import duckdb
import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
SKIP = ("ingest_", "t2", "t3", "t4", "op", "pipeline")  # covered by tests of their own


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns[-1] == "is_aligned_tran"


@pytest.mark.parametrize("name", [n for n in queries() if not n.startswith(SKIP)])
def test_query(spark, con, name):
    ok, note = check.compare(spark, con, SF, name)
    assert ok, note
