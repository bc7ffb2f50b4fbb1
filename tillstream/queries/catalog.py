"""Registry of runnable queries and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillstream.functions.keys import with_txn_key
from tillstream.plans import fixtures

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

KEY = (
    "coalesce(retailstoreid, '') || '|' || coalesce(businessdaydate, '') || '|' || "
    "coalesce(workstationid, '') || '|' || coalesce(transactionsequencenumber, '')"
)
KEY5 = (
    "coalesce(retailstoreid, '') || '|' || coalesce(businessdaydate, '') || '|' || "
    "coalesce(transactiontypecode, '') || '|' || "
    "coalesce(workstationid, '') || '|' || coalesce(transactionsequencenumber, '')"
)


class Tables:
    """Fixture tables of one scale directory, by attribute; segments carry their keys."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        df = fixtures.fixture(self.spark, self.sf_dir, name)
        return with_txn_key(df) if "transactionsequencenumber" in df.columns else df

    def table(self, name: str) -> DataFrame:
        return fixtures.read_table(self.spark, self.sf_dir, name)


def register(name: str, sql: str | None = None):
    """Register ``fn(tables)`` as a query, with SQL that computes the same rows."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def keyed(name: str) -> str:
    """A fixture's SQL with the two keys added, as a CTE body."""
    return f"select *, {KEY} as txn_key, {KEY5} as txn5 from ({fixtures.fixture_sql(name)})"


def ctes(*names: str, recursive: bool = False) -> str:
    """``with`` clause over keyed fixtures (dictionaries stay as they are)."""
    plain = ("marm", "mean", "mara", "tvarvc", "export")
    parts = [
        f"{n} as ({fixtures.fixture_sql(n) if n in plain else keyed(n)})" for n in names
    ]
    return ("with recursive " if recursive else "with ") + ",\n".join(parts)
