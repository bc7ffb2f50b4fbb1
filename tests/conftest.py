import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tillstream.functions.keys import BASE, with_txn_key  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    session = builder.getOrCreate()
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


HEADER = ("0001", "20240102", "1001", "0000001001", "7")


@pytest.fixture(scope="session")
def segment(spark):
    """Build a segment table from (header overrides, own columns) dictionaries."""

    def build(rows, **types):
        names = list(dict.fromkeys(n for r in rows for n in r))
        fields = {"doc_id": "long", "pos": "long", **{b: "string" for b in BASE}}
        fields |= {n: types.get(n, "string") for n in names if n not in fields}
        schema = ", ".join(f"{n} {t}" for n, t in fields.items())
        data = []
        for i, row in enumerate(rows):
            full = {"doc_id": 1, "pos": i, **dict(zip(BASE, HEADER)), **row}
            data.append(tuple(full.get(n) for n in fields))
        return with_txn_key(spark.createDataFrame(data, schema))

    return build


@pytest.fixture
def values():
    """Sorted tuples of the given columns."""

    def collect(df, *cols):
        return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)

    return collect
