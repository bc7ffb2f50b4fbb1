"""Transaction keys, line-item keys and hashed surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BASE = [
    "retailstoreid",
    "businessdaydate",
    "transactiontypecode",
    "workstationid",
    "transactionsequencenumber",
]
TXN_PARTS = ["retailstoreid", "businessdaydate", "workstationid", "transactionsequencenumber"]

# A line item is joined on its columns, null-safe, never on glued-together text:
# gluing without a separator makes different items collide.
LINE_ITEM_KEY = BASE + ["retailsequencenumber"]

# Grouping scopes inside one document.
TXN = ["doc_id", "txn_key"]
TXN5 = ["doc_id", "txn5"]

# The columns hashed into each surrogate key, in order.
SURROGATE_KEYS = {
    "rtl_txn_rk": TXN_PARTS,
    "rtl_txn_fin_rk": TXN_PARTS + ["financialsequencenumber"],
    "rtl_txn_item_rk": TXN_PARTS + ["retailsequencenumber"],
    "rtl_txn_item_disc_rk": TXN_PARTS + ["retailsequencenumber", "discountsequencenumber"],
    "rtl_txn_item_tax_rk": TXN_PARTS + ["retailsequencenumber", "taxsequencenumber"],
    "rtl_txn_tender_rk": TXN_PARTS + ["tendersequencenumber"],
    "rtl_txn_disc_rk": TXN_PARTS + ["discountsequencenumber"],
}


def joined(cols: list[str | Column], nulls: str = "empty") -> Column:
    """``|``-joined text. ``nulls='empty'`` keeps every position, ``'skip'`` drops nulls."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    if nulls == "empty":
        parts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    elif nulls != "skip":
        raise ValueError(f"unknown null mode: {nulls}")
    return F.concat_ws("|", *parts)


def txn_key() -> Column:
    return joined(TXN_PARTS)


def txn5() -> Column:
    return joined(BASE)


def with_txn_key(df: DataFrame) -> DataFrame:
    """Add ``txn_key`` (four parts, the dedup key) and ``txn5`` (with the type)."""
    return df.withColumns({"txn_key": txn_key(), "txn5": txn5()})


def _xxh64(text: Column, seed: int = 0) -> Column:
    """Spark's own XXH64 expression with another seed than the 42 of ``xxhash64()``."""
    jvm = SparkSession.active().sparkContext._jvm
    utils = jvm.org.apache.spark.sql.classic.ExpressionUtils
    arguments = jvm.java.util.ArrayList()
    arguments.add(utils.expression(text._jc))
    arguments = jvm.org.apache.spark.api.python.PythonUtils.toSeq(arguments)
    hashed = jvm.org.apache.spark.sql.catalyst.expressions.XxHash64(arguments, seed)
    return Column(utils.column(hashed))


def surrogate_key(cols: list[str | Column], nulls: str = "empty") -> Column:
    """XXH64 with seed 0 over the joined text, as 8 big-endian bytes."""
    return F.unhex(F.lpad(F.hex(_xxh64(joined(cols, nulls))), 16, "0"))


def with_surrogate_keys(df: DataFrame, names: list[str], nulls: str = "empty") -> DataFrame:
    """Add the named keys in one projection."""
    return df.withColumns({n: surrogate_key(SURROGATE_KEYS[n], nulls) for n in names})
