"""Dedup against history, survivors, incremental models and reports."""

from __future__ import annotations

import hashlib
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillstream.functions.keys import TXN_PARTS, joined, surrogate_key
from tillstream.sources.tables import commits, exists

EPOCH = datetime(1970, 1, 1)


def history_rows(stored: DataFrame, window_days: int, today: date | Column) -> DataFrame:
    """Key columns of the last business days; filter and columns reach the file scan."""
    cutoff = F.date_sub(today if isinstance(today, Column) else F.lit(today), window_days)
    return stored.where(F.col("businessdaydate") >= cutoff).select(*TXN_PARTS)


def txn_key_of(day: Column) -> Column:
    """Transaction key of stored rows, whose day is a date, given as compact text."""
    return joined([day if part == "businessdaydate" else part for part in TXN_PARTS])


def keys_of(stored: DataFrame) -> DataFrame:
    """Distinct transaction keys of stored rows, with the day as compact text.

    Null parts count as empty, as they do for live rows.
    """
    return stored.select(txn_key_of(F.date_format("businessdaydate", "yyyyMMdd")).alias("txn_key")).distinct()


def history_keys(
    spark: SparkSession, path: str, window_days: int = 3, today: date | Column | None = None
) -> DataFrame:
    """Transaction keys stored in a table directory in the last business days."""
    anchor = F.current_date() if today is None else today
    return keys_of(history_rows(spark.read.parquet(path), window_days, anchor))


#: Buckets of a laid-out history; at least the session's shuffle partitions.
BUCKETS = 64


def _history_table(spark: SparkSession, path: str, buckets: int) -> str:
    """The session's name of a laid-out history; files another session wrote are found."""
    name = "history_" + hashlib.md5(path.encode()).hexdigest()[:16]
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"create table {name} (txn_key string, retailstoreid string, businessdaydate date, "
            "workstationid string, transactionsequencenumber string, period date) using parquet "
            f"partitioned by (period) clustered by (txn_key) sorted by (txn_key) into {buckets} buckets "
            "location '" + path.replace("'", "\\'") + "'"
        )
        if exists(spark, path):
            spark.sql(f"alter table {name} recover partitions")
    return name


def lay_out(stored: DataFrame, path: str, unit: str = "day", buckets: int = BUCKETS) -> None:
    """Append key columns to a history laid out by period and bucketed by transaction key.

    Rows are dealt by bucket, so a load adds one file for each bucket and period it touches.
    """
    rows = stored.withColumn("period", F.date_trunc(unit, "businessdaydate").cast("date"))
    compact = F.date_format("businessdaydate", "yyyyMMdd")
    keyed = rows.withColumn("txn_key", txn_key_of(compact)).select("txn_key", *TXN_PARTS, "period")
    name = _history_table(stored.sparkSession, path, buckets)
    keyed.repartition(buckets, "txn_key").write.mode("append").insertInto(name)


def laid_out_keys(
    spark: SparkSession, path: str, since: date | Column, unit: str = "day", buckets: int = BUCKETS
) -> DataFrame:
    """Transaction keys of a laid-out history from a business day on.

    The filter on the period opens only the folders of the window, and as the files are
    bucketed by key, a join on it moves the other side only.
    """
    day = since if isinstance(since, Column) else F.lit(since)
    name = _history_table(spark, path, buckets)
    window = (F.col("period") >= F.date_trunc(unit, day).cast("date")) & (F.col("businessdaydate") >= day)
    return spark.table(name).where(window).select("txn_key")


def drop_seen(df: DataFrame, history: DataFrame) -> DataFrame:
    """Rows whose transaction key is not in history."""
    return df.join(history.select("txn_key"), "txn_key", "left_anti")


def first_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``.

    An aggregate rather than a window: copies of a key shrink to one row per task
    before the shuffle, so a key that holds a third of all rows is harmless.
    """
    rest = [c for c in df.columns if c not in keys]
    chosen = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(chosen).select(*keys, "_row.*").select(*df.columns)


def rededup(
    df: DataFrame, history: DataFrame, order: list[str], key: str = "txn_key"
) -> DataFrame:
    """After a key rewrite: drop keys already stored, then keep the first row of each."""
    return first_rows(df.join(history.select(key), key, "left_anti"), [key], order)


def incremental_new_rows(src: DataFrame, target: DataFrame) -> DataFrame:
    """Source rows newer than anything in the target.

    Both bounds come from one aggregate of the target; of Parquet files with
    ``spark.sql.parquet.aggregatePushdown`` the footers answer it.  The date bound prunes
    partitions of a source laid out by load date.
    """
    bounds = target.agg(
        F.struct(
            F.coalesce(F.max("load_ts_xml"), F.lit(EPOCH).cast("timestamp_ntz")).alias("ts"),
            F.coalesce(F.max("load_date_xml"), F.lit("1970-01-01").cast("date")).alias("day"),
        )
    ).scalar()
    newer = F.col("load_ts_xml") > bounds["ts"]
    return src.where(newer & (F.col("load_date_xml") >= bounds["day"]))


def append_incremental(spark: SparkSession, src: DataFrame, path: str) -> None:
    """Append the new rows of ``src`` to a Parquet table directory, which need not exist yet.

    The bound is read before the write, so a repeated append finds nothing new.
    """
    if not exists(spark, path):
        src.write.partitionBy("load_date_xml").parquet(path)
        return
    target = spark.read.schema(src.schema).parquet(path)
    newest = target.agg(F.max("load_ts_xml").alias("ts"), F.max("load_date_xml").alias("day")).first()
    if newest["ts"] is not None:
        src = src.where((F.col("load_ts_xml") > F.lit(newest["ts"])) & (F.col("load_date_xml") >= F.lit(newest["day"])))
    src.write.mode("append").partitionBy("load_date_xml").parquet(path)


def discount_ext_model(raw: DataFrame) -> DataFrame:
    """Staged transaction discount extensions; names keep 15 characters here."""
    return raw.select(
        *[c for c in ("rtl_txn_rk", "rtl_txn_disc_rk") if c in raw.columns],
        "retailstoreid",
        F.col("businessdaydate").cast("date").alias("businessdaydate"),
        F.substring("fieldgroup", 1, 5).alias("fieldgroup"),
        F.substring("fieldname", 1, 15).alias("fieldname"),
        "fieldvalue",
        "workstationid",
        "transactionsequencenumber",
        F.col("discountsequencenumber").try_cast("int").alias("discountsequencenumber"),
        "transactiontypecode",
        "load_ts",
        "load_date_xml",
        "load_ts_xml",
    )


def discount_model(wide: DataFrame) -> DataFrame:
    """Transaction discounts of the wide table, keyed by null-skipping hashes."""
    rows = wide.where(F.col("segment_name") == "E1BPTRANSACTIONDISCO")
    return rows.select(
        surrogate_key(TXN_PARTS, "skip").alias("rtl_txn_rk"),
        surrogate_key([*TXN_PARTS, "discountsequencenumber"], "skip").alias("rtl_txn_disc_rk"),
        F.col("businessdaydate").cast("timestamp").cast("date").alias("businessdaydate"),
        "discountsequencenumber",
        "discounttypecode",
        "reductionamount",
        "retailstoreid",
        "transactionsequencenumber",
        "transactiontypecode",
        "workstationid",
        "load_ts",
        F.col("load_ts").cast("date").alias("load_date"),
    )


def add_column(df: DataFrame, name: str, default=None, type_: str = "boolean") -> DataFrame:
    """Add a column with a default; an existing column only has its nulls filled."""
    value = F.lit(default).cast(type_)
    if name not in df.columns:
        return df.withColumn(name, value)
    return df if default is None else df.withColumn(name, F.coalesce(F.col(name), value))


def duplicate_keys(df: DataFrame, key: list[str], out: str = "qnty") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1)


def reconcile_amounts(items: DataFrame, tenders: DataFrame) -> DataFrame:
    """Tender and line amounts of each transaction, one row each, labelled by source."""
    return tenders.select(
        F.lit("tender").alias("src"), *TXN_PARTS, F.col("tenderamount").alias("amount")
    ).unionByName(
        items.select(
            F.lit("lineitem").alias("src"), *TXN_PARTS, F.col("salesamount").alias("amount")
        )
    )


def load_history(df: DataFrame) -> DataFrame:
    """Load batches in commit order, with their operation and row count."""
    return (
        df.groupBy(F.col("load_ts").alias("committed_at"))
        .agg(F.lit("append").alias("operation"), F.count(F.lit(1)).alias("rows_added"))
        .orderBy("committed_at")
    )


def committed_loads(spark: SparkSession, base_path: str) -> DataFrame:
    """Loads of a folder of targets by time, with rows and files added, from commit records."""
    return commits(spark, base_path).drop("attempt").orderBy("committed_at", "load_id", "target")
