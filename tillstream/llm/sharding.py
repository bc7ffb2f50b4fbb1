"""Sharding by a two-pass external shuffle.

Pass one scatters whole records into buckets by a seeded hash of all their columns; a
bucket is sized to fit in a task's memory.  Pass two puts each bucket in a fixed order,
runs a Fisher-Yates shuffle over it and writes it.  Buckets laid end to end are one
random order of all records, and shards are equal cuts of that order, so their row
counts are at most one apart whatever the records hold.

Null ids, null or empty texts and repeated ids are ordinary records, as the hash covers
every column.  Records that agree in every column share a bucket while they fill a small
part of one; beyond that each is numbered among its copies and the number is hashed too, so
copies spread over all buckets.  An empty table gives an empty table.  Columns called ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tillstream.llm.common import numbered, quoted, small, without

BUCKET_BYTES = 16 << 20
MIN_BUCKETS = 256
BUCKETS_PER_TASK = 4
#: Copies of a record share a bucket up to this part of its bytes, and what a record weighs
#: besides its text.
ALIKE, RECORD_BYTES = 1 / 4, 64


def bucket_count(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets of about ``bucket_bytes`` of text each, and enough of them to spread."""
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(MIN_BUCKETS, -(-total // bucket_bytes))


def scattered(docs: DataFrame, n_buckets: int, seed: int, bucket_bytes: int) -> DataFrame:
    """Every record as ``_row`` with its ``_bucket``."""
    whole = F.xxhash64(F.lit(seed), *quoted(docs.columns))
    weight = F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(RECORD_BYTES)
    alike = docs.select(whole.alias("_hash"), weight.cast("long").alias("_bytes")).groupBy("_hash")
    heavy = alike.agg(F.count(F.lit(1)).alias("_n"), F.sum("_bytes").alias("_sum"))
    heavy = heavy.where((F.col("_n") > 1) & (F.col("_sum") > bucket_bytes * ALIKE))
    heavy = small(heavy.select("_hash"), "heavy")
    rows = docs.select(whole.alias("_hash"), F.struct(*quoted(docs.columns)).alias("_row"))
    if heavy.isEmpty():
        return rows.select(F.pmod("_hash", F.lit(n_buckets)).alias("_bucket"), "_row")
    light = rows.join(heavy, "_hash", "left_anti").select(F.pmod("_hash", F.lit(n_buckets)).alias("_bucket"), "_row")
    copies = numbered(rows.join(heavy, "_hash", "left_semi"), ["_hash"], "_copy")
    spread = F.pmod(F.xxhash64("_hash", "_copy"), F.lit(n_buckets))
    return light.unionAll(copies.select(spread.alias("_bucket"), "_row"))


def shard_documents(
    docs: DataFrame, n_shards: int = 24, seed: int = 17, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """All records with ``shard`` (0 to n_shards - 1) and ``slot`` (0, 1, ... in a shard)."""
    docs = docs.select(*quoted(without(docs, "shard", "slot")))
    n_buckets = bucket_count(docs, bucket_bytes)
    rows = scattered(docs, n_buckets, seed, bucket_bytes)

    counts = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        "_bucket",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(W.partitionBy(F.lit(0))).alias("_total"),
    )

    # One partition for a few buckets, taken in bucket order: the generator behind
    # shuffle() is seeded per partition, so the order depends on the records alone.
    shuffled = (
        rows.repartition(max(1, n_buckets // BUCKETS_PER_TASK), "_bucket")
        .groupBy("_bucket")
        .agg(F.collect_list("_row").alias("_rows"))
        .sortWithinPartitions("_bucket")
        .select("_bucket", F.shuffle(F.array_sort("_rows"), F.lit(seed)).alias("_rows"))
    )
    placed = shuffled.join(F.broadcast(offsets) if n_buckets <= 100_000 else offsets, "_bucket").select(
        "_offset", "_total", F.posexplode("_rows").alias("_at", "_row")
    )
    position = F.col("_offset") + F.col("_at")
    shard = F.expr(f"({n_shards} * (_position + 1) - 1) div _total")
    return (
        placed.select("_row", "_total", position.alias("_position"))
        .select("_row", "_total", "_position", shard.alias("_shard"))
        .select(
            "_row.*",
            F.col("_shard").cast("int").alias("shard"),
            F.expr(f"_position - (_shard * _total) div {n_shards}").alias("slot"),
        )
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder of Parquet files for each shard; ``slot`` gives the order to read in."""
    sharded.write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path)
