"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept.  Nulls, empty
and long texts, repeated rows and empty tables are treated as each operator says; a stage
before the last gives back exactly the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstream.llm import common, decontaminate, mixing, quality, sharding, simhash

SHARDS = 24

# No SQL: n-gram scores, fingerprints and seeded shuffles have no counterpart there.
ORACLE_SQL = None


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; the others go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.judge(docs, labels).where("kept").select(*common.quoted(docs.columns))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.deduplicate(docs)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their target weights; a document comes as often as it is taken."""
    return mixing.repeated(mixing.mix(docs))


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in random order, cut into shards."""
    return sharding.shard_documents(docs, SHARDS)


STAGES = [
    ("quality rules", good),
    ("near duplicates", distinct),
    ("decontamination", unleaked),
    ("source mix", mixed),
    ("shards", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written and read back before the next."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
