"""Counters of a running stream, added up by stage and kept over restarts."""

from __future__ import annotations

import json
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from tillstream.sources.tables import exists, put_text

_SCHEMA = "query string, batch long, stage string, row_count long"


class StageCounters(StreamingQueryListener):
    """Keeps what ``audit.tap`` counts in each micro-batch, one small file for a batch.

    A stream keeps its id and the numbers of its batches over restarts, so a batch that is
    run again replaces its counts.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        told = event.progress
        # What a stage counts besides its rows is a stage of that name.
        rows = [
            {"query": str(told.id), "batch": told.batchId, "stage": stage if name == "rows" else name, "row_count": n}
            for stage, row in told.observedMetrics.items()
            for name, n in row.asDict().items()
        ]
        if rows:
            text = "".join(json.dumps(r) + "\n" for r in rows)
            put_text(self._spark, f"{self._path}/{told.id}-{told.batchId}.json", text)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


@contextmanager
def counting(spark: SparkSession, path: str):
    """Streams run inside are counted under ``path``; at the end all counts are there."""
    listener = StageCounters(spark, path)
    spark.streams.addListener(listener)
    try:
        yield
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)


def batches(spark: SparkSession, path: str) -> DataFrame:
    """Counts by query, batch and stage."""
    if not exists(spark, path):
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).json(path)


def totals(spark: SparkSession, path: str) -> DataFrame:
    """Rows of each stage over all batches so far."""
    return batches(spark, path).groupBy("stage").agg(F.sum("row_count").alias("row_count"))
