"""Run a stream until its input is used up, and read what it wrote."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tillstream.sources.tables import delete, shared_dir
from tillstream.streaming.dedup import ROCKSDB

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def state_settings(spark: SparkSession):
    """Queries started inside keep their state in RocksDB; partitions are the session's."""
    wanted = {_PROVIDER: ROCKSDB}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _idle(query: StreamingQuery) -> bool:
    """All input seen: the query waits for data, or ran two batches that found none.

    Queries with processing-time state run empty batches forever, so
    ``processAllAvailable`` would not return.  One empty batch is not enough: after a
    restart the first one repeats what was planned before the stop and looks for nothing.
    """
    status, last = query.status, query.recentProgress[-2:]
    if status["message"].startswith("Waiting for data"):
        return True
    empty = [p["numInputRows"] == 0 for p in last]
    return empty == [True, True] and not status["isDataAvailable"]


def _worked(query: StreamingQuery) -> int:
    """The last batch that read rows or changed state, -1 if none did."""
    worked = [
        p["batchId"]
        for p in query.recentProgress
        if p["numInputRows"] or any(o["numRowsUpdated"] or o["numRowsRemoved"] for o in p["stateOperators"])
    ]
    return max(worked, default=-1)


class _Patience:
    """Time is up ``patience_s`` after the last batch that had work.

    A batch tells what it did only when it ends, and a large one may take longer than that.
    While one runs, every task that ends is a sign of work; if the batch ends without any, its
    tasks count for nothing.
    """

    def __init__(self, patience_s: float, now: float):
        self.patience_s, self.deadline, self.before = patience_s, now + patience_s, -1
        self.told, self.tasks, self.running = None, None, None

    def over(self, query: StreamingQuery, tasks: list, now: float) -> bool:
        """Whether time is up; ``tasks`` are the ended tasks of each active stage."""
        last = query.recentProgress[-1:]
        told = [(p["batchId"], p["timestamp"]) for p in last]
        if (worked := _worked(query)) > self.before:
            self.deadline, self.before = now + self.patience_s, worked
        if told != self.told:
            self.told, self.running = told, None
        elif tasks and tasks != self.tasks:
            self.running = now + self.patience_s
        self.tasks = tasks
        return now > max(self.deadline, self.running or self.deadline)


def _ended_tasks(spark: SparkSession) -> list[tuple[int, int]]:
    """Ended tasks of each active stage of the application."""
    tracker = spark.sparkContext.statusTracker()
    infos = [(s, tracker.getStageInfo(s)) for s in sorted(tracker.getActiveStageIds())]
    return [(s, info.numCompletedTasks) for s, info in infos if info is not None]


def drain(
    writer: DataStreamWriter,
    spark: SparkSession,
    done: Callable[[], bool] | None = None,
    patience_s: float = 600.0,
    checkpoint: str | None = None,
) -> None:
    """Start, process all input, wait for ``done`` (timers need time to fire), stop.

    A given checkpoint is kept, so a later run goes on from there.  Streams whose state has
    a lifetime run empty batches for ever, also with ``availableNow``, so the end of the input
    is looked for.  ``patience_s`` counts from the last batch that had work, or the last task of
    the batch that runs, so a long input may take as long as it needs, also in one batch.
    """
    own = checkpoint is None
    with state_settings(spark):
        checkpoint = shared_dir(spark, "checkpoint") if own else checkpoint
        query = writer.option("checkpointLocation", checkpoint).start()
        try:
            patience = _Patience(patience_s, time.monotonic())
            while not (_idle(query) and (done is None or done())):
                if query.exception() is not None:
                    raise query.exception()
                if patience.over(query, _ended_tasks(spark), time.monotonic()):
                    raise TimeoutError(f"no work done for {patience_s} s, but the stream is not at its end")
                time.sleep(0.2)
        finally:
            query.stop()
            if own:
                delete(spark, checkpoint)


def to_table(
    stream: DataFrame, done: Callable[[DataFrame], bool] | None = None, patience_s: float = 600.0
) -> DataFrame:
    """Drain a stream into a table directory and return it as a batch table."""
    spark = stream.sparkSession
    path = shared_dir(spark, "stream")

    def written() -> DataFrame:
        return spark.read.schema(stream.schema).parquet(path)

    writer = stream.writeStream.format("parquet").option("path", path).outputMode("append")
    drain(writer, spark, None if done is None else lambda: done(written()), patience_s)
    return written()
