"""Table directories: scans, dictionaries, appends to many targets."""

from __future__ import annotations

import json
import os
import threading
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

CONCURRENT_WRITES = 4


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory that every executor can reach.

    It lies under the folder the cluster names in ``spark.checkpoint.dir``.  Only a
    local session that names none gets a folder of its own.  What is left of it goes
    with the session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = os.path.join(os.path.abspath(os.curdir), "spark-warehouse", "shared")
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    files, where = _file_system(spark, path)
    files.deleteOnExit(where)
    return path


_open = threading.local()


#: Shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows dealt by some of a join's keys meet as they are.
_FEWER_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def lean(spark: SparkSession):
    """What queries run inside have shuffled is deleted as soon as each of them ends."""
    with _settings(spark, {_CLEAN_UP: "true"}):
        yield


@contextmanager
def meeting_in_buckets(spark: SparkSession):
    """Tables in buckets of a key (:func:`cut_buckets`) meet on it, alone or with others, without being moved."""
    with _settings(spark, {_FEWER_KEYS: "false"}):
        yield


@contextmanager
def temporary(spark: SparkSession):
    """Intermediate tables written inside are deleted at the end, also after an error.

    So is, as soon as each query ends, what it has shuffled (:func:`lean`).
    """
    scopes = _open.__dict__.setdefault("scopes", [])
    scopes.append([])
    try:
        with lean(spark):
            yield
    finally:
        for path in scopes.pop():
            _forget(spark, path)


def _forget(spark: SparkSession, path: str) -> None:
    spark.sql(f"drop table if exists {_name_of(path)}")
    delete(spark, path)


def _name_of(path: str) -> str:
    """The session's name of an intermediate table in buckets."""
    return path.rpartition("/")[2].replace("-", "_")


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def delete(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def cut_lineage(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write to the shared folder and read back: survives the loss of executors."""
    path = shared_dir(df.sparkSession, "stage")
    if scopes := _open.__dict__.get("scopes"):
        scopes[-1].append(path)
    writer = df.write if by is None else df.write.partitionBy(by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def cut_buckets(
    df: DataFrame, by: str | None = None, key: str = "doc_id", dealt: bool = False
) -> DataFrame:
    """Like :func:`cut_lineage`; all rows of a key lie in one of as many buckets as the session has partitions.

    Joins and sums by the key, alone or with others, then move no rows.  ``dealt`` rows were
    dealt by :func:`deal` before.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "stage")
    if scopes := _open.__dict__.get("scopes"):
        scopes[-1].append(path)
    writer = (df if dealt else deal(df, key)).write.format("parquet").bucketBy(_partitions(spark), key)
    writer = writer if by is None else writer.partitionBy(by)
    writer.option("path", path).saveAsTable(_name_of(path))
    return spark.table(_name_of(path)).select(*df.columns)


def deal(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows by bucket; a task has whole buckets."""
    return df.repartition(_partitions(df.sparkSession), key)


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int = 1000
) -> DataFrame:
    """Incremental scan of a table directory: each micro-batch reads the new files.

    A table that is a single file is watched through its folder.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    folder, _, name = path.rstrip("/").rpartition("/")
    files = spark.read.schema(schema).parquet(path).inputFiles()
    if len(files) == 1 and files[0].endswith("/" + name):
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


#: Size of a target's files before compression.
TARGET_BYTES = 256 << 20
#: Rows of a target that have this column stay together in a file.
KEY = "txn_key"
#: The folder of commit records, beside the targets.
COMMITS = "load_commits"
#: And of columns that targets gained.
COLUMNS = "added_columns"
_RECORD = (
    "load_id string, attempt string, committed_at timestamp_ntz, operation string, "
    "target string, rows_added long, files_added long"
)


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]):
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _data_files(spark: SparkSession, path: str) -> int:
    files, where = _file_system(spark, path)
    return sum(s.getPath().getName().startswith("part-") for s in files.listStatus(where))


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that appears whole, by one rename, or replaces the one there."""
    folder, _, name = path.rpartition("/")
    files, pending = _file_system(spark, f"{folder}/_pending-{uuid.uuid4().hex}")
    out = files.create(pending, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    _, done = _file_system(spark, path)
    if files.exists(done):
        files.delete(done, False)
    if not files.rename(pending, done):
        raise OSError(f"{path} could not be written")


def _commit(spark: SparkSession, base_path: str, records: list[dict]) -> None:
    """All records of a load become visible at once."""
    text = "".join(json.dumps(r) + "\n" for r in records)
    put_text(spark, f"{base_path}/{COMMITS}/{records[0]['attempt']}.json", text)


def _attempt() -> str:
    """A name that sorts by time."""
    return f"a-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def commits(spark: SparkSession, base_path: str) -> DataFrame:
    """One row for each load and target; of a repeated load the last commit counts."""
    path = f"{base_path}/{COMMITS}"
    if not exists(spark, path):
        return spark.createDataFrame([], _RECORD)
    records = spark.read.schema(_RECORD).json(path)
    place = F.struct("committed_at", "attempt")
    last = records.groupBy("load_id").agg(F.max(place).alias("_last"))
    return (
        records.join(last, "load_id")
        .where((F.col("attempt") == F.col("_last.attempt")))
        .select(*records.columns)
    )


def write_targets(
    routes: dict[str, DataFrame],
    load_id: str,
    base_path: str,
    committed_at: datetime | None = None,
    operation: str = "append",
) -> None:
    """Append each route to its own table directory; all of them become visible at once.

    Targets are written under the folder of this attempt.  When the last one is there, one
    commit record names the attempt with rows and files of each target, and
    :func:`read_target` reads committed attempts only.  A load that fails leaves nothing
    visible.  A repeated load is a new attempt whose commit replaces the one before, so it
    leaves the same rows; what it replaced is deleted.  Rows are rebalanced to files of
    ``TARGET_BYTES``, those of a transaction side by side: dealt out one by one they would
    compress worse, and whoever groups by transaction would shuffle every row again.  A key
    with more rows than a file is split.
    """
    if not routes:
        return
    spark = next(iter(routes.values())).sparkSession
    attempt = _attempt()

    def folder(table: str, of: str = attempt) -> str:
        return f"{base_path}/{table}/load_id={load_id}/attempt={of}"

    def write(table: str) -> dict:
        rows = routes[table]
        rows.hint("rebalance", *[F.col(c) for c in (KEY,) if c in rows.columns]).write.parquet(folder(table))
        # The count comes from the files' footers.
        rows = spark.read.parquet(folder(table)).count()
        return {"target": table, "rows_added": rows, "files_added": _data_files(spark, folder(table))}

    before = {
        (r["target"], r["attempt"]) for r in commits(spark, base_path).where(F.col("load_id") == load_id).collect()
    }
    try:
        # Small targets leave most of a cluster idle, so a few are written at a time.
        with _settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_BYTES)}):
            with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
                written = list(pool.map(write, routes))
    except BaseException:
        for table in routes:
            delete(spark, folder(table))
        raise
    told = (committed_at or datetime.now()).isoformat()
    common = {"load_id": load_id, "attempt": attempt, "committed_at": told, "operation": operation}
    _commit(spark, base_path, [common | w for w in written])
    for table, old in before:
        delete(spark, folder(table, old))


def add_column(
    spark: SparkSession, base_path: str, table: str, name: str, type_: str, default=None
) -> None:
    """Give a stored target a column: rows of loads before now have the default.

    No file is rewritten.  Loads from now on may bring the column and keep their nulls.
    """
    record = {"target": table, "name": name, "type": type_, "default": default, "since": _attempt()}
    if default is not None:
        record["default"] = str(default)
    if not any(r["name"] == name for r in _added_columns(spark, base_path, table)):
        put_text(spark, f"{base_path}/{COLUMNS}/{table}-{name}.json", json.dumps(record) + "\n")


def _added_columns(spark: SparkSession, base_path: str, table: str) -> list:
    path = f"{base_path}/{COLUMNS}"
    if not exists(spark, path):
        return []
    records = spark.read.schema("target string, name string, type string, default string, since string").json(path)
    return records.where(F.col("target") == table).sort("since").collect()


def read_target(spark: SparkSession, base_path: str, table: str) -> DataFrame:
    """Rows of the committed loads of a target, with their ``load_id``.

    Attempts are folders, so the join with the commit records prunes what is not committed.
    """
    known = commits(spark, base_path).where(F.col("target") == table).select("load_id", "attempt")
    path = f"{base_path}/{table}"
    stored, added = spark.read.parquet(path), _added_columns(spark, base_path, table)
    if added:
        # One file's columns are taken for all, so the added ones are named.
        schema = T.StructType([f for f in stored.schema if f.name not in {r["name"] for r in added}])
        for r in added:
            schema = schema.add(r["name"], T._parse_datatype_string(r["type"]))
        stored = spark.read.schema(schema).parquet(path)
        for r in added:
            old = F.lit(r["default"]).cast(r["type"])
            stored = stored.withColumn(r["name"], F.when(F.col("attempt") < r["since"], old).otherwise(F.col(r["name"])))
    columns = [c for c in stored.columns if c not in ("attempt", "load_id")]
    return stored.drop("load_id").join(F.broadcast(known), "attempt").select(*columns, "load_id")


class Dictionaries:
    """Dictionary tables, read again only when they changed.

    ``watched`` tables are read again when their set of files differs; ``flags`` are
    looked at only after ``flag_interval_s``; ``once`` tables are read a single time.
    Call :meth:`get` inside ``foreachBatch`` so each batch sees one version.
    """

    def __init__(
        self,
        spark: SparkSession,
        paths: dict[str, str],
        flags: tuple[str, ...] = ("tvarvc",),
        once: tuple[str, ...] = ("export",),
        flag_interval_s: float = 600.0,
        clock: Callable[[], float] = time.monotonic,
    ):
        self._spark, self._paths = spark, paths
        self._flags, self._once = flags, once
        self._interval, self._clock = flag_interval_s, clock
        self._tables: dict[str, DataFrame] = {}
        self._versions: dict[str, frozenset[str]] = {}
        self._checked: dict[str, float] = {}
        self.reloads: dict[str, int] = {name: 0 for name in paths}

    def get(self, name: str) -> DataFrame:
        if name in self._tables and not self._due(name):
            return self._tables[name]
        fresh = self._spark.read.parquet(self._paths[name])
        version = frozenset(fresh.inputFiles())
        self._checked[name] = self._clock()
        if self._versions.get(name) != version:
            self._tables[name], self._versions[name] = fresh, version
            self.reloads[name] += 1
        return self._tables[name]

    def _due(self, name: str) -> bool:
        if name in self._once:
            return False
        if name in self._flags:
            return self._clock() - self._checked[name] >= self._interval
        return True
