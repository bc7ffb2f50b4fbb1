"""Helpers shared by the operators: words, scratch tables, checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from tillstream.sources.tables import shared_dir

# Fixed value: what separates words is space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows a table may have for its join to be hinted as a broadcast.
BROADCAST_ROWS = 20_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: Column) -> Column:
    """Number of words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def without(df: DataFrame, *names: str) -> list[str]:
    """The columns of a table apart from those an operator is about to add."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def quoted(names: list[str]) -> list[Column]:
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def packed(df: DataFrame, name: str = "row") -> Column:
    """All columns of a table as one struct, out of the way of an operator's own names."""
    return F.struct(*[c.alias(n) for c, n in zip(quoted(df.columns), df.columns)]).alias(name)


def unpacked(names: list[str], name: str = "row") -> list[Column]:
    """The columns of such a struct."""
    return [F.col(name).getField(n).alias(n) for n in names]


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Leave nothing behind: the session's file system drops the folder when it closes."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name under the cluster's shared folder, dropped with the session."""
    path = shared_dir(spark, label)
    delete_on_exit(spark, path)
    return path


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Later steps start from the files, so losing an executor costs no recomputation
    of what came before and every reader sees the same rows.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, label: str) -> DataFrame:
    """Store a table and hint a broadcast only if its row count allows one."""
    table = stored(df, label)
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def numbered(rows: DataFrame, by: list[str], name: str, order: tuple[str, ...] = ()) -> DataFrame:
    """Rows with their number (0, 1, ...) among those equal in ``by``, in the given order.

    For few keys with many rows each.  Rows are written with fixed ids and sorted over all
    tasks, so a key is spread over as many as it fills; only the rows of a key per task are
    added up under a window.
    """
    at = F.monotonically_increasing_id()
    fixed = stored(rows.withColumn("_at", at), "numbered")
    fixed = stored(fixed.orderBy(*by, *order, "_at").withColumn("_at", at), "numbered")
    # The upper bits of the id are the task, the lower ones count in it without gaps.
    fixed = fixed.withColumn("_task", F.shiftright("_at", 33))
    tasks = fixed.groupBy(*by, "_task").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = W.partitionBy(*by).orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    starts = tasks.select(
        *[F.col(c).alias(f"_of{i}") for i, c in enumerate(by)],
        F.col("_task").alias("_in"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_start"),
    )
    starts = small(starts, "numbered-starts")
    same = fixed["_task"] == starts["_in"]
    for i, c in enumerate(by):
        same = same & fixed[c].eqNullSafe(starts[f"_of{i}"])
    number = (F.col("_at") + F.col("_start")).alias(name)
    return fixed.join(starts, same).select(*quoted(rows.columns), number)


def append_arrow(df: DataFrame, make, added: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """Each Arrow batch with further columns.

    ``make()`` is called once per task and gives a function from a record batch to a
    list of arrays, one for each column of the DDL string ``added``.  Columns of those
    names are replaced, columns in ``drop`` are left out of the result.
    """
    import pyarrow as pa

    new = T.StructType.fromDDL(added)
    names = [f.name for f in new]
    old = without(df, *names)
    kept = [c for c in old if c not in drop]
    schema = T.StructType([df.schema[c] for c in kept] + list(new))

    def run(batches):
        step = make()
        for batch in batches:
            arrays = step(batch)
            # Spark reads columns by position; names may repeat in odd tables.
            columns = [batch.column(old.index(c)) for c in kept] + list(arrays)
            yield pa.RecordBatch.from_arrays(columns, names=kept + names)

    return df.select(*quoted(old)).mapInArrow(run, schema)


def texts_as_bytes(batch) -> list[bytes]:
    """The column ``text`` as UTF-8, null as empty."""
    import pyarrow as pa

    column = batch.column(batch.schema.get_field_index("text"))
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]
