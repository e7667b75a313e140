"""Writing tables: append, replace, delete, export, and idempotent micro-batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import with_rank
from ..sources.tables import CSV_FORM, CSV_NULL

CHUNK_ROWS = 10_000


def to_json_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Each row as a JSON message: ``value BINARY`` (and ``key``)."""
    value = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).cast("binary").alias("value")
    return df.select(F.col(key).cast("string").cast("binary").alias("key"), value) if key else df.select(value)


def publish_batch(df: DataFrame, servers: str, topic: str, key: str | None = None) -> None:
    """Send every row of a table to a topic."""
    (
        to_json_messages(df, key)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def append_batch_to_table(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer: one folder per batch id, so a repeated batch replaces itself."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """What :func:`append_batch_to_table` wrote, without the batch number."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.option("basePath", path).parquet(f"{path}/batch_id=*").drop("batch_id")


def append_batch_jdbc(url: str, table: str, rows: int = CHUNK_ROWS, **options: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer into a database. Every row carries its ``batch_id``.

    JDBC has no cross-task transaction: readers take the last copy of a batch, or the
    target keeps a unique key on it.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        (
            df.withColumn("batch_id", F.lit(batch_id))
            .write.format("jdbc")
            .options(url=url, dbtable=table, batchsize=rows, **options)
            .mode("append")
            .save()
        )

    return write


def append_rows(df: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    """Append one or many rows to a table."""
    writer = df.write.mode("append")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def _folders(spark: SparkSession, path: str):
    """File system, path, its parent and name of a table's folder."""
    parent, _, name = path.rstrip("/").rpartition("/")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target, parent, name


def recover_table(spark: SparkSession, path: str) -> None:
    """Put a table back that a broken-off :func:`replace_table` had moved aside; else do nothing."""
    fs, target, parent, name = _folders(spark, path)
    if fs.exists(target):
        return
    aside = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{parent}/_{name}.old-*"))
    if aside is not None and len(aside):
        fs.rename(aside[0].getPath(), target)


def _swap(spark: SparkSession, new: str, path: str, old: str) -> None:
    """Put the finished folder ``new`` in the place of ``path``, by way of ``old``."""
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs, target, _, _ = _folders(spark, path)
    if fs.exists(target) and not fs.rename(target, path_of(old)):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(path_of(new), target):
        recover_table(spark, path)
        raise OSError(f"cannot put the new table at {path}")
    fs.delete(path_of(old), True)


def replace_table(df: DataFrame, path: str) -> None:
    """Replace the whole table, which may also be the input of ``df``.

    The new rows are complete before the table moves. If the work breaks off between the two
    renames, :func:`recover_table`, which ``read_table`` and ``delete_rows`` call, restores the
    table as it was. Each call has folders of its own, so that two writers never share one.
    """
    spark = df.sparkSession
    _, _, parent, name = _folders(spark, path)
    mark = uuid.uuid4().hex
    fresh = f"{parent}/_{name}.new-{mark}"
    df.write.parquet(fresh)
    _swap(spark, fresh, path, f"{parent}/_{name}.old-{mark}")


def keep_after_delete(df: DataFrame, condition: Column) -> DataFrame:
    """Rows a delete leaves: where the condition is false or unknown."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def delete_rows(spark: SparkSession, path: str, condition: Column) -> None:
    """Remove matching rows by rewriting the table."""
    recover_table(spark, path)
    replace_table(keep_after_delete(spark.read.parquet(path), condition), path)


def export_csv(df: DataFrame, path: str, drop: Sequence[str] = (), sep: str = ",") -> None:
    """Table to CSV files with a header; columns in ``drop`` are left out.

    Every value is quoted and a missing one written as CSV_NULL, so that line breaks, quotes and
    empty texts survive; ``read_exported_csv`` reads them back. A text equal to CSV_NULL is
    refused, as it would come back missing.
    """
    kept = [c for c in df.columns if c not in drop]
    texts = {c for c, kind in df.dtypes if kind == "string"}
    message = F.lit(f"a text equal to {CSV_NULL} cannot be exported")
    safe = [F.when(F.col(c) == CSV_NULL, F.raise_error(message)).otherwise(F.col(c)).alias(c) if c in texts else F.col(c) for c in kept]
    df.select(*safe).write.mode("overwrite").options(header=True, sep=sep, **CSV_FORM).csv(path)


def assign_batches(
    df: DataFrame,
    order: Sequence[str],
    batch_rows: int = 1000,
    series: Sequence[str] = (),
    name: str = "batch_no",
    chunk_rows: int | None = None,
) -> DataFrame:
    """Number consecutive batches of ``batch_rows`` rows in order, from 0."""
    ranked = with_rank(df, series, order, "__rank", chunk_rows)
    return ranked.withColumn(name, F.floor((F.col("__rank") - 1) / batch_rows)).drop("__rank")


def stage_batches(df: DataFrame, batch: str, order: Sequence[str], folder: str) -> None:
    """Write one file per value of ``batch``, rows in order inside, for a stream to read in that order.

    One job writes all files, each task a range of batches. A file stream takes files by their
    time, so that each gets a time of its own, one second apart.
    """
    spark = df.sparkSession
    dealt = df.repartitionByRange(batch).sortWithinPartitions(batch, *order)
    dealt.write.partitionBy(batch).parquet(folder)
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path_of(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    begin = fs.getFileStatus(path_of(folder)).getModificationTime() - 86_400_000
    for status in fs.globStatus(path_of(f"{folder}/{batch}=*/*.parquet")):
        number = int(status.getPath().getParent().getName().removeprefix(f"{batch}="))
        fs.setTimes(status.getPath(), begin + 1000 * number, -1)


def backfill_in_batches(
    df: DataFrame,
    order: Sequence[str],
    staging: str,
    send: Callable[[DataFrame, int], None],
    batch_rows: int = 1000,
    progress: Callable[[dict], None] | None = None,
) -> int:
    """Push a stored table through ``send`` in ordered batches of bounded size.

    The table is staged once, a file per batch, and one streaming query reads a file at a time, so
    that a broken-off run goes on at the batch it had reached. Returns the number of batches.
    ``progress`` gets batch, rows and totals.
    """
    from ..sources.tables import stream_batches
    from ..streaming.runtime import drain, start

    spark = df.sparkSession
    numbered = assign_batches(df, order, batch_rows)
    stage_batches(numbered, "batch_no", order, staging)
    total = spark.read.parquet(staging).count()

    def push(batch: DataFrame, number: int) -> None:
        send(batch.drop("batch_no"), number)
        if progress:
            sent = min((number + 1) * batch_rows, total)
            progress({"batch": number, "rows": sent - number * batch_rows, "sent": sent, "total": total})

    if total:
        drain(start(stream_batches(spark, staging, numbered.schema), f"{staging}.checkpoint", push))
    return -(-total // batch_rows)
