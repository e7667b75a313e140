"""Percentiles over windows of a stream, from mergeable sketches kept as a table.

Each micro-batch adds one row per window and series: a KLL sketch of its readings, their number and range. Percentiles of any
window, or of several together, come from merging those rows; the readings are not read again. A late reading
goes into its window like any other, whenever it comes, so that no watermark drops it, and a repeated
batch replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import no_nan
from ..session import delete_folder, scratch_scope, write_scratch
from ..sinks.tables import append_batch_to_table

#: Accuracy of a sketch: it keeps about three times as many values.
SKETCH_K = 400


def rank_error(k: int = SKETCH_K) -> float:
    """How far a percentile's rank may be off, as a share of the readings, in 99 of 100 cases (the sketch's published bound)."""
    return 2.296 / k**0.9723


def _stats(k: int) -> list[Column]:
    return [
        F.kll_sketch_agg_double("__x", F.lit(k)).alias("sketch"), F.count("__x").alias("n_rows"),
        F.min("__x").alias("min_value"), F.max("__x").alias("max_value"),
    ]


def sketch_batches(
    path: str, ts: str, column: str, window: str, series: Sequence[str] = (), slide: str | None = None, k: int = SKETCH_K
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: a sketch of ``column`` per window and series of the batch goes to ``path``.

    NULL and NaN are no readings; rows without a time belong to no window. NULL series are a series.
    """
    write = append_batch_to_table(path)
    span = F.window(F.col(ts).cast("timestamp"), window, slide or window)

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("__x", no_nan(column)).where(F.col("__x").isNotNull() & F.col(ts).isNotNull())
        made = rows.groupBy(span.alias("__w"), *series).agg(*_stats(k))
        write(made.select(F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), *series, "sketch", "n_rows", "min_value", "max_value"), batch_id)

    return run


def stored_sketches(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`sketch_batches` stored so far, a row per batch, window and series."""
    return spark.read.option("basePath", path).parquet(f"{path}/batch_id=*")


def percentiles(sketches: DataFrame, by: Sequence[str], shares: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    """``by, n_rows, min_value, max_value`` and a column per share (``p50`` for 0.5) of the merged sketches of each group."""
    names = list(names or [f"p{100 * s:g}".replace(".", "_") for s in shares])
    merged = sketches.groupBy(*by).agg(
        F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n_rows").alias("n_rows"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
    )
    read = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(s))).alias(n) for s, n in zip(shares, names)]
    return merged.select(*by, "n_rows", "min_value", "max_value", *read)


def merge_batches(spark: SparkSession, path: str, series: Sequence[str] = (), upto: int | None = None) -> None:
    """Put the sketches of all batches up to ``upto`` (all but the newest, unless given) together under its number.

    The table then has a row per window and series again. Not to be run while that batch is being repeated.
    """
    stored = stored_sketches(spark, path)
    newest = stored.agg(F.max("batch_id")).first()[0]
    upto = newest - 1 if upto is None else upto
    old = sorted(r.batch_id for r in stored.where(F.col("batch_id") <= upto).select("batch_id").distinct().collect())
    if len(old) < 2:
        return
    keys = ["window_start", "window_end", *series]
    with scratch_scope(spark):
        merged = stored.where(F.col("batch_id") <= upto).groupBy(*keys).agg(
            F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n_rows").alias("n_rows"),
            F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
        )
        merged = write_scratch(merged, "merged")
        append_batch_to_table(path)(merged, old[-1])
    for batch in old[:-1]:
        delete_folder(spark, f"{path}/batch_id={batch}")
