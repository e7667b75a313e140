"""Time-window aggregates. Each works on a table and on a stream.

All of them are plain ``groupBy`` aggregates: Spark combines rows on the map side
before it shuffles, so a hot window or series costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import time_text


def with_event_time(df: DataFrame, column: str, watermark: str | None = None) -> DataFrame:
    """TIMESTAMP event time; streams may add a watermark on it."""
    if dict(df.dtypes)[column] != "timestamp":
        df = df.withColumn(column, F.col(column).cast("timestamp"))
    return df.withWatermark(column, watermark) if watermark and df.isStreaming else df


def _window(ts: str, width: str, slide: str | None) -> Column:
    return F.window(ts, width, slide) if slide else F.window(ts, width)


def _grouped(
    df: DataFrame, ts: str, width: str, by: Sequence[str], aggs: Sequence[Column],
    watermark: str | None, slide: str | None = None,
) -> DataFrame:
    df = with_event_time(df, ts, watermark)
    out = df.groupBy(*by, _window(ts, width, slide).alias("__w")).agg(*aggs)
    rest = [c for c in out.columns if c not in (*by, "__w")]
    return out.select(*by, F.col("__w.start").alias("window_start"), *rest)


def tumbling_mean(
    df: DataFrame,
    ts: str,
    columns: Sequence[str],
    width: str = "1 minute",
    by: Sequence[str] = (),
    watermark: str | None = None,
) -> DataFrame:
    """Mean of each column and number of rows per window, and per ``by`` value."""
    aggs = [F.avg(c).alias(f"avg_{c}") for c in columns]
    return _grouped(df, ts, width, by, [*aggs, F.count(F.lit(1)).alias("record_count")], watermark)


def window_features(
    df: DataFrame,
    ts: str,
    columns: Sequence[str],
    width: str = "1 minute",
    by: Sequence[str] = (),
    slide: str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Mean, sample deviation, minimum and maximum per column, and the row count."""
    aggs = []
    for c in columns:
        aggs += [
            F.avg(c).alias(f"mean_{c}"),
            F.stddev_samp(c).alias(f"stddev_{c}"),
            F.min(c).alias(f"min_{c}"),
            F.max(c).alias(f"max_{c}"),
        ]
    return _grouped(
        df, ts, width, by, [*aggs, F.count(F.lit(1)).alias("record_count")], watermark, slide
    )


def row_count(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value."""
    return df.groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("n_rows"))


def mean_std(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean and sample deviation of a column."""
    return df.groupBy(*by).agg(F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"))


def series_stats(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Minimum, maximum and mean of a series."""
    return df.groupBy(*by).agg(
        F.min(column).alias("min_value"), F.max(column).alias("max_value"), F.avg(column).alias("mean_value")
    )


def window_as_text(df: DataFrame, column: str = "window_start") -> DataFrame:
    """Window start as text, the form in which aggregates are stored."""
    return df.withColumn(column, time_text(column))
