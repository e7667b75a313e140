"""Time-series query helpers: buckets, gap filling, wide and long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import bucket_start, epoch_bucket, time_range
from .ordered import join_same

_SPAN = 4096


def bucket_agg(
    df: DataFrame, ts: str, seconds: int, aggs: Sequence[Column], by: Sequence[str] = ()
) -> DataFrame:
    """Aggregates per time bucket (and series)."""
    return df.groupBy(*by, bucket_start(ts, seconds).alias("bucket")).agg(*aggs)


def gap_fill(
    df: DataFrame,
    ts: str,
    seconds: int,
    by: Sequence[str] = (),
    fill: dict[str, object] | None = None,
) -> DataFrame:
    """Add the missing buckets of each series between its first and last one.

    ``df`` has one row per series and bucket. Added rows are NULL but for ``fill``.
    The buckets of a series are made in spans of a few thousand, so a long series
    is spread over tasks.
    """
    step = F.lit(seconds)
    number = lambda c: (epoch_bucket(c, seconds) / step).cast("long")
    ends = df.groupBy(*by).agg(F.min(number(ts)).alias("lo"), F.max(number(ts)).alias("hi"))
    spans = ends.withColumn(
        "span",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("hi") - F.col("lo")) / _SPAN))),
    )
    spans = spans.repartition(*by, "span") if by else spans.repartition("span")
    start = F.col("lo") + F.col("span") * _SPAN
    grid = spans.select(
        *by, F.explode(F.sequence(start, F.least(F.col("hi"), start + _SPAN - 1))).alias("__b")
    )
    kind = df.schema[ts].dataType
    grid = grid.select(*by, F.timestamp_seconds(F.col("__b") * step).cast(kind).alias(ts))
    out = join_same(grid, df, [*by, ts]).select(*df.columns)
    return out.fillna(fill) if fill else out


def long_to_wide(
    df: DataFrame, ts: str, metric: str, value: str, metrics: Sequence[str]
) -> DataFrame:
    """One column per metric. Naming the metrics spares a pass that looks for them."""
    return df.groupBy(ts).pivot(metric, list(metrics)).agg(F.first(value, ignorenulls=True))


def wide_to_long(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], metric: str = "metric", value: str = "value"
) -> DataFrame:
    """One row per id and column."""
    return df.unpivot(list(ids), list(columns), metric, value)


def option_list(df: DataFrame) -> DataFrame:
    """Distinct choices: one column serves as text and value, or ``__text`` and ``__value``."""
    if len(df.columns) == 1:
        text = F.col(f"`{df.columns[0]}`").cast("string")
        return df.select(text.alias("text"), text.alias("value")).distinct()
    if len(df.columns) == 2:
        if set(df.columns) != {"__text", "__value"}:
            raise ValueError(f"two columns must be __text and __value, not {df.columns}")
        return df.select(
            F.col("__text").cast("string").alias("text"), F.col("__value").cast("string").alias("value")
        ).distinct()
    raise ValueError(f"one or two columns expected, found {df.columns}")


def last_value_alert(
    df: DataFrame,
    ts: str,
    value: str,
    start: str,
    end: str,
    above: float,
    by: Sequence[str] = (),
    tie: str | None = None,
) -> DataFrame:
    """Last value of each series in a time range, and 1 if it exceeds the threshold."""
    rows = time_range(df, ts, start, end)
    last = F.max_by(value, F.struct(ts, tie) if tie else F.col(ts))
    out = rows.groupBy(*by).agg(F.max(ts).alias("last_time"), last.alias("last_value"))
    return out.withColumn("alert", F.when(F.col("last_value") > above, 1).otherwise(0))
