"""Detectors that compare a reading with a band: fixed, fitted or rolling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.parsing import flag
from ..ordered import rolling_stats


def ksigma_fit(df: DataFrame, column: str, baseline: Column | None = None) -> DataFrame:
    """One row ``mean, std`` of the baseline rows (all rows without ``baseline``)."""
    rows = df if baseline is None else df.where(baseline)
    return rows.agg(F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"))


def ksigma_flag(
    df: DataFrame, column: str, stats: DataFrame | tuple[float, float], k: float = 1, name: str = "anomaly_flag"
) -> DataFrame:
    """1 strictly outside mean ± k·std.

    ``stats`` is the one-row frame of :func:`ksigma_fit`, which enters the plan as a
    scalar, or two numbers (the form a stream uses).
    """
    if isinstance(stats, DataFrame):
        one = stats.select(F.struct("mean", "std").alias("s")).scalar()
        mean, std = one.getField("mean"), one.getField("std")
    else:
        mean, std = F.lit(float(stats[0])), F.lit(float(stats[1]))
    x = F.col(column)
    return df.withColumn(name, flag((x > mean + k * std) | (x < mean - k * std)))


def zscore_flag(df: DataFrame, baselines: Mapping[str, tuple[float, float]], limit: float = 3.0) -> DataFrame:
    """Per sensor the distance from its mean in deviations, and 1 beyond the limit.

    A NULL reading has a NULL score and flag 0.
    """
    cols = {}
    for c, (mean, sd) in baselines.items():
        z = (F.col(c) - F.lit(mean)) / F.lit(sd)
        cols[f"z_{c}"] = z
        cols[f"anomaly_{c}"] = flag(F.abs(z) > limit)
    return df.select("*", *[e.alias(n) for n, e in cols.items()])


def adaptive_band_flag(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    column: str,
    rows: int = 50,
    deviations: float = 2,
    chunk_rows: int | None = None,
) -> DataFrame:
    """1 strictly outside rolling mean ± rolling deviation; 0 on the first row."""
    out = rolling_stats(df, series, order, column, rows, chunk_rows=chunk_rows)
    x, mean, std = F.col(column), F.col("rolling_mean"), F.col("rolling_std")
    return out.withColumn(
        "anomaly", flag((x > mean + deviations * std) | (x < mean - deviations * std))
    )
