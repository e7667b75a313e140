"""Time columns: parsing, coercion, buckets and ranges."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .parsing import as_col

SENSOR_FORMAT = "yyyy.MM.dd HH:mm"

_NUMBER = (T.NumericType,)

# Widths a dashboard interval is rounded to, in seconds.
NICE_SECONDS = [
    1, 2, 5, 10, 15, 20, 30, 60, 120, 300, 600, 900, 1200, 1800, 3600, 7200, 10800, 21600,
    43200, 86400, 604800, 2592000, 31536000,
]


def parse_ts(c: str | Column, fmt: str = SENSOR_FORMAT) -> Column:
    """Text to timestamp; text in another form becomes NULL. Blank text is missing."""
    return F.try_to_timestamp(F.nullif(F.trim(as_col(c)), F.lit("")), F.lit(fmt))


def coerce_time(df: DataFrame, column: str) -> Column:
    """A time column of any supported type as TIMESTAMP.

    Numbers are epoch seconds with the fraction kept, text is RFC 3339.
    """
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, T.NumericType):
        return F.timestamp_micros(F.floor(c.cast("decimal(28,9)") * F.lit(1_000_000)).cast("long"))
    if isinstance(kind, T.StringType):
        return F.try_to_timestamp(c)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp")
    raise TypeError(f"{column}: {kind.simpleString()} is no time")


def date_to_ts(c: str | Column) -> Column:
    """Date text to midnight UTC."""
    return F.try_to_timestamp(F.concat(as_col(c), F.lit("T00:00:00Z")))


def epoch_seconds(c: str | Column) -> Column:
    return F.unix_seconds(as_col(c).cast("timestamp"))


def epoch_bucket(c: str | Column, seconds: int, truncate: bool = False) -> Column:
    """Start of the bucket in epoch seconds.

    Rounds down; ``truncate`` rounds toward zero instead, which differs before 1970.
    """
    t = epoch_seconds(c)
    if truncate:
        return (t / F.lit(seconds)).cast("long") * F.lit(seconds)
    return (t - F.pmod(t, F.lit(seconds))).cast("long")


def bucket_start(c: str | Column, seconds: int) -> Column:
    return F.timestamp_seconds(epoch_bucket(c, seconds))


def time_text(c: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(as_col(c), fmt)


def time_range(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows between ``start`` and ``end``, both inclusive.

    The bounds are cast to the column's own type, so the comparison reaches the scan.
    """
    kind = df.schema[column].dataType.simpleString()
    return df.where(F.col(column).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def dashboard_range(df: DataFrame, column: str, from_ms: int, to_ms: int) -> DataFrame:
    """Half-open range in epoch milliseconds: ``from <= t < to``."""
    kind = df.schema[column].dataType
    lo, hi = (F.timestamp_millis(F.lit(ms)) for ms in (from_ms, to_ms))
    if isinstance(kind, T.TimestampNTZType):
        lo, hi = lo.cast("timestamp_ntz"), hi.cast("timestamp_ntz")
    elif isinstance(kind, T.NumericType):
        lo, hi = F.lit(from_ms / 1000), F.lit(to_ms / 1000)
    c = F.col(column)
    return df.where((c >= lo) & (c < hi))


def auto_interval(from_ms: int, to_ms: int, max_points: int = 1000) -> int:
    """Bucket width in seconds that keeps a range within ``max_points`` buckets."""
    raw = max((to_ms - from_ms) / 1000 / max(max_points, 1), 1)
    for width in NICE_SECONDS:
        if width >= raw:
            return width
    return math.ceil(raw / NICE_SECONDS[-1]) * NICE_SECONDS[-1]
