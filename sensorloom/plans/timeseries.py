"""Catalogue: time columns, buckets, gaps, ordered series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timefn import coerce_time, dashboard_range, date_to_ts, epoch_bucket, time_text
from ..operators import ordered as o
from ..operators import series as s
from .registry import query, r4, r6, r8, table
from .views import ORDER, SERIES

MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TYPES = ["click", "error", "purchase", "signup", "view"]
SMALL = 500  # chunk size that cuts every series even of a small table


@query(
    "coerce_time_number",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events",
)
def coerce_number(spark, d):
    e = table(spark, d, "events")
    epoch = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1_000_000)
    e = e.select("event_id", epoch.alias("epoch"))
    return e.select("event_id", time_text(coerce_time(e, "epoch"), MICROS).alias("ts"))


@query(
    "coerce_time_text",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events",
)
def coerce_text(spark, d):
    e = table(spark, d, "events")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    e = e.select("event_id", text.alias("t"))
    return e.select("event_id", time_text(coerce_time(e, "t"), MICROS).alias("ts"))


@query(
    "date_to_ts",
    "SELECT o_orderkey, strftime(date_trunc('day', o_orderdate), '%Y-%m-%d %H:%M:%S') AS midnight FROM orders",
)
def midnight(spark, d):
    o_ = table(spark, d, "orders")
    return o_.select("o_orderkey", time_text(date_to_ts(F.date_format("o_orderdate", "yyyy-MM-dd"))).alias("midnight"))


@query(
    "dashboard_range",
    """SELECT event_id, round(value, 6) AS value FROM events
    WHERE epoch(ts) >= 1704672000000 / 1000 AND epoch(ts) < 1704931200000 / 1000""",
)
def dashboard(spark, d):
    rows = dashboard_range(table(spark, d, "events"), "ts", 1704672000000, 1704931200000)
    return rows.select("event_id", r6("value"))


@query(
    "epoch_bucket",
    """SELECT event_type, CAST(floor(epoch(ts) / 600) * 600 AS BIGINT) AS bucket, count(*) AS n_rows FROM events GROUP BY 1, 2""",
)
def buckets(spark, d):
    e = table(spark, d, "events")
    return e.groupBy("event_type", epoch_bucket("ts", 600).alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "bucket_agg",
    """SELECT event_type, strftime(make_timestamp(CAST(floor(epoch(ts) / 3600) * 3600000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS bucket,
        round(max(value), 6) AS peak, round(avg(value), 6) AS mean FROM events GROUP BY 1, 2""",
)
def bucket_agg(spark, d):
    out = s.bucket_agg(
        table(spark, d, "events"), "ts", 3600, [F.max("value").alias("peak"), F.avg("value").alias("mean")], ["event_type"]
    )
    return out.select("event_type", time_text("bucket").alias("bucket"), r6("peak"), r6("mean"))


@query(
    "gap_fill",
    """WITH b AS (SELECT event_type, CAST(floor(epoch(ts) / 600) AS BIGINT) AS b, count(*) AS n_rows, avg(value) AS mean
            FROM events GROUP BY 1, 2),
        g AS (SELECT event_type, unnest(generate_series(min(b), max(b))) AS b FROM b GROUP BY event_type)
    SELECT g.event_type, strftime(make_timestamp(g.b * 600000000), '%Y-%m-%d %H:%M:%S') AS bucket, n_rows, round(mean, 6) AS mean
    FROM g LEFT JOIN b ON g.event_type = b.event_type AND g.b = b.b""",
)
def gap_fill(spark, d):
    have = s.bucket_agg(
        table(spark, d, "events"), "ts", 600,
        [F.count(F.lit(1)).alias("n_rows"), F.avg("value").alias("mean")], ["event_type"],
    )
    out = s.gap_fill(have, "bucket", 600, ["event_type"])
    return out.select("event_type", time_text("bucket").alias("bucket"), "n_rows", r6("mean"))


def _daily(spark, d):
    day = F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd").alias("day")
    return table(spark, d, "events").groupBy(day, "event_type").agg(F.count(F.lit(1)).alias("n_rows"))


_DAILY = "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n_rows FROM events GROUP BY 1, 2"


@query(
    "long_to_wide",
    "SELECT day, " + ", ".join(f"max(n_rows) FILTER (WHERE event_type = '{t}') AS {t}" for t in TYPES)
    + f" FROM ({_DAILY}) GROUP BY day",
)
def long_to_wide(spark, d):
    return s.long_to_wide(_daily(spark, d), "day", "event_type", "n_rows", TYPES)


@query(
    "wide_to_long",
    " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, '{c}' AS metric, round({c}, 6) AS value FROM lineitem"
        for c in ["l_discount", "l_quantity", "l_tax"]
    ),
)
def wide_to_long(spark, d):
    out = s.wide_to_long(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_discount", "l_quantity", "l_tax"])
    return out.select("l_orderkey", "l_linenumber", "metric", r6("value"))


@query("option_list", "SELECT DISTINCT event_type AS text, event_type AS value FROM events")
def option_list(spark, d):
    return s.option_list(table(spark, d, "events").select("event_type"))


@query("option_pairs", "SELECT DISTINCT n_name AS text, CAST(n_nationkey AS VARCHAR) AS value FROM nation")
def option_pairs(spark, d):
    n = table(spark, d, "nation")
    return s.option_list(n.select(F.col("n_name").alias("__text"), F.col("n_nationkey").alias("__value")))


@query(
    "last_value_alert",
    """SELECT event_type, round(arg_max(value, (ts, event_id)), 6) AS last_value,
        CASE WHEN arg_max(value, (ts, event_id)) > 50 THEN 1 ELSE 0 END AS alert
    FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-25' GROUP BY 1""",
)
def alert(spark, d):
    out = s.last_value_alert(
        table(spark, d, "events"), "ts", "value", "2024-01-01 00:00:00", "2024-01-25 00:00:00", 50, ["event_type"], "event_id"
    )
    return out.select("event_type", r6("last_value"), "alert")


_LAG = """SELECT event_id, round(lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id), 6) AS previous FROM events"""


@query("previous_value", _LAG)
def previous(spark, d):
    return o.previous_value(table(spark, d, "events"), SERIES, ORDER, "value").select("event_id", r6("previous"))


@query("previous_value_chunked", _LAG)
def previous_chunked(spark, d):
    out = o.previous_value(table(spark, d, "events"), SERIES, ORDER, "value", chunk_rows=SMALL)
    return out.select("event_id", r6("previous"))


_ROLL = """SELECT event_id, round(avg(value) OVER w, 8) AS rolling_mean, round(stddev_samp(value) OVER w, 4) AS rolling_std
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS 49 PRECEDING)"""


@query("rolling_stats", _ROLL)
def rolling(spark, d):
    out = o.rolling_stats(table(spark, d, "events"), SERIES, ORDER, "value")
    return out.select("event_id", r8("rolling_mean"), r4("rolling_std"))


@query("rolling_stats_chunked", _ROLL)
def rolling_chunked(spark, d):
    out = o.rolling_stats(table(spark, d, "events"), SERIES, ORDER, "value", chunk_rows=SMALL)
    return out.select("event_id", r8("rolling_mean"), r4("rolling_std"))


@query(
    "ordered_series",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, round(value, 6) AS value FROM events",
)
def ordered(spark, d):
    return table(spark, d, "events").orderBy(*ORDER).select("event_id", time_text("ts").alias("time"), r6("value"))


@query(
    "sample_per_class",
    """SELECT event_id, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) <= 10""",
)
def sample(spark, d):
    return o.first_per_series(table(spark, d, "events"), SERIES, ORDER, 10).select("event_id", "event_type")


_THIN = """SELECT event_id, event_type, round(value, 6) AS value FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) % 100 = 0"""


@query("thin_series", _THIN)
def thin(spark, d):
    out = o.every_nth(table(spark, d, "events"), SERIES, ORDER, 100)
    return out.select("event_id", "event_type", r6("value"))


@query("thin_series_chunked", _THIN)
def thin_chunked(spark, d):
    out = o.every_nth(table(spark, d, "events"), SERIES, ORDER, 100, chunk_rows=SMALL)
    return out.select("event_id", "event_type", r6("value"))
