"""Catalogue: window aggregates, profiles and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.parsing import parse_message
from ..functions.timefn import parse_ts
from ..operators import aggregate as a
from ..operators import evaluate as ev
from ..operators import gram
from ..operators import profile as p
from ..operators.quality import drop_blank_or_zero
from .ingest import MESSAGE, MICROS, messages
from .registry import query, r4, r6, table
from .views import SPLIT_AT, SQL_READINGS, SQL_SCORED, readings, scored, vectors

FOUR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _union(parts):
    return " UNION ALL ".join(parts)


@query(
    "tumbling_mean_by_split",
    f"""SELECT data_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
        round(avg(value), 6) AS avg_value, round(avg(user_id), 6) AS avg_user_id, count(*) AS record_count
    FROM ({SQL_READINGS}) WHERE value <> 0 OR user_id <> 0 GROUP BY 1, 2""",
)
def tumbling_mean_by_split(spark, d):
    """Messages, parsed, cleaned, split and averaged per hour."""
    parsed = parse_message(messages(spark, d), MESSAGE).withColumn("ts", parse_ts("ts", MICROS))
    clean = drop_blank_or_zero(parsed, ["value", "user_id"])
    split = F.when(F.col("ts") < F.lit(SPLIT_AT).cast("timestamp"), "train").otherwise("test")
    means = a.tumbling_mean(
        clean.withColumn("data_type", split), "ts", ["value", "user_id"], "1 hour", ["data_type"]
    )
    return a.window_as_text(means).select(
        "data_type", "window_start", r6("avg_value"), r6("avg_user_id"), "record_count"
    )


@query(
    "tumbling_mean",
    """SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
        round(avg(value), 6) AS avg_value, count(*) AS record_count FROM events GROUP BY 1""",
)
def tumbling_mean(spark, d):
    means = a.tumbling_mean(table(spark, d, "events"), "ts", ["value"], "1 minute")
    return a.window_as_text(means).select("window_start", r6("avg_value"), "record_count")


@query(
    "tumbling_features",
    """SELECT event_type, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
        round(avg(value), 6) AS mean_value, round(stddev_samp(value), 4) AS stddev_value,
        round(min(value), 6) AS min_value, round(max(value), 6) AS max_value, count(*) AS record_count
    FROM events GROUP BY 1, 2""",
)
def tumbling_features(spark, d):
    f = a.window_features(table(spark, d, "events"), "ts", ["value"], "1 day", ["event_type"])
    return a.window_as_text(f).select(
        "event_type", "window_start", r6("mean_value"), r4("stddev_value"), r6("min_value"), r6("max_value"),
        "record_count",
    )


@query(
    "sliding_features",
    """SELECT strftime(make_timestamp((floor(epoch(ts) / 43200)::BIGINT - s) * 43200 * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
        round(avg(value), 6) AS mean_value, count(*) AS record_count
    FROM events, (VALUES (0), (1)) AS shifts(s) GROUP BY 1""",
)
def sliding_features(spark, d):
    f = a.window_features(table(spark, d, "events"), "ts", ["value"], "1 day", slide="12 hours")
    return a.window_as_text(f).select("window_start", r6("mean_value"), "record_count")


@query("mean_std", "SELECT round(avg(value), 6) AS mean, round(stddev_samp(value), 4) AS std FROM events")
def mean_std(spark, d):
    return a.mean_std(table(spark, d, "events"), "value").select(r6("mean"), r4("std"))


_STATS = """SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
    round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50,
    round(quantile_cont({c}, 0.75), 4) AS p75, round(max({c}), 4) AS max FROM lineitem"""
_STAT_NAMES = ["mean", "std", "min", "p25", "p50", "p75", "max"]


@query("describe_numeric", _union([_STATS.format(c=c) for c in FOUR]))
def describe_numeric(spark, d):
    out = p.describe(table(spark, d, "lineitem"), FOUR)
    return out.select("column_name", "n", *[r4(c) for c in _STAT_NAMES])


@query("describe_numeric_chunked", _union([_STATS.format(c=c) for c in FOUR]))
def describe_chunked(spark, d):
    """The same with the sorted values cut into many chunks."""
    out = p.describe(table(spark, d, "lineitem"), FOUR, chunk_rows=5000)
    return out.select("column_name", "n", *[r4(c) for c in _STAT_NAMES])


@query(
    "percentiles_by_series",
    _union(
        f"""SELECT event_type, CAST({f} AS DOUBLE) AS fraction, round(quantile_cont(value, {f}), 6) AS value
        FROM events GROUP BY event_type"""
        for f in (0.05, 0.5, 0.95)
    ),
)
def percentiles(spark, d):
    out = p.exact_percentiles_by(table(spark, d, "events"), ["value"], ["event_type"], [0.05, 0.5, 0.95])
    return out.select("event_type", "fraction", r6("value"))


@query(
    "pairwise_corr",
    _union(
        f"SELECT '{x}' AS column_a, '{y}' AS column_b, round(corr({x}, {y}), 4) AS r FROM lineitem"
        for x in FOUR for y in FOUR if x != y
    ),
)
def pairwise(spark, d):
    return p.pairwise_corr(table(spark, d, "lineitem"), FOUR).select("column_a", "column_b", r4("r"))


@query(
    "corr_with_target",
    _union(
        f"SELECT '{c}' AS column_name, round(corr({c}, l_extendedprice), 4) AS r FROM lineitem"
        for c in FOUR if c != "l_extendedprice"
    ),
)
def corr_target(spark, d):
    return p.corr_with_target(table(spark, d, "lineitem"), FOUR, "l_extendedprice").select("column_name", r4("r"))


@query(
    "corr_matrix",
    _union(
        f"SELECT '{x}' AS column_name, " + ", ".join(f"round(corr({x}, {y}), 4) AS {y}" for y in FOUR) + " FROM lineitem"
        for x in FOUR
    ),
)
def matrix(spark, d):
    return p.corr_matrix(table(spark, d, "lineitem"), FOUR).select("column_name", *[r4(c) for c in FOUR])


@query("value_counts", "SELECT event_type AS label, count(*) AS n_rows FROM events GROUP BY event_type")
def value_counts(spark, d):
    return a.value_counts(table(spark, d, "events"), "event_type")


@query(
    "histogram",
    """WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
    SELECT CAST(least(floor((value - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bucket,
        round(lo + least(floor((value - lo) / ((hi - lo) / 20)), 19) * ((hi - lo) / 20), 6) AS bucket_start, count(*) AS n_rows
    FROM events, e GROUP BY 1, 2""",
)
def histogram(spark, d):
    return p.histogram(table(spark, d, "events"), "value", 20).select("bucket", r6("bucket_start"), "n_rows")


@query(
    "series_stats",
    """SELECT event_type, round(min(value), 6) AS min_value, round(max(value), 6) AS max_value,
        round(avg(value), 6) AS mean_value FROM events GROUP BY event_type""",
)
def series_stats(spark, d):
    out = a.series_stats(table(spark, d, "events"), "value", ["event_type"])
    return out.select("event_type", r6("min_value"), r6("max_value"), r6("mean_value"))


@query(
    "table_profile",
    _union(
        f"""SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null, count(*) AS n_rows
        FROM orders"""
        for i, (c, t) in enumerate(
            [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
             ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
        )
    ),
)
def table_profile(spark, d):
    return p.table_profile(table(spark, d, "orders"))


_COUNTS = f"""WITH s AS ({SQL_SCORED}), c AS (SELECT
    count(*) FILTER (WHERE truth = 1 AND prediction = 1)::DOUBLE AS tp, count(*) FILTER (WHERE truth = 0 AND prediction = 1)::DOUBLE AS fp,
    count(*) FILTER (WHERE truth = 1 AND prediction = 0)::DOUBLE AS fn, count(*) FILTER (WHERE truth = 0 AND prediction = 0)::DOUBLE AS tn
    FROM s), m AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
    coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0, tp + fn AS s1, tn + fp AS s0 FROM c),
    f AS (SELECT *, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0,
    (tp + tn) / (s0 + s1) AS acc FROM m) """
_LINE = "SELECT '{}' AS label, round({}, 6) AS precision, round({}, 6) AS recall, round({}, 6) AS f1_score, CAST({} AS BIGINT) AS support FROM f"


@query(
    "confusion_matrix",
    f"""WITH s AS ({SQL_SCORED}), g AS (SELECT t AS truth, p AS prediction FROM (VALUES (0), (1)) a(t), (VALUES (0), (1)) b(p))
    SELECT g.truth, g.prediction, count(s.truth) AS n_rows FROM g LEFT JOIN s USING (truth, prediction) GROUP BY 1, 2""",
)
def confusion(spark, d):
    return ev.confusion_matrix(scored(spark, d), "truth", "prediction")


@query(
    "classification_report",
    _COUNTS
    + _union(
        [
            _LINE.format("Normal", "p0", "r0", "f0", "s0"),
            _LINE.format("Anomaly", "p1", "r1", "f1", "s1"),
            _LINE.format("accuracy", "acc", "acc", "acc", "s0 + s1"),
            _LINE.format("macro avg", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1) / 2", "s0 + s1"),
            _LINE.format(
                "weighted avg", *[f"({m}0 * s0 + {m}1 * s1) / (s0 + s1)" for m in "prf"], "s0 + s1"
            ),
        ]
    ),
)
def report(spark, d):
    out = ev.classification_report(scored(spark, d), "truth", "prediction")
    return out.select("label", r6("precision"), r6("recall"), r6("f1_score"), "support")


@query("binary_scores", _COUNTS + "SELECT round(p1, 6) AS precision, round(r1, 6) AS recall, round(f1, 6) AS f1_score FROM f")
def binary(spark, d):
    out = ev.binary_scores(scored(spark, d), "truth", "prediction")
    return out.select(r6("precision"), r6("recall"), r6("f1_score"))


@query("accuracy", _COUNTS + "SELECT round(acc, 6) AS accuracy FROM f")
def accuracy(spark, d):
    return ev.accuracy(scored(spark, d), "truth", "prediction").select(r6("accuracy"))


@query(
    "label_quality_report",
    """SELECT round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM labels""",
)
def label_accuracy(spark, d):
    return ev.accuracy(table(spark, d, "labels"), "quality", "toxic").select(r6("accuracy"))


@query(
    "corr_pairs_wide",
    """WITH v AS (SELECT vec_id, unnest(range(len(embedding))) AS i, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings),
    w AS (SELECT * FROM v WHERE (vec_id + i) % 17 <> 0)
    SELECT 'x' || a.i AS column_a, 'x' || b.i AS column_b, count(*) AS n, round(corr(a.x, b.x), 6) AS r
    FROM w a JOIN w b USING (vec_id) WHERE a.i <> b.i GROUP BY 1, 2""",
)
def corr_pairs_wide(spark, d):
    """Every pair of 64 columns with gaps, by matrix products."""
    v, names = vectors(spark, d)
    gaps = [F.when((F.col("vec_id") + i) % 17 != 0, F.col(c)).alias(c) for i, c in enumerate(names)]
    return gram.corr_pairs(v.select(*gaps), names).select("column_a", "column_b", "n", r6("r"))
