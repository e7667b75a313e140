"""Parsing, time columns and row quality on edge rows."""

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from sensorloom.functions import parsing as p
from sensorloom.functions import timefn as t
from sensorloom.operators import aggregate as a
from sensorloom.operators import profile as pr
from sensorloom.operators import quality as q
from sensorloom.operators import series as s
from sensorloom.sinks.tables import to_json_messages

SENSOR = (
    "timestamp string, P1_FCV01D double, P1_FCV01Z double, P1_FCV03D double, x1003_24_SUM_OUT double, "
    "data_type string, attack_label int"
)


def col(df, c):
    return [r[c] for r in df.collect()]


def test_message_round_trip(spark):
    df = spark.createDataFrame(
        [("2022.08.04 18:00", -3.5, 1.2e-05, None, 4.0, "train", None)], SENSOR
    )
    messages = to_json_messages(df)
    assert dict(messages.dtypes) == {"value": "binary"}
    assert p.parse_message(messages, SENSOR).collect() == df.collect()


def test_parse_message_edges(spark):
    texts = ['{"P1_FCV01D": NaN, "data_type": "test"}', "not json", "", '{"P1_FCV03D": 2, "x1003_24_SUM_OUT": 9}']
    raw = spark.createDataFrame([(x.encode(),) for x in texts], "value binary")
    got = p.parse_message(raw, SENSOR, corrupt="bad").collect()
    assert math.isnan(got[0]["P1_FCV01D"]) and got[0]["data_type"] == "test"
    assert got[1]["bad"] == "not json" and got[1]["data_type"] is None
    assert got[3]["P1_FCV03D"] == 2 and got[3]["x1003_24_SUM_OUT"] == 9  # each sensor keeps its own value


def test_legacy_regex(spark):
    msg = json.dumps({"a": -3.5, "b": 1.2e-05, "c": 7.25, "n": 12, "s": "x y"})
    df = spark.createDataFrame([(msg,)], "raw string")
    r = df.select(
        *[p.legacy_regex_extract("raw", k).alias(k) for k in "abcz"],
        p.legacy_regex_extract("raw", "n", "digits").alias("n"),
        p.legacy_regex_extract("raw", "s", "string").alias("s"),
    ).first()
    assert (r.a, r.b, r.c, r.z, r.n, r.s) == (None, "1.2", "7.25", None, "12", "x y")


def test_tolerant_numbers(spark):
    df = spark.createDataFrame([("1.5",), ("",), ("abc",), ("-3e2",), (None,)], "v string")
    assert col(df.select(p.number("v").alias("n")), "n") == [1.5, None, None, -300.0, None]


def test_parse_ts(spark):
    df = spark.createDataFrame([("2022.08.04 18:05",), (" ",), ("x",), (None,)], "v string")
    assert col(df.select(t.parse_ts("v").alias("n")), "n") == [dt.datetime(2022, 8, 4, 18, 5), None, None, None]


def test_coerce_time(spark):
    df = spark.createDataFrame([(1.5, 10, "2020-12-12T01:00:00+01:00"), (-0.25, 0, "nope")], "a double, b long, c string")
    got = df.select(*[t.coerce_time(df, c).alias(c) for c in "abc"]).collect()
    assert got[0]["a"].microsecond == 500000 and got[0]["b"].second == 10
    assert got[0]["c"] == dt.datetime(2020, 12, 12) and got[1]["c"] is None
    assert got[1]["a"].microsecond == 750000
    with pytest.raises(TypeError):
        t.coerce_time(spark.createDataFrame([(True,)], "x boolean"), "x")


def test_buckets(spark):
    df = spark.createDataFrame([(-5,), (0,), (19,)], "s long").select(F.timestamp_seconds("s").alias("ts"))
    assert col(df.select(t.epoch_bucket("ts", 10).alias("b")), "b") == [-10, 0, 10]
    assert col(df.select(t.epoch_bucket("ts", 10, truncate=True).alias("b")), "b") == [0, 0, 10]


def test_ranges(spark):
    df = spark.createDataFrame([(x,) for x in (0, 1, 2, 3)], "s long").withColumn("ts", F.timestamp_seconds("s"))
    assert col(t.time_range(df, "ts", "1970-01-01 00:00:01", "1970-01-01 00:00:02"), "s") == [1, 2]
    assert col(t.dashboard_range(df, "ts", 1000, 2000), "s") == [1]
    assert col(t.dashboard_range(df, "s", 1000, 3000), "s") == [1, 2]


def test_auto_interval():
    assert t.auto_interval(0, 3_600_000, 100) == 60
    assert t.auto_interval(0, 1000, 100) == 1
    assert t.auto_interval(0, 10**14, 10) % 31536000 == 0


@pytest.fixture(scope="module")
def edges(spark):
    nan = float("nan")
    rows = [
        (1, None, None), (2, 0.0, 0.0), (3, None, 0.0), (4, nan, None), (5, -3.5, 0.0), (6, 1.2e-05, None), (7, 1.0, 2.0),
    ]
    return spark.createDataFrame(rows, "id int, a double, b double")


def test_row_filters(edges):
    ids = lambda df: col(df, "id")
    assert ids(q.drop_blank_or_zero(edges, ["a", "b"])) == [4, 5, 6, 7]
    assert ids(q.drop_all_null(edges, ["a", "b"])) == [2, 3, 5, 6, 7]
    assert ids(q.drop_incomplete(edges, ["a", "b"])) == [2, 5, 7]


def test_missing_counts(edges):
    got = {r["column_name"]: r["missing"] for r in q.missing_counts(edges).collect()}
    assert got == {"id": 0, "a": 3, "b": 3}


def test_require_fields(spark):
    df = spark.createDataFrame([(1, "train"), (2, None), (3, " "), (None, "test")], "n int, data_type string")
    good, bad = q.require_fields(df, ["data_type", "n"])
    assert col(good, "n") == [1]
    assert [r["missing_fields"] for r in bad.collect()] == [["data_type"], ["data_type"], ["n"]]


def test_columns_by_prefix(spark):
    df = spark.createDataFrame([], "ts int, P1_a int, P1_b int, P2_a int, x int")
    assert q.columns_by_prefix(df, ["P1", "P2"], ["ts"], first=1).columns == ["ts", "P1_a", "P2_a"]
    assert q.group_columns(df, ["P1", "x"]) == {"P1": ["P1_a", "P1_b"], "x": ["x"]}


def test_table_query_is_top_k(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 2)
    out = q.table_query(df, {"g": 1}, [F.desc("id")], 3)
    assert col(out, "id") == [99, 97, 95]
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


def test_describe(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 5), (4.0, 5), (float("nan"), None)], "a double, b int")
    rows = {r["column_name"]: r for r in pr.describe(df).collect()}
    a = rows["a"]
    assert (a["n"], a["min"], a["p25"], a["p50"], a["p75"], a["max"]) == (3, 1.0, 1.5, 2.0, 3.0, 4.0)
    assert rows["b"]["std"] == 0 and rows["b"]["p75"] == 5
    rough = {r["column_name"]: r for r in pr.describe(df, approximate=True).collect()}
    assert rough["a"]["p50"] == 2.0


def test_describe_empty_and_single(spark):
    df = spark.createDataFrame([], "a double")
    r = pr.describe(df).first()
    assert r["n"] == 0 and r["p50"] is None and r["mean"] is None
    one = spark.createDataFrame([(3.0,)], "a double")
    r = pr.describe(one).first()
    assert (r["p25"], r["p75"], r["std"]) == (3.0, 3.0, None)


@pytest.mark.parametrize("sketch", [4, 2000])
def test_exact_percentiles(spark, monkeypatch, sketch):
    """Exact whatever the sketch proposes, with heavy ties and a wide spread of values."""
    import numpy as np

    monkeypatch.setattr(pr, "_SKETCH", sketch)
    rng = np.random.default_rng(0)
    x = np.concatenate([np.full(400, 2.5), rng.lognormal(0, 8, 800), -rng.lognormal(0, 8, 300)])
    df = spark.createDataFrame([(float(v), float(i % 7)) for i, v in enumerate(x)], "a double, b double")
    got = {(r[0], r[1]): r[2] for r in pr.exact_percentiles(df, ["a", "b"], [0, 0.01, 0.5, 0.9, 1], 50).collect()}
    for c, values in (("a", x), ("b", np.arange(len(x)) % 7.0)):
        for f in (0, 0.01, 0.5, 0.9, 1):
            assert got[(c, f)] == pytest.approx(np.quantile(values, f), rel=1e-9)


def test_corr_and_histogram(spark):
    df = spark.createDataFrame([(float(i), float(-i), 1.0) for i in range(10)], "a double, b double, c double")
    r = {(x["column_a"], x["column_b"]): x["r"] for x in pr.pairwise_corr(df, ["a", "b", "c"]).collect()}
    assert len(r) == 6 and r[("a", "b")] == pytest.approx(-1) and r[("b", "a")] == pytest.approx(-1)
    assert r[("a", "c")] is None
    gaps = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (9.0, None), (None, 9.0)], "a double, b double")
    assert pr.corr_with_target(gaps, ["a", "b"], "b").first()["r"] == pytest.approx(-1)
    h = {x["bucket"]: x["n_rows"] for x in pr.histogram(df, "a", 3).collect()}
    assert h == {0: 3, 1: 3, 2: 4}
    assert [tuple(x) for x in pr.histogram(df, "c", 3).collect()] == [(0, 1.0, 10)]


def test_gap_fill(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 50, 2.0), ("b", 20, 3.0)], "k string, s long, v double")
    df = df.select("k", F.timestamp_seconds("s").alias("ts"), "v")
    out = s.gap_fill(df, "ts", 10, ["k"]).orderBy("k", "ts").collect()
    assert [(r["k"], r["ts"].second, r["v"]) for r in out] == [
        ("a", 0, 1.0), ("a", 10, None), ("a", 20, None), ("a", 30, None), ("a", 40, None), ("a", 50, 2.0), ("b", 20, 3.0),
    ]
    assert s.gap_fill(df, "ts", 10, ["k"], {"v": 0.0}).where("v = 0").count() == 4


def test_gap_fill_long_span(spark):
    """More buckets than one span holds, and a series without name."""
    df = spark.createDataFrame([(None, 0), (None, 1_000_000)], "k string, s long").select("k", F.timestamp_seconds("s").alias("ts"), F.lit(1).alias("n"))
    out = s.gap_fill(df, "ts", 100, ["k"])
    assert out.count() == 10_001 and out.where("n = 1").count() == 2


def test_option_list(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "__text string, __value int")
    assert sorted(map(tuple, s.option_list(df).collect())) == [("a", "1"), ("b", "2")]
    assert s.option_list(df.select("__text")).count() == 2
    with pytest.raises(ValueError):
        s.option_list(df.toDF("x", "y"))
    with pytest.raises(ValueError):
        s.option_list(df.withColumn("z", F.lit(1)))


def test_wide_long(spark):
    df = spark.createDataFrame([(1, "x", 2.0), (1, "y", 3.0), (2, "x", 4.0)], "t int, m string, v double")
    wide = s.long_to_wide(df, "t", "m", "v", ["x", "y"])
    assert sorted(map(tuple, wide.collect())) == [(1, 2.0, 3.0), (2, 4.0, None)]
    back = s.wide_to_long(wide, ["t"], ["x", "y"], "m", "v").where("v is not null")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_windows(spark):
    df = spark.createDataFrame([(0, 1.0), (59, 3.0), (60, None)], "s long, v double").withColumn("ts", F.timestamp_seconds("s"))
    rows = a.window_as_text(a.tumbling_mean(df, "ts", ["v"])).orderBy("window_start").collect()
    assert [tuple(r) for r in rows] == [("1970-01-01 00:00:00", 2.0, 2), ("1970-01-01 00:01:00", None, 1)]
    f = a.window_features(df, "ts", ["v"]).orderBy("window_start").collect()
    assert f[0]["stddev_v"] == pytest.approx(2**0.5) and f[1]["stddev_v"] is None
