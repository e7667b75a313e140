"""Log text and exploration on small lines."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.functions import logtext as lt
from sensorloom.operators import logs as lg


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "v string").select(expr("v").alias("r")).first()["r"]


def test_levels(spark):
    names = ["CRIT", "eror", "err", "Warn", "info ", "other", None]
    df = spark.createDataFrame([(n,) for n in names], "v string")
    got = [r["r"] for r in df.select(lt.normalise_level("v").alias("r")).collect()]
    assert got == ["critical", "error", "error", "warning", "info", "unknown", "unknown"]


@pytest.mark.parametrize(
    "text,want", [("1.5KB", 1500.0), ("2 MiB", 2 * 2**20), ("7b", 7.0), ("KB", None), ("5 ms", None), ("", None)]
)
def test_bytes(spark, text, want):
    assert one(spark, text, lt.bytes_number) == want


@pytest.mark.parametrize(
    "text,want", [("1h2m3.5s", 3723.5), ("250ms", 0.25), ("-2s", -2.0), ("3", None), ("5x", None), (None, None)]
)
def test_duration(spark, text, want):
    got = one(spark, text, lt.duration_seconds)
    assert got == (want if want is None else pytest.approx(want))


def test_field_type(spark):
    got = [one(spark, x, lt.field_type) for x in ("1e3", "3KB", "4ms", "abc", "")]
    assert got == ["float", "bytes", "duration", "string", "string"]


def test_parse(spark):
    lines = ['a=1 b="x \\"y\\" z" a=2', '{"k": 5, "n": null}', "plain text", '{"broken', None, ""]
    df = lg.parse_line(spark.createDataFrame([(x,) for x in lines], "line string"))
    got = [r["fields"] for r in df.collect()]
    assert got[0] == {"a": "2", "b": 'x \\"y\\" z'}
    assert got[1] == {"k": "5", "n": None}
    assert got[2:] == [{}, {}, {}, {}]


def test_field_filter(spark):
    rows = [(1, {"d": "250ms", "n": "5"}), (2, {"d": "2s", "n": "x"}), (3, {}), (4, {"n": ""})]
    df = spark.createDataFrame(rows, "id int, fields map<string,string>")
    ids = lambda *a, **k: [r["id"] for r in lg.field_filter(df, *a, **k).collect()]
    assert ids("n", "=", ["5", "x"]) == [1, 2]
    assert ids("n", "!=", "5") == [2, 3, 4]
    assert ids("n", "empty") == [3, 4] and ids("n", "non-empty") == [1, 2]
    assert ids("d", ">", "1s", "duration") == [2] and ids("n", "<=", 5) == [1]
    with pytest.raises(ValueError):
        ids("n", "~", 1)


def test_label_filter(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "l string, n int")
    keep = lambda **k: [r["n"] for r in lg.label_filter(df, **k).collect()]
    assert keep() == [1, 2, 3]
    assert keep(equal={"l": ["a", "b"]}, not_equal={"n": [2]}) == [1]
    assert keep(not_equal={"l": ["a"]}) == [2, 3]


def test_line_contains_is_literal(spark):
    df = spark.createDataFrame([("a.b(c",), ("aXb(c",), ("A.B(C",)], "line string")
    assert lg.line_contains(df, "a.b(").count() == 1
    assert lg.line_contains(df, "a.b(", case_sensitive=False).count() == 2


def test_templates(spark):
    line = 'user=17 id=0x1F took 3.25ms msg="x y" hash deadbeef01 at 10.0.0.1:80'
    assert one(spark, line, lt.message_template) == 'user=<_> id=<_> took <_>ms msg=<_> hash <_> at <_>'
    assert one(spark, "the facade effaced", lt.message_template) == "the facade effaced"


def test_pattern_filter_and_fields(spark):
    df = spark.createDataFrame([("a 1 b 2",), ("a 3 b 2",), ("c (x)",), ("a 1\nb 2",)], "line string")
    assert lg.pattern_filter(df, ["a <_> b <_>"]).count() == 2
    assert lg.pattern_filter(df, ["a <_>", "c (<_>)"], ["a 3<_>"]).count() == 3
    assert lg.pattern_filter(df).count() == 4
    got = sorted(map(tuple, lg.pattern_fields(df, "a <_> b <_>").collect()))
    assert got == [("field_1", "1", 1), ("field_1", "3", 1), ("field_2", "2", 2)]


def test_detected(spark):
    lines = ["n=1 d=5ms", "n=2 d=6ms", "n=x d=7ms", '{"n": 3}']
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = {r["field"]: (r["cardinality"], r["parser"], r["field_type"]) for r in lg.detected_fields(df, exact=True).collect()}
    assert got == {"n": (4, "json, logfmt", "string"), "d": (3, "logfmt", "duration")}
    labels = spark.createDataFrame([("a", 1, "z"), ("b", 2, "z"), ("b", 3, "z")], "x string, y int, one string")
    assert [r["label"] for r in lg.detected_labels(labels, ["one", "y", "x"], exact=True).collect()] == ["x", "y", "one"]


def test_sort_series(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 9.0), ("b", 1, 5.0), ("b", 2, 5.0)], "s string, bucket int, v double")
    order = lambda by, **k: [r["s"] for r in lg.sort_series(df, "s", "v", by, **k).collect()]
    assert order("stddev") == ["a", "b"] and order("sum") == ["a", "b"]
    assert order("min") == ["b", "a"] and order("max", descending=False) == ["b", "a"]
    assert order("name") == ["b", "a"] and order("name", descending=False) == ["a", "b"]
    assert order("p50") == ["b", "a"]
    assert set(order("changepoint")) == set(order("outliers")) == {"a", "b"}


def test_changepoints(spark):
    rng = np.random.default_rng(4)
    step = np.concatenate([rng.normal(0, 0.3, 60), rng.normal(6, 0.3, 60)])
    rows = [("step", i, float(v)) for i, v in enumerate(step)] + [("flat", i, 2.0) for i in range(120)]
    df = spark.createDataFrame(rows, "s string, t int, v double")
    got = {r["s"]: r["changepoints"] for r in lg.changepoint_count(df, "s", "t", "v").collect()}
    assert got["flat"] == 0 and got["step"] >= 1
    assert lg.run_length_changes(step[:60]) < lg.run_length_changes(step) + 1


def test_thinning_bounds_a_series(spark):
    df = spark.range(1000).select(F.lit("a").alias("s"), F.col("id").alias("t"), F.col("id").alias("v"))
    got = [r["t"] for r in lg.thin_points(df, "s", "t", "v").collect()]
    assert len(got) == 150 and 0 in got
    # The first row of every bin of equal count.
    assert sorted(got) == [min(t for t in range(1000) if t * 150 // 1000 == b) for b in range(150)]
    assert lg.thin_points(df.where("t < 50"), "s", "t", "v").count() == 50


@pytest.mark.parametrize("chunk", [3, None])
def test_outlier_series(spark, chunk):
    rows = [(f"s{k}", t, 10.0 + k * 0.1) for k in range(5) for t in range(8)]
    rows += [("odd", t, 50.0 if t in (2, 3, 6) else 10.0) for t in range(8)]
    df = spark.createDataFrame(rows, "s string, t int, v double")
    got = {r["s"]: (r["outlier_intervals"], r["outlier_steps"]) for r in lg.outlier_series(df, "s", "t", "v", chunk_rows=chunk).collect()}
    assert got.pop("odd") == (2, 3)
    assert set(got.values()) == {(0, 0)}


def test_presence(spark):
    df = spark.createDataFrame([({"a": "1"},), ({"a": ""},), ({},), ({"a": "x"},)], "fields map<string,string>")
    r = lg.field_presence(df, "a").first()
    assert (r["percent"], r["n_lines"]) == (50.0, 4)
    assert lg.field_presence(df, "a", sample_rows=2).first()["n_lines"] == 2


def test_volume_by_keeps_every_label(spark):
    df = spark.range(6000).select(F.col("id").cast("string").alias("label"), F.lit("x").alias("line"))
    assert lg.volume_by(df, "label").count() == 6000 and lg.volume_by(df, "label", limit=5).count() == 5


def test_typed_fields_of_odd_lines(spark):
    """Odd names, nested arrays, numbers of several types, text that is no JSON; no JSON at all; many paths."""
    lines = [
        '{"user": {"id": 1, "o.dd": 1}, "ok": true, "x": 1.5, "tags": ["a", "b"], "code": 1, "OBJECT": 1}',
        ' {"user": {"id": 2}, "code": "z", "n": null, "x": 2}',
        "bad", "[1, 2]", '{"broken": ', None, "", "{}",
        '{"a b": {"c`d": [{"e": 1}], "it\'s": "q", "OBJECT<x": 3}}',
    ]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    for exact in (True, False):
        got = {r.path: (r.field_type, r.n_lines, r.cardinality) for r in lg.typed_fields(df, exact=exact).collect()}
        assert got == {
            "$.user.id": ("bigint", 2, 2), "$.user['o.dd']": ("bigint", 1, 1), "$.ok": ("boolean", 1, 1), "$.x": ("decimal", 2, 2),
            "$.tags": ("array<string>", 1, 1), "$.code": ("mixed", 2, 2), "$.n": ("null", 0, 0), "$.OBJECT": ("bigint", 1, 1),
            "$['a b']['c`d']": ("array<object>", 1, 1), "$['a b'][\"it's\"]": ("string", 1, 1), "$['a b']['OBJECT<x']": ("bigint", 1, 1),
        }
    for none in (df.where("line IS NULL"), df.where("line = 'bad'"), df.where("false")):
        assert lg.typed_fields(none).count() == 0
    wide = spark.createDataFrame([("{" + ", ".join(f'"k{i}": {i}' for i in range(250)) + "}",)] * 3, "line string")
    got = lg.typed_fields(wide).collect()
    assert len(got) == 250 and {(r.field_type, r.n_lines, r.cardinality) for r in got} == {("bigint", 3, 1)}
