"""Chunked scans give what one window per series gives, for any chunk size."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sensorloom.operators import ordered as o
from sensorloom.sinks.tables import assign_batches

S, O = ["series"], ["ts", "id"]
CHUNKS = [1, 3, 40, None]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def window():
    return Window.partitionBy("series").orderBy("ts", "id")


@pytest.mark.parametrize("chunk", CHUNKS)
def test_rank(skewed, chunk):
    want = skewed.select("id", F.row_number().over(window()).cast("long"))
    assert rows(o.with_rank(skewed, S, O, chunk_rows=chunk).select("id", "rank")) == rows(want)


@pytest.mark.parametrize("chunk", [3, 40, None])
def test_rank_of_whole_table(skewed, chunk):
    got = o.with_rank(skewed, [], O, chunk_rows=chunk)
    assert got.columns == [*skewed.columns, "rank"]
    order = [r["id"] for r in skewed.orderBy("ts", "id").collect()]
    assert rows(got.select("id", "rank")) == sorted((i, n + 1) for n, i in enumerate(order))


@pytest.mark.parametrize("chunk", CHUNKS)
def test_running_sum(skewed, chunk):
    want = skewed.select("id", F.sum("id").over(window().rowsBetween(Window.unboundedPreceding, 0)))
    got = o.with_running_sum(skewed, S, O, {"s": F.col("id")}, chunk_rows=chunk)
    assert rows(got.select("id", "s")) == rows(want)


@pytest.mark.parametrize("chunk", CHUNKS)
def test_lookback(skewed, chunk):
    outputs = {
        "a": lambda w: F.lag("id").over(w),
        "b": lambda w: F.sum("id").over(w.rowsBetween(-6, 0)),
    }
    got = o.with_lookback(skewed, S, O, 6, outputs, chunk_rows=chunk)
    want = skewed.select("id", *[f(window()) for f in outputs.values()])
    key = lambda r: r[0]
    assert sorted(map(tuple, got.select("id", "a", "b").collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_null_series_and_equal_times(spark):
    df = spark.createDataFrame(
        [(i, None if i % 2 else "a", None if i < 4 else 5) for i in range(60)], "id long, series string, ts long"
    )
    got = o.with_rank(df, S, O, chunk_rows=2).select("series", "ts", "id", "rank")
    w = Window.partitionBy("series").orderBy("ts", "id")
    want = df.select("series", "ts", "id", F.row_number().over(w).cast("long"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.toDF("series", "ts", "id", "rank").collect()))


def test_empty(spark):
    df = spark.createDataFrame([], "id long, series string, ts long, x double")
    assert o.with_rank(df, S, O).count() == 0
    assert o.rolling_stats(df, S, O, "x").count() == 0


def test_first_and_every_nth(skewed):
    first = o.first_per_series(skewed, S, O, 2)
    assert {r["series"]: r["count"] for r in first.groupBy("series").count().collect()} == {
        "hot": 2, "s0": 2, "s1": 2, "s2": 2,
    }
    for chunk in (25, None):
        thin = o.every_nth(skewed.where("series = 'hot'"), S, O, 100, chunk)
        assert thin.count() == skewed.where("series = 'hot'").count() // 100


@pytest.mark.parametrize("chunk", [30, None])
def test_batches(skewed, chunk):
    sizes = [r["count"] for r in assign_batches(skewed, O, 128, chunk_rows=chunk).groupBy("batch_no").count().orderBy("batch_no").collect()]
    assert sizes == [128] * 7 + [4]


def test_chunks_are_spread(skewed):
    """A series that holds most rows ends up in many chunks, none of them large."""
    c = o.chunked(skewed, S, O, chunk_rows=20)
    sizes = [r["count"] for r in c.df.groupBy(*c.keys).count().collect()]
    assert c.split and len(sizes) > 15 and max(sizes) < 250


def test_group_limit_before_shuffle(skewed):
    plan = o.first_per_series(skewed, S, O, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("name", ["n", "s", "rank_", "total"])
def test_series_may_have_any_name(skewed, name):
    df = skewed.withColumnRenamed("series", name)
    assert o.with_rank(df, [name], O, chunk_rows=40).count() == 900
    assert o.previous_value(df, [name], O, "x", chunk_rows=40).count() == 900


def test_chunks_follow_from_the_place(skewed):
    """Tagging reads a written table: no join, no list of cuts, whatever the number of chunks."""
    for rows in (3, 100):
        c = o.chunked(skewed, ["series"], ["ts", "id"], rows)
        assert c.split
        added = [f for f in c.df.schema if f.name not in skewed.columns]
        assert {f.dataType.simpleString() for f in added} == {"bigint"}
        plan = c.df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan and "aggregate(" not in plan
        sizes = c.df.groupBy(*c.keys).count().collect()
        assert max(r["count"] for r in sizes) <= rows and sum(r["count"] for r in sizes) == skewed.count()


def test_one_layout_serves_several_steps(skewed):
    c = o.chunked(skewed, ["series"], ["ts", "id"], 50)
    one = o.with_rank(c, ["series"], ["ts", "id"])
    two = o.with_rank(skewed, ["series"], ["ts", "id"], chunk_rows=10**6)
    key = lambda df: sorted((r["id"], r["rank"]) for r in df.collect())
    assert key(one) == key(two)
