"""Detectors against plain loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.operators.detect import bands, clusters, cumulative, drift, forest, neighbours
from sensorloom.operators.ordered import with_rank
from sensorloom.session import scratch_path

S, O = ["series"], ["ts", "id"]


def by_series(df):
    out = {}
    for r in df.orderBy("ts", "id").collect():
        out.setdefault(r["series"], []).append((r["id"], r["x"]))
    return out


def missing(x):
    return x is None or math.isnan(x)


def same(got, want, places=9):
    assert got.keys() == want.keys()
    for k, v in want.items():
        g = got[k]
        if v is None:
            assert g is None, k
        else:
            assert g == pytest.approx(v, abs=10**-places), k


@pytest.mark.parametrize("chunk", [2, 50, None])
def test_cusum(skewed, chunk):
    want_up, want_down, alarms = {}, {}, {}
    for rows in by_series(skewed).values():
        up = down = 0.0
        for i, x in rows:
            if missing(x):
                want_up[i] = want_down[i] = None
                alarms[i] = 0
                continue
            z = (x - 10) / 3
            up, down = max(0, up + z - 0.5), max(0, down - z - 0.5)
            want_up[i], want_down[i], alarms[i] = up, down, int(max(up, down) > 5)
    got = cumulative.cusum(skewed, S, O, "x", 10, 3, chunk_rows=chunk).collect()
    same({r["id"]: r["cusum_pos"] for r in got}, want_up)
    same({r["id"]: r["cusum_neg"] for r in got}, want_down)
    assert {r["id"]: r["alarm"] for r in got} == alarms
    assert sum(alarms.values()) > 0


@pytest.mark.parametrize("alpha", [0.2, 0.9, 1.0, 0.003])
@pytest.mark.parametrize("chunk", [2, 50, None])
def test_ewma(skewed, alpha, chunk):
    want = {}
    for rows in by_series(skewed).values():
        e = None
        for i, x in rows:
            if missing(x):
                want[i] = None
                continue
            e = x if e is None else alpha * x + (1 - alpha) * e
            want[i] = e
    got = cumulative.ewma(skewed, S, O, "x", alpha, chunk_rows=chunk)
    assert got.columns == [*skewed.columns, "ewma"]
    same({r["id"]: r["ewma"] for r in got.collect()}, want)


def test_ewma_cells(spark):
    """A series much longer than a cell: alpha 0.9 keeps cells under 100 rows."""
    rng = np.random.default_rng(1)
    xs = [float(v) for v in rng.normal(0, 1, 2000)]
    df = spark.createDataFrame([(i, "a", i, x) for i, x in enumerate(xs)], "id long, series string, ts long, x double")
    want, e = {}, None
    for i, x in enumerate(xs):
        e = x if e is None else 0.9 * x + 0.1 * e
        want[i] = e
    for chunk in (300, None):
        same({r["id"]: r["ewma"] for r in cumulative.ewma(df, S, O, "x", 0.9, chunk_rows=chunk).collect()}, want, 12)


def test_ewma_lag1(spark):
    df = spark.createDataFrame(
        [(0, "a", 0, 10.0), (1, "a", 1, 20.0), (2, "a", 2, None), (3, "a", 3, 5.0)], "id long, series string, ts long, x double"
    )
    got = {r["id"]: r["ewma"] for r in cumulative.ewma_lag1(df, S, O, "x").collect()}
    same(got, {0: 10.0, 1: 0.2 * 20 + 0.8 * 10, 2: None, 3: 5.0})


def test_ksigma(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1), (3.0, 1), (100.0, 0), (None, 0)], "x double, base int")
    stats = bands.ksigma_fit(df, "x", F.col("base") == 1)
    flags = [r["anomaly_flag"] for r in bands.ksigma_flag(df, "x", stats).orderBy("x").collect()]
    assert flags == [0, 0, 0, 0, 1]  # 1 and 3 lie on the band, which is not outside
    assert flags == [r["anomaly_flag"] for r in bands.ksigma_flag(df, "x", (2.0, 1.0)).orderBy("x").collect()]


def test_zscore(spark):
    fixed = {"a": (33.39, 25.84)}
    df = spark.createDataFrame([(33.39 + 25.84 * 3.01,), (33.39 - 25.84 * 3.01,), (33.39,), (None,)], "a double")
    got = bands.zscore_flag(df, fixed).collect()
    assert [r["anomaly_a"] for r in got] == [1, 1, 0, 0]
    assert got[3]["z_a"] is None


def test_adaptive_band(spark):
    df = spark.createDataFrame([(i, "a", i, 1.0 if i != 30 else 50.0) for i in range(40)], "id long, series string, ts long, x double")
    got = bands.adaptive_band_flag(df, S, O, "x").orderBy("id").collect()
    assert got[0]["anomaly"] == 0 and got[0]["rolling_std"] is None
    assert [r["id"] for r in got if r["anomaly"]] == [30]


def loop_adwin(values, **kw):
    w = drift.AdaptiveWindow(**kw)
    return [0 if missing(v) else int(w.add(1, v)) for v in values]


def test_adwin_rows_match_loop(skewed):
    got = {r["id"]: r["drift_detected"] for r in drift.adwin(skewed, S, O, "x", block_rows=1, chunk_rows=50).collect()}
    want = {}
    for rows in by_series(skewed).values():
        want |= dict(zip([i for i, _ in rows], loop_adwin([x for _, x in rows])))
    assert got == want and sum(want.values()) > 0


def test_adwin_window_moments():
    """The window's buckets always sum up the values it still holds."""
    rng = np.random.default_rng(3)
    w = drift.AdaptiveWindow()
    seen = []
    for v in np.concatenate([rng.normal(0, 1, 500), rng.normal(4, 1, 500)]):
        w.add(1, float(v))
        seen.append(float(v))
    buckets = w._oldest_first()
    n = int(sum(b[0] for b in buckets))
    assert n < 700  # the old regime was dropped
    assert sum(b[1] for b in buckets) == pytest.approx(sum(seen[-n:]))
    whole = buckets[0]
    for b in buckets[1:]:
        whole = w._merge(whole, b)
    assert whole[2] == pytest.approx(np.var(seen[-n:]) * n)
    assert max(len(r) for r in w.rows) <= w.max_buckets


def test_adwin_finds_the_shift_and_only_it(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 1, 1000), rng.normal(3, 1, 1000)])
    df = spark.createDataFrame([(i, i, float(v)) for i, v in enumerate(x)], "id long, ts long, x double")
    for block in (1, None):
        hits = [r["id"] for r in drift.adwin(df, [], O, "x", block_rows=block).where("drift_detected = 1").collect()]
        assert hits and min(hits) >= 1000 and min(hits) < 1100
    flat = df.where("id < 1000")
    assert drift.adwin(flat, [], O, "x").where("drift_detected = 1").count() == 0


def test_adwin_does_not_depend_on_batches_or_chunks(skewed, spark):
    """The walk carries its window from batch to batch; every series, missing ones too, has its own."""
    mixed = skewed.withColumn("series", F.when(F.col("series") != "s1", F.col("series")))
    flags = lambda **o: sorted(tuple(r) for r in drift.adwin(mixed, S, O, "x", **o).select("id", "drift_detected").collect())
    for block in (1, 4, None):
        whole = flags(block_rows=block)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
        try:
            assert flags(block_rows=block, chunk_rows=50) == whole
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    # Beside a plain walk of each series in order.
    rows = {}
    for r in mixed.where("x is not null and not isnan(x)").orderBy(*O).collect():
        rows.setdefault(r["series"], []).append(r)
    want = {r["id"] for part in rows.values() for r, hit in zip(part, map(drift.AdaptiveWindow().add, [1.0] * len(part), [r["x"] for r in part])) if hit}
    assert {i for i, hit in flags(block_rows=1) if hit} == want


def test_knn(skewed):
    got = neighbours.knn_score(skewed.withColumn("y", F.col("id") % 17), O, ["x", "y"], 5, 100, chunk_rows=60).collect()
    ranked = with_rank(skewed.where("x is not null and not isnan(x)"), [], O).orderBy("rank").collect()
    want = {}
    for lo in range(0, len(ranked), 100):
        part = ranked[lo : lo + 100]
        means = []
        for a in part:
            d = sorted(math.dist((a["x"], a["id"] % 17), (b["x"], b["id"] % 17)) for b in part if b["id"] != a["id"])
            means.append(sum(d[:5]) / 5)
        want |= {a["id"]: m / max(means) for a, m in zip(part, means)}
    same({r["id"]: r["knn_score"] for r in got}, want)
    assert all(0 < r["knn_score"] <= 1 for r in got)


def test_knn_degenerate(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 1.0), (2, None)], "id long, x double")
    assert [r["knn_score"] for r in neighbours.knn_score(df, ["id"], ["x"]).collect()] == [None, None]
    assert neighbours.knn_score(df.where("id = 0"), ["id"], ["x"]).first()["knn_score"] is None


def test_minmax(spark):
    df = spark.createDataFrame([(0.0, 7.0), (5.0, 7.0), (10.0, 7.0), (None, None)], "a double, b double")
    got = clusters.minmax_scale(df, ["a", "b"]).collect()
    assert [r["a_scaled"] for r in got] == [0.0, 0.5, 1.0, None]
    assert [r["b_scaled"] for r in got] == [None] * 4
    out = clusters.minmax_scale(df, ["a"], df.where("a <= 5")).collect()
    assert out[2]["a_scaled"] == 2.0


def test_nearest_centroid(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (11.0,), (None,)], "x double")
    got = [r["cluster"] for r in clusters.nearest_centroid(df, ["x"], [[0.0], [10.0]]).collect()]
    assert got == [0, 0, 1, None]  # 5 is a tie


def test_kmeans_orientation(spark):
    rows = [(float(i % 5), 0.0) for i in range(50)] + [(100.0, 100.0 + i) for i in range(4)]
    df = spark.createDataFrame(rows, "a double, b double")
    model = clusters.kmeans_fit(df, ["a", "b"])
    out = clusters.kmeans_anomalies(df, model)
    assert out.where("prediction = 1").count() == 4
    path = scratch_path(spark, "model")
    model.write().save(path)
    from pyspark.ml import PipelineModel

    again = clusters.kmeans_anomalies(df, PipelineModel.load(path))
    assert again.exceptAll(out).count() == 0


@pytest.mark.parametrize("trees", [5, 60])
def test_isolation_forest(spark, trees):
    rng = np.random.default_rng(2)
    pts = rng.normal(0, 1, (1500, 2)).tolist() + [[9.0, 9.0], [-8.0, 10.0]]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pts)] + [(5000, None, 1.0)], "id long, a double, b double")
    model = forest.iforest_fit(df, "id", ["a", "b"], trees=trees, sample_rows=200, contamination=0.01)
    scored = forest.iforest_score(df, model)
    rows = {r["id"]: r for r in scored.collect()}
    assert rows[5000]["anomaly_score"] is None and rows[5000]["anomaly"] == 0
    known = {i: r["anomaly_score"] for i, r in rows.items() if i != 5000}
    assert all(0 < s <= 1 for s in known.values())
    assert rows[1500]["anomaly"] == 1 and rows[1501]["anomaly"] == 1
    assert sum(r["anomaly"] for r in rows.values()) <= 20
    path = scratch_path(spark, "forest")
    model.save(path)
    again = forest.iforest_score(df, forest.IsolationForest.load(spark, path))
    assert {r["id"]: r["anomaly_score"] for r in again.collect() if r["id"] != 5000} == known
    roots = model.nodes.where("node = 0").collect()
    assert len(roots) == trees and all(r["size"] == 200 for r in roots)


def test_path_correction():
    assert forest.path_correction(np.array([1, 2])).tolist() == [0.0, 1.0]
    assert float(forest.path_correction(256)) == pytest.approx(10.2448, abs=1e-3)
