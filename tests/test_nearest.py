import numpy as np
import pytest
from pyspark.sql import functions as F

import sensorloom.operators.detect.nearest as nn


def brute(x, k):
    """Mean distance to the k nearest other rows, over the largest."""
    square = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(square, np.inf)
    near = min(k, len(x) - 1)
    if near < 1:
        return [None] * len(x)
    mean = np.sqrt(np.sort(square, axis=1)[:, :near]).mean(axis=1)
    return [None] * len(x) if mean.max() == 0 else (mean / mean.max()).tolist()


@pytest.mark.parametrize("seed", range(12))
def test_lists_and_cells(seed):
    """Neighbours by weight, and every cell that a ball reaches, for few and many equal values."""
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(0, 1, (int(rng.integers(1, 300)), int(rng.integers(1, 4)))), int(rng.integers(0, 5)))
    points, weights = np.unique(x, axis=0, return_counts=True)
    k = int(rng.integers(1, 8))
    got = nn._nearest(points, weights, points, np.arange(len(points)), k)
    for p, found in zip(points, got):
        want = np.sort(np.sqrt(((x - p) ** 2).sum(axis=1)))[1 : k + 1]
        assert np.allclose(found[: len(want)], want) and np.isinf(found[len(want) :]).all()
    splits = nn.Splits(points, int(rng.integers(1, 20))).arrays()
    cells, radius = nn.cell_of(splits, points), rng.uniform(0, 1.5, len(points))
    point, cell = nn.cells_within(splits, points, radius)
    pairs = list(zip(point.tolist(), cell.tolist()))
    assert len(set(pairs)) == len(pairs)
    for i, p in enumerate(points):
        reached = ((points - p) ** 2).sum(axis=1) <= radius[i] ** 2
        assert {(i, int(c)) for c in cells[reached]} <= set(pairs)


def test_a_block_of_20000_rows(spark):
    """One group of 20,000 rows, a third of them one point: equal to brute force, in cells of about 500 points."""
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (9000, 3)), rng.normal(40, 0.01, (4000, 3)), np.full((6600, 3), 7.0), rng.uniform(-500, 500, (400, 3))])
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double, c double").repartition(8)
    out = nn.knn_score_whole(df, [], ["a", "b", "c"], 5, cell_points=500)
    got = {r.id: r.knn_score for r in out.collect()}
    means = []
    for a in range(0, len(x), 500):
        square = ((x[a : a + 500, None] - x[None]) ** 2).sum(axis=2)
        square[np.arange(len(square)), np.arange(a, a + len(square))] = np.inf
        means.append(np.sqrt(np.partition(square, 4, axis=1)[:, :5]).mean(axis=1))
    means = np.concatenate(means)
    assert np.allclose([got[i] for i in range(len(x))], means / means.max(), atol=1e-12)
    assert (means == 0).sum() == 6600


def test_groups_of_all_sizes(spark):
    """Groups below and above a cell, of one row, of equal rows, with a NULL key; incomplete rows go; -0 is 0."""
    rng = np.random.default_rng(2)
    groups = {"big": np.round(rng.normal(0, 1, (700, 2)), 1), "mid": rng.normal(0, 1, (30, 2)), "one": np.zeros((1, 2)), "same": np.ones((9, 2)), None: rng.normal(5, 1, (3, 2))}
    groups["mid"][3] = 0.0
    groups["mid"][4] = -0.0
    rows, want = [], {}
    for name, x in groups.items():
        for v, score in zip(x, brute(x, 5)):
            want[len(rows)] = score
            rows.append((len(rows), name, *map(float, v), "kept"))
    gone = [(9000, "big", None, 1.0, "x"), (9001, "one", float("nan"), 1.0, "x")]
    df = spark.createDataFrame([*rows, *gone], "id long, day string, a double, b double, weight string").repartition(5)
    for cell in (2000, 40):
        out = nn.knn_score_whole(df, ["day"], ["a", "b"], 5, cell_points=cell)
        assert out.columns == ["id", "day", "a", "b", "weight", "knn_score"]
        got = {r.id: r.knn_score for r in out.collect()}
        assert got.keys() == want.keys()
        assert all((got[i] is None) == (w is None) and (w is None or got[i] == pytest.approx(w, abs=1e-9)) for i, w in want.items())


def test_cells_with_too_few_points(spark):
    """Cells of two points and ten neighbours: the sample bounds the search."""
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (160, 2))
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double")
    got = {r.id: r.knn_score for r in nn.knn_score_whole(df, [], ["a", "b"], 10, cell_points=2).collect()}
    assert np.allclose([got[i] for i in range(160)], brute(x, 10))


def test_nothing_and_infinity(spark):
    empty = spark.createDataFrame([], "id long, a double")
    assert nn.knn_score_whole(empty, [], ["a"]).count() == 0
    odd = spark.createDataFrame([(1, float("inf")), (2, 1.0)], "id long, a double")
    with pytest.raises(ValueError):
        nn.knn_score_whole(odd, [], ["a"])
    assert [r.knn_score for r in nn.knn_score_whole(odd.where("id = 2").withColumn("a", F.lit(1)), [], ["a"]).collect()] == [None]
