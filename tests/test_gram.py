import numpy as np
import pytest

from sensorloom.operators import gram


def brute(x):
    out = {}
    for a in range(x.shape[1]):
        for b in range(x.shape[1]):
            have = ~np.isnan(x[:, a]) & ~np.isnan(x[:, b])
            if a != b and have.any():
                u, v = x[have, a], x[have, b]
                flat = len(u) < 2 or np.ptp(u) == 0 or np.ptp(v) == 0
                out[f"c{a}", f"c{b}"] = (int(have.sum()), None if flat else float(np.corrcoef(u, v)[0, 1]))
    return out


def same(df, want):
    got = {(r.column_a, r.column_b): (r.n, r.r) for r in df.collect()}
    assert got.keys() == want.keys()
    for k, (n, r) in want.items():
        assert got[k][0] == n and (got[k][1] is None) == (r is None) and (r is None or got[k][1] == pytest.approx(r, abs=1e-9)), k


def test_three_hundred_columns(spark):
    """Pairs of 300 columns with a common part, large means and gaps, to nine digits."""
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (400, 300)) + rng.normal(0, 1, (400, 1)) + rng.uniform(-1e6, 1e6, 300)
    x[rng.random(x.shape) < 0.05] = np.nan
    x[:, 7] = 3.25
    names = [f"c{i}" for i in range(300)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{c} double" for c in names)).repartition(6)
    same(gram.corr_pairs(df, names), brute(x))


def test_odd_tables(spark):
    """NULL, NaN, constant and empty columns, integers, one row, no row; more parts than one."""
    rows = [(1, 2.0, None, 5.0, None), (2, float("nan"), 4.0, 5.0, None), (3, 1.0, 2.0, 5.0, None), (4, 8.0, None, 5.0, None)]
    df = spark.createDataFrame(rows, "c0 int, c1 double, c2 float, c3 double, c4 double").repartition(3)
    x = np.array([[np.nan if v is None else v for v in r] for r in rows])
    names = [f"c{i}" for i in range(5)]
    same(gram.corr_pairs(df, names), brute(x))
    same(gram.corr_pairs(df.where("c0 = 1"), names), brute(x[:1]))
    assert gram.corr_pairs(df.where("false"), names).count() == 0
