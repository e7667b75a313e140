import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import sensorloom.operators.detect.drift_walk as dw
from sensorloom.operators.detect.drift import AdaptiveWindow, adwin


def readings(seed, n=3000):
    """Several drifts, sudden and slow; some seeds with few values or one."""
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, n) + rng.integers(0, 5) * 50
    for _ in range(int(rng.integers(0, 7))):
        x[int(rng.integers(0, n)) :] += rng.normal(0, 3)
    if seed % 4 == 1:
        x += np.linspace(0, 4, n)
    if seed % 7 == 6:
        x = np.round(x)
    if seed % 11 == 8:
        x[:] = 3
    return x


def blocks_of(x, rows):
    parts = [x[a : a + rows] for a in range(0, len(x), rows)]
    return [(len(b), b.sum(), ((b - b.mean()) ** 2).sum()) for b in parts]


def plain(items, **options):
    window = AdaptiveWindow(**options)
    return [i for i, item in enumerate(items) if window.add(*item)], window


@pytest.mark.parametrize("seed", range(30))
def test_walk_is_the_plain_window(seed):
    """Same cuts, same buckets; also when the walk is carried from part to part."""
    x = readings(seed, 50 + 90 * seed)
    rule = dw.Rule(block_rows=[1, 32, 20, 8][seed % 4], max_buckets=[5, 3, 2][seed % 3])
    items = blocks_of(x, rule.block_rows)
    want, window = plain(items, max_buckets=rule.max_buckets)
    shift = float(x.mean())
    centred = dw._centred(*np.array(items, float).T, shift)
    got, after = dw.walk(centred, dw.Window.empty(), 0, rule)
    carried, found, wait = dw.Window.empty(), [], 0
    for a in range(0, len(centred), 97):
        part = centred[a : a + 97]
        cuts, carried = dw.walk(part, carried, wait, rule)
        found += [a + c for c in cuts]
        wait = (wait + len(part)) % rule.every
    assert got == found == want
    buckets = np.array(window._oldest_first())
    for end in (after, carried):
        assert list(end.counts) == [len(r) for r in window.rows][: len(end.counts)]
        assert np.allclose(dw._plain(end, shift), buckets, atol=1e-6)


def test_growth_in_one_step():
    for most in (2, 3, 5):
        counts = ()
        for n in range(1, 400):
            counts = dw.grown(counts, 1, most)
            assert dw.grown((), n, most) == counts and sum(c << i for i, c in enumerate(counts)) == n
            assert dw.grown(dw.grown((), n // 3, most), n - n // 3, most) == counts
    many = dw._grown_many((1, 0, 4), np.arange(0, 300, 7), 5)
    for k, n in enumerate(range(0, 300, 7)):
        assert dw.grown((1, 0, 4), n, 5) == tuple(np.trim_zeros(many[:, k], "b"))


@pytest.fixture(scope="module")
def ten_series():
    """Ten seeds of one series each, one of which holds half of all rows; a null key; gaps and shared times."""
    rows, want = [], {}
    for seed in range(10):
        x = readings(seed, 12_000 if seed == 2 else 1200)
        name = None if seed == 5 else f"s{seed}"
        kept = [v for i, v in enumerate(x) if i % 50 != 7]
        cuts, _ = plain([(1, v, 0.0) for v in kept])
        places = [i for i in range(len(x)) if i % 50 != 7]
        want[name] = [places[c] for c in cuts]
        rows += [(name, i // 3, i, None if i % 50 == 7 else float(v)) for i, v in enumerate(x)]
    random.Random(1).shuffle(rows)
    return rows, want


def flagged(df):
    got = {}
    for r in df.where("drift_detected = 1").select("series", "id").collect():
        got.setdefault(r.series, []).append(r.id)
    return {k: sorted(v) for k, v in got.items()}


@pytest.mark.parametrize("chunk", [None, 300])
def test_same_flags_in_chunks(spark, ten_series, chunk):
    """Ten seeds: the flags of one task, whether a series is one chunk or a hundred that are walked at once."""
    rows, want = ten_series
    df = spark.createDataFrame(rows, "series string, t long, id long, x double").repartition(5)
    out = adwin(df, ["series"], ["t", "id"], "x", block_rows=1, chunk_blocks=chunk)
    assert out.count() == len(rows)
    assert flagged(out) == {k: v for k, v in want.items() if v}


def test_blocks_and_rounds(spark, ten_series, monkeypatch):
    """Blocks of a clock step; chunks that do not settle in time are walked in order; windows pass in parts."""
    rows, _ = ten_series
    df = spark.createDataFrame(rows, "series string, t long, id long, x double").repartition(5)
    whole = flagged(adwin(df, ["series"], ["t", "id"], "x"))
    assert sum(map(len, whole.values())) > 10
    turns, walked = [], dw._walk_rows

    def counted(rows, rule, turn, in_order=False):
        turns.append((turn, in_order))
        return walked(rows, rule, turn, in_order)

    monkeypatch.setattr(dw, "_walk_rows", counted)
    monkeypatch.setattr(dw, "PART", 7)
    assert flagged(adwin(df, ["series"], ["t", "id"], "x", chunk_blocks=8)) == whole
    assert not any(in_order for _, in_order in turns) and max(t for t, _ in turns) > 1
    turns.clear()
    items = dw.walk_series
    monkeypatch.setattr("sensorloom.operators.detect.drift.walk_series", lambda *a, **k: items(*a, **k, most_rounds=1))
    assert flagged(adwin(df, ["series"], ["t", "id"], "x", chunk_blocks=8)) == whole
    assert any(in_order for _, in_order in turns)


def test_no_drift_takes_one_round(spark, monkeypatch):
    """A series without drift: every chunk's first guess of the window before it is right."""
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(rng.normal(5, 1, 6000))], "id long, x double")
    turns, walked = [], dw._walk_rows
    monkeypatch.setattr(dw, "_walk_rows", lambda rows, rule, turn, in_order=False: (turns.append(turn), walked(rows, rule, turn, in_order))[1])
    out = adwin(df, [], ["id"], "x", block_rows=1, chunk_blocks=200)
    assert out.where("drift_detected = 1").count() == 0 and turns == [0, 1]


def test_windows_go_on(spark):
    """Walked in three parts with the windows carried, as a stream does."""
    x = readings(4, 2500)
    want, window = plain([(1, v, 0.0) for v in x])
    state, found = None, []
    for a, b in ((0, 700), (700, 1500), (1500, 2500)):
        items = spark.createDataFrame([("s", i, 1.0, float(v), 0.0) for i, v in enumerate(x[a:b])], "series string, item long, n double, total double, m2 double")
        cuts, after = dw.walk_series(items, ["series"], dw.Rule(), state, chunk_items=150)
        found += [a + r.item for r in cuts.collect()]
        state = spark.createDataFrame(after.collect(), after.schema)
    assert sorted(found) == want
    assert np.allclose(np.array(state.first().buckets).reshape(-1, 3), np.array(window._oldest_first()), atol=1e-6)


def test_empty(spark):
    df = spark.createDataFrame([], "series string, id long, x double")
    assert adwin(df, ["series"], ["id"], "x").count() == 0
    only = spark.createDataFrame([("a", 1, None), ("a", 2, float("nan"))], "series string, id long, x double")
    assert [r.drift_detected for r in adwin(only, ["series"], ["id"], "x").collect()] == [0, 0]
    assert adwin(only.withColumn("x", F.lit(1.0)), [], ["id"], "x").count() == 2


def test_sums_stay_off_the_driver(spark, monkeypatch):
    """Windows that begin inside earlier chunks: the sums at their boundaries are not collected, and the cuts are those of one walk."""
    x = readings(4, 2500)
    want, _ = plain([(1, v, 0.0) for v in x])
    items = spark.createDataFrame([("s", i, 1.0, float(v), 0.0) for i, v in enumerate(x)], "series string, item long, n double, total double, m2 double")
    kind, collected = type(items), []
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: (collected.append(df.columns), collect(df))[1])
    cuts, _ = dw.walk_series(items, ["series"], dw.Rule(), chunk_items=150)
    assert collected and not any("sums" in c or "buckets" in c for c in collected)
    assert sorted(r.item for r in cuts.collect()) == want
