import datetime
import random

import pytest
from pyspark.sql import functions as F

from sensorloom.session import scratch_path
from sensorloom.streaming import percentiles as pc

DAY = datetime.datetime(2024, 1, 1)
SCHEMA = "series string, ts timestamp, x double"


def readings(n=6000, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x = None if i % 40 == 3 else float("nan") if i % 41 == 3 else rnd.lognormvariate(0, 2) * (1 + i // 2000)
        rows.append((None if i % 7 == 0 else "hot" if i % 3 else "s", DAY + datetime.timedelta(minutes=i), x))
    return rows


def stored(spark, rows, parts, seed=0, repeat=None):
    """The rows in random batches; one of them twice."""
    path = scratch_path(spark, "sketches")
    run = pc.sketch_batches(path, "ts", "x", "1 day", ["series"])
    mixed = random.Random(seed).sample(rows, len(rows))
    for k in range(parts):
        for _ in range(2 if k == repeat else 1):
            run(spark.createDataFrame(mixed[k::parts], SCHEMA).repartition(3), k)
    return path


def exact(rows):
    groups = {}
    for s, t, x in rows:
        if x is not None and x == x:
            groups.setdefault((s, t.replace(hour=0, minute=0)), []).append(x)
    return {k: sorted(v) for k, v in groups.items()}


@pytest.mark.parametrize("parts", [1, 6])
def test_ranks_are_within_the_bound(spark, parts):
    """However the rows fall into batches, late ones and a repeated batch among them; then all batches merged."""
    rows = readings()
    path = stored(spark, rows, parts, parts, repeat=0)
    want = exact(rows)
    for merged in (False, True):
        if merged:
            pc.merge_batches(spark, path, ["series"])
            assert pc.stored_sketches(spark, path).select("batch_id").distinct().count() == min(parts, 2)
        got = pc.percentiles(pc.stored_sketches(spark, path), ["series", "window_start"], [0.0, 0.25, 0.5, 0.999, 1.0]).collect()
        assert len(got) == len(want)
        for r in got:
            values = want[r.series, r.window_start]
            assert (r.n_rows, r.min_value, r.max_value, r.p0, r.p100) == (len(values), values[0], values[-1], values[0], values[-1])
            for share, q in ((0.25, r.p25), (0.5, r.p50), (0.999, r.p99_9)):
                below = sum(v < q for v in values) / len(values)
                upto = sum(v <= q for v in values) / len(values)
                assert below - 3 * pc.rank_error() <= share <= upto + 3 * pc.rank_error()


def test_several_windows_together(spark):
    rows = readings()
    path = stored(spark, rows, 3)
    values = sorted(x for _, _, x in rows if x is not None and x == x)
    r = pc.percentiles(pc.stored_sketches(spark, path), [], [0.5], ["median"]).first()
    assert r.n_rows == len(values)
    assert abs(sum(v <= r.median for v in values) / len(values) - 0.5) < 3 * pc.rank_error()


def test_no_readings(spark):
    path = scratch_path(spark, "sketches")
    run = pc.sketch_batches(path, "ts", "x", "1 day", ["series"])
    run(spark.createDataFrame([("a", None, 1.0), ("a", DAY, None)], SCHEMA), 0)
    assert pc.percentiles(pc.stored_sketches(spark, path), ["window_start"], [0.5]).count() == 0
    run(spark.createDataFrame([("a", DAY, 2.0)], SCHEMA), 1)
    r = pc.percentiles(pc.stored_sketches(spark, path).withColumn("one", F.lit(1)), ["one"], [0.5]).first()
    assert (r.n_rows, r.p50) == (1, 2.0)
