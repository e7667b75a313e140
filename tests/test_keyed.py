"""Keyed state in the state store: order, restarts, expiry, and the reports of batches."""

import datetime
import json
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from sensorloom.operators.detect import drift
from sensorloom.session import scratch_path
from sensorloom.sinks.tables import assign_batches, read_batches
from sensorloom.sources.tables import stream_files
from sensorloom.streaming import keyed as k
from sensorloom.streaming import runtime as rt

S, O = ["series"], ["ts", "id"]


@pytest.fixture(scope="module")
def ordered(spark, skewed):
    """The readings as three files in time order; the same rows in lists."""
    numbered = assign_batches(skewed, O, 300).persist()
    parts = [numbered.where(F.col("batch_no") == b).drop("batch_no").collect() for b in range(3)]
    numbered.unpersist()
    return parts


def put(spark, folder, rows, schema):
    spark.createDataFrame(random.Random(len(rows)).sample(rows, len(rows)), schema).coalesce(1).write.mode("append").parquet(folder)


def drained(df, out, checkpoint):
    rt.drain(rt.stream_to_table(df, out, checkpoint), 300)
    return read_batches(df.sparkSession, out, df.schema)


def plain_nth(rows, pick):
    seen, out = {}, []
    for r in sorted(rows, key=lambda r: (r.ts, r.id)):
        n = seen[r.series] = seen.get(r.series, 0) + 1
        if pick(n):
            out.append((r.series, r.id, n))
    return sorted(out)


@pytest.mark.parametrize("name", ["first", "nth", "adwin"])
def test_restarts_go_on_with_the_state(spark, skewed, ordered, name):
    """A new query after each file, on the same checkpoint: as if never stopped. Files hold their rows in no order."""
    make = {
        "first": lambda s: k.first_per_key(s, S, O, 40),
        "nth": lambda s: k.every_nth_per_key(s, S, O, 7),
        "adwin": lambda s: k.adwin_per_key(s, S, O, "x"),
    }[name]
    folder, out, ck = (scratch_path(spark, x) for x in ("in", "out", "ck"))
    for part in ordered:
        put(spark, folder, part, skewed.schema)
        got = drained(make(stream_files(spark, folder, skewed.schema, max_files=1)), out, ck)
    rows = [r for part in ordered for r in part]
    if name == "adwin":
        want = sorted((r.id, r.drift_detected) for r in drift.adwin(skewed, S, O, "x", block_rows=1).collect())
        assert sorted((r.id, r.drift_detected) for r in got.collect()) == want
        assert sum(d for _, d in want) > 0
        return
    want = plain_nth(rows, (lambda n: n <= 40) if name == "first" else (lambda n: n % 7 == 0))
    assert sorted((r.series, r.id, r.nth) for r in got.collect()) == want


def test_late_rows_are_put_in_order(spark, skewed, ordered):
    """Rows come in any order within the delay; rows without a time go; what the watermark has not passed waits."""
    rnd = random.Random(3)
    rows = sorted((r for part in ordered for r in part), key=lambda r: (r.ts.timestamp() + rnd.uniform(0, 500), r.id))
    folder = scratch_path(spark, "in")
    for a in range(0, 900, 225):
        put(spark, folder, rows[a : a + 225], skewed.schema)
    put(spark, folder, [(5000, "hot", None, 1.0)], skewed.schema)
    s = k.every_nth_per_key(stream_files(spark, folder, skewed.schema, max_files=1), S, O, 5, "10 minutes")
    got = drained(s, scratch_path(spark, "out"), scratch_path(spark, "ck"))
    newest = max(r.ts for r in rows)
    passed = [r for r in rows if (newest - r.ts).total_seconds() >= 600]
    assert 200 < len(passed) < 900
    assert sorted((r.series, r.id, r.nth) for r in got.collect()) == plain_nth(passed, lambda n: n % 5 == 0)


def test_no_series_and_null_keys(spark):
    schema = "series string, ts timestamp, id long"
    rows = [(None if i % 3 else "a", None if i == 4 else datetime.datetime(2024, 1, 1, 0, i), i) for i in range(12)]
    folder = scratch_path(spark, "in")
    put(spark, folder, rows, schema)
    source = lambda: stream_files(spark, folder, spark.createDataFrame([], schema).schema)
    one = drained(k.first_per_key(source(), [], O, 3), scratch_path(spark, "out"), scratch_path(spark, "ck"))
    assert one.columns == ["series", "ts", "id", "nth"]
    assert sorted((r.id, r.nth) for r in one.collect()) == [(0, 2), (1, 3), (4, 1)]  # a missing time comes first
    two = drained(k.first_per_key(source(), S, O, 2), scratch_path(spark, "out"), scratch_path(spark, "ck"))
    assert sorted((str(r.series), r.id) for r in two.collect()) == [("None", 1), ("None", 4), ("a", 0), ("a", 3)]


def test_a_key_expires(spark):
    """With a time to live, a key without rows for that long starts anew. Such a query has no end, it is stopped."""
    schema = "series string, ts timestamp, id long"
    row = lambda i: ("a", datetime.datetime(2024, 1, 1, 0, i), i)
    kind = spark.createDataFrame([], schema).schema
    folder, out, ck = (scratch_path(spark, x) for x in ("in", "out", "ck"))
    put(spark, folder, [row(1), row(2), row(3)], schema)
    s = k.first_per_key(stream_files(spark, folder, kind), S, O, 2, ttl_ms=2000)
    query = rt.stream_to_table(s, out, ck, every="1 second")
    ids = lambda: sorted(r.id for r in read_batches(spark, out, s.schema).collect())
    try:
        for part in ([1, 2], [1, 2, 4]):
            end = time.time() + 60
            while time.time() < end:
                if query.lastProgress and ids() == part:
                    break
                time.sleep(0.5)
            assert ids() == part
            if len(part) == 2:
                time.sleep(3)
                put(spark, folder, [row(4)], schema)
    finally:
        query.stop()
    with pytest.raises(ValueError):
        k.first_per_key(stream_files(spark, folder, kind), S, O, 2, delay="1 minute", ttl_ms=1)


def test_stops_when_every_key_has_its_rows(spark, skewed, ordered):
    folder, path = scratch_path(spark, "in"), scratch_path(spark, "out")
    for part in ordered:
        put(spark, folder, part, skewed.schema)
    source = stream_files(spark, folder, skewed.schema, max_files=1)
    wanted = skewed.select("series").distinct()
    assert k.take_per_key(source, S, O, 5, wanted, path, scratch_path(spark, "ck"), every="1 second") == 0
    got = read_batches(spark, path)
    assert sorted((r.series, r.id, r.nth) for r in got.collect()) == plain_nth([r for p in ordered for r in p], lambda n: n <= 5)
    assert not [q for q in spark.streams.active]
    more = wanted.union(spark.createDataFrame([("absent",)], "series string"))
    assert k.take_per_key(source, S, O, 5, more, scratch_path(spark, "out"), scratch_path(spark, "ck")) == 1


def test_batch_log(spark, skewed, ordered):
    """Rows, metrics and dropped rows of every batch; reports beyond the memory's bound are read back from files."""
    folder = scratch_path(spark, "in")
    rows = sorted((r for part in ordered for r in part), key=lambda r: (r.ts, r.id))
    late = rows[:20]
    for a in range(20, 900, 44):
        put(spark, folder, rows[a : a + 44], skewed.schema)
    put(spark, folder, late, skewed.schema)
    files = math.ceil(880 / 44) + 1
    source = stream_files(spark, folder, skewed.schema, max_files=1).observe("o", F.count("*").alias("n"))
    path = scratch_path(spark, "log")
    with rt.BatchLog(spark, path, flush=6) as log:
        out = k.first_per_key(source, S, O, 1, "10 minutes")
        run = rt.drain(rt.start(out, scratch_path(spark, "ck"), fmt="noop"), 300)
        got = log.table(run).where("n_rows > 0").orderBy("batch").collect()
        assert len(log._rows[str(run.runId)]) < 6
    assert [r.batch for r in got] == list(range(files))
    assert [r.n_rows for r in got] == [44] * (files - 1) + [20]
    assert [r.sent for r in got] == [44 * (i + 1) for i in range(files - 1)] + [900]
    assert [json.loads(r.metrics)["o"]["n"] for r in got] == [r.n_rows for r in got]
    assert [r.dropped for r in got] == [0] * (files - 1) + [20]
    assert len(list(spark.read.json(path).inputFiles())) >= 3
