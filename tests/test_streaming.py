"""Streams against their batch twins, for any number of micro-batches, and restarts."""

import math

import pytest
from pyspark.sql import functions as F

from sensorloom.operators import aggregate as a
from sensorloom.operators.detect import clusters, cumulative, drift
from sensorloom.session import scratch_path
from sensorloom.sinks.tables import append_batch_to_table, assign_batches, read_batches
from sensorloom.sources.tables import stream_files
from sensorloom.sources.topic import read_message_files_stream
from sensorloom.streaming import runtime as rt
from sensorloom.streaming import stateful as st
from sensorloom.streaming.clusters import StreamingKMeans
from sensorloom.streaming.detect import knn_batches, ksigma_stream

S, O = ["series"], ["ts", "id"]


@pytest.fixture(scope="module")
def replays(spark, skewed):
    """The readings as 1, 4 and 16 files in time order, written one after another."""
    out = {}
    for n in (1, 4, 16):
        folder = scratch_path(spark, "replay")
        numbered = assign_batches(skewed, O, math.ceil(900 / n)).persist()
        for b in range(n):
            part = numbered.where(F.col("batch_no") == b).drop("batch_no").coalesce(1)
            part.write.mode("append").parquet(folder)
        numbered.unpersist()
        out[n] = folder
    return out


def stream(spark, skewed, folder):
    return stream_files(spark, folder, skewed.schema, max_files=1)


def run(df, mode="append", checkpoint=None, out=None):
    spark = df.sparkSession
    out = out or scratch_path(spark, "out")
    q = rt.drain(rt.stream_to_table(df, out, checkpoint or scratch_path(spark, "ck"), mode), 300)
    return q, out


def table(df, *cols):
    return sorted(str(tuple(r)) for r in df.select(*cols).collect())


@pytest.mark.parametrize("n", [1, 4, 16])
def test_ewma(spark, skewed, replays, n):
    s = st.ewma_stream(stream(spark, skewed, replays[n]), S, O, "x")
    _, out = run(s)
    got = {r["id"]: r["ewma"] for r in read_batches(spark, out, s.schema).collect()}
    want = {r["id"]: r["ewma"] for r in cumulative.ewma(skewed, S, O, "x").collect()}
    assert got.keys() == want.keys()
    assert all((got[k] is None) == (w is None) and (w is None or got[k] == pytest.approx(w)) for k, w in want.items())


@pytest.mark.parametrize("n", [4])
def test_cusum(spark, skewed, replays, n):
    s = st.cusum_stream(stream(spark, skewed, replays[n]), S, O, "x", 10, 3)
    _, out = run(s)
    cols = ["id", F.round("cusum_pos", 6), F.round("cusum_neg", 6), "alarm"]
    assert table(read_batches(spark, out, s.schema), *cols) == table(cumulative.cusum(skewed, S, O, "x", 10, 3), *cols)


@pytest.mark.parametrize("n", [1, 16])
def test_adwin(spark, skewed, replays, n):
    s = st.adwin_stream(stream(spark, skewed, replays[n]), S, O, "x")
    _, out = run(s)
    want = drift.adwin(skewed, S, O, "x", block_rows=1)
    assert table(read_batches(spark, out, s.schema), "id", "drift_detected") == table(want, "id", "drift_detected")


def feed(spark, run, batches, schema):
    """What a function for ``foreachBatch`` does with these rows, batch after batch."""
    for k, rows in enumerate(batches):
        run(spark.createDataFrame(rows, schema), k)


def test_adwin_batches_keep_rows_apart(spark):
    """Two series with the same times, NULL keys of order and of series, rows without a reading, a series missing from a batch."""
    path = scratch_path(spark, "adwin")
    schema = "series string, t long, x double"
    five = [("a", t, float(t)) for t in range(5)] + [("b", t, float(t)) for t in range(5)]
    odd = [(None, 1, 1.0), (None, None, 2.0), ("b", 7, None), ("b", 8, float("nan"))]
    feed(spark, st.adwin_batches(path, S, ["t"], "x"), [five, odd, [("a", 9, 1.0)]], schema)
    got = spark.read.parquet(f"{path}/rows/batch_id=*")
    assert got.columns == ["series", "t", "x", "drift_detected"]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, got.drop("drift_detected").collect())) == sorted(map(key, [*five, *odd, ("a", 9, 1.0)]))


def test_adwin_batches_broadcast_nothing(spark, monkeypatch):
    """Cuts go to their rows by shuffle, as there may be as many as a share of the rows."""
    asked, broadcast = [], F.broadcast
    monkeypatch.setattr(F, "broadcast", lambda df: (asked.append(df.columns), broadcast(df))[1])
    path = scratch_path(spark, "adwin")
    rows = [("a", t, 50.0 * (t >= 300)) for t in range(600)] + [("a", 600 + t, None) for t in range(3)]
    feed(spark, st.adwin_batches(path, S, ["t"], "x", chunk_items=100), [rows], "series string, t long, x double")
    got = spark.read.parquet(f"{path}/rows/batch_id=*")
    assert not asked and got.count() == 603 and got.where("drift_detected = 1").count() > 0


def test_adwin_batches_with_many_cuts_send_nothing_round(spark):
    """Readings that stay for some rows each, as in repeated tables, so that most chunks have cuts: no join of any batch is a broadcast."""
    x = [float(v) for v in range(0, 1200, 100) for _ in range(60)]
    rows = [("a", t, v) for t, v in enumerate(x)]
    kept = spark._jsparkSession.sharedState().statusStore()
    done = spark.sparkContext._jsc.sc().listenerBus()
    plans = lambda: {r.executionId(): r.physicalPlanDescription() for r in map(kept.executionsList().apply, range(kept.executionsList().size()))}
    before, path = plans(), scratch_path(spark, "adwin")
    feed(spark, st.adwin_batches(path, S, ["t"], "x", chunk_items=50), [rows[:400], rows[400:]], "series string, t long, x double")
    done.waitUntilEmpty()
    ran = [p for i, p in plans().items() if i not in before]
    assert ran and not [p for p in ran if "BroadcastExchange" in p]
    window = drift.AdaptiveWindow()
    want = [t for t, v in enumerate(x) if window.add(1, v)]
    got = spark.read.parquet(f"{path}/rows/batch_id=*").where("drift_detected = 1")
    assert len(want) > 5 and sorted(r.t for r in got.collect()) == want


@pytest.mark.parametrize("n", [4])
def test_adwin_batches_are_one_walk(spark, skewed, replays, n):
    path = scratch_path(spark, "adwin")
    rt.drain(rt.start(stream(spark, skewed, replays[n]), scratch_path(spark, "ck"), st.adwin_batches(path, S, O, "x", chunk_items=90)), 600)
    want = drift.adwin(skewed, S, O, "x", block_rows=1)
    got = spark.read.parquet(f"{path}/rows/batch_id=*")
    assert table(got, "id", "drift_detected") == table(want, "id", "drift_detected")
    assert got.where("drift_detected = 1").count() > 0


def test_streams_leave_bounded_scratch(spark, skewed, tmp_path, monkeypatch):
    """Whatever a micro-batch writes for itself goes; of the states the last two stay."""
    import sensorloom.session as session

    monkeypatch.setattr(session, "_scratch_folder", lambda _: str(tmp_path / "scratch"))
    runs = {
        "ewma": st.ewma_batches(str(tmp_path / "ewma"), S, O, "x"),
        "lag1": st.ewma_lag1_batches(str(tmp_path / "lag1"), S, O, "x"),
        "cusum": st.cusum_batches(str(tmp_path / "cusum"), S, O, "x", 10, 3),
        "adwin": st.adwin_batches(str(tmp_path / "adwin"), S, O, "x", chunk_items=20),
    }
    rows = skewed.orderBy("ts", "id").limit(80).collect()
    for name, run in runs.items():
        feed(spark, run, [rows[k : k + 20] for k in range(0, 80, 20)], skewed.schema)
        states = sorted(p.name for p in (tmp_path / name / "states").glob("batch_id=*"))
        assert states == ["batch_id=2", "batch_id=3"], name
        assert len(list((tmp_path / name / "rows").glob("batch_id=*"))) == 4
        assert not list((tmp_path / "scratch").glob("*")), name


def test_a_repeated_batch_replaces_itself(spark, skewed):
    path = scratch_path(spark, "ewma")
    run = st.ewma_batches(path, S, O, "x")
    rows = skewed.orderBy("ts", "id").collect()
    parts = [rows[:300], rows[300:600], rows[600:]]
    for k in (0, 1, 1, 2, 2):
        run(spark.createDataFrame(parts[k], skewed.schema), k)
    got = spark.read.parquet(f"{path}/rows/batch_id=*")
    assert table(got, "id", F.round("ewma", 9)) == table(cumulative.ewma(skewed, S, O, "x"), "id", F.round("ewma", 9))


def test_restart_goes_on_with_the_state(spark, skewed):
    """Half the files, stop, the other half with the same checkpoint: as if never stopped."""
    folder, out, ck = (scratch_path(spark, x) for x in ("in", "out", "ck"))
    numbered = assign_batches(skewed, O, 300)
    schema = None
    for b in range(3):
        numbered.where(F.col("batch_no") == b).drop("batch_no").coalesce(1).write.mode("append").parquet(folder)
        s = st.ewma_stream(stream(spark, skewed, folder), S, O, "x")
        schema = s.schema
        run(s, checkpoint=ck, out=out)
    cols = ["id", F.round("ewma", 9)]
    assert table(read_batches(spark, out, schema), *cols) == table(cumulative.ewma(skewed, S, O, "x"), *cols)


@pytest.mark.parametrize("n", [1, 4, 16])
def test_complete_aggregate(spark, skewed, replays, n):
    agg = lambda df: a.window_features(df.where("not isnan(x)"), "ts", ["x"], "2 minutes", S)
    s = agg(stream(spark, skewed, replays[n]))
    q, out = run(s, "complete")
    got = spark.read.schema(s.schema).parquet(f"{out}/batch_id={q.lastProgress['batchId']}")
    cols = ["series", "window_start", F.round("mean_x", 6), F.round("stddev_x", 6), "min_x", "max_x", "record_count"]
    assert table(got, *cols) == table(agg(skewed), *cols)


@pytest.mark.parametrize("n", [1, 4])
def test_append_gives_closed_windows(spark, skewed, replays, n):
    s = a.tumbling_mean(stream(spark, skewed, replays[n]), "ts", ["id"], "1 minute", watermark="1 minute")
    _, out = run(s)
    newest = skewed.agg(F.max("ts")).first()[0]
    closed = a.tumbling_mean(skewed, "ts", ["id"], "1 minute").where(
        F.col("window_start") + F.expr("interval 1 minute") <= F.lit(newest) - F.expr("interval 1 minute")
    )
    assert table(read_batches(spark, out, s.schema), "*") == table(closed, "*")


def test_ksigma_two_phases(spark, skewed, replays):
    history = skewed.where("not isnan(x)")
    s = ksigma_stream(history, stream(spark, skewed, replays[4]).where("not isnan(x)"), "x", 2, F.col("id") < 300)
    _, out = run(s)
    rows = read_batches(spark, out, s.schema)
    m, sd = history.where("id < 300").agg(F.avg("x"), F.stddev_samp("x")).first()
    assert rows.where("anomaly_flag = 1").count() == history.where((F.col("x") > m + 2 * sd) | (F.col("x") < m - 2 * sd)).count()
    with pytest.raises(ValueError):
        ksigma_stream(skewed.where("false"), skewed, "x")


def test_late_rows(spark):
    """The second file is older than the first by more than the delay, except one row."""
    folder, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    make = lambda times: spark.createDataFrame([(t,) for t in times], "id long").select("id", F.timestamp_seconds("id").alias("ts"))
    first = make([1000, 1100])
    first.coalesce(1).write.mode("append").parquet(folder)
    make([1035, 1050, 1200]).coalesce(1).write.mode("append").parquet(folder)
    make([1100, 1150]).coalesce(1).write.mode("append").parquet(folder)
    rt.drain(rt.split_late(stream_files(spark, folder, first.schema, max_files=1), "ts", "1 minute", out, scratch_path(spark, "ck")), 300)
    ids = lambda n: sorted(r["id"] for r in read_batches(spark, f"{out}/{n}", first.schema).collect())
    assert ids("late") == [1035, 1100] and ids("on_time") == [1000, 1050, 1100, 1150, 1200]


def test_fan_out_and_progress(spark, skewed, replays):
    out = scratch_path(spark, "fan")
    reports = []
    listener = rt.ReplayProgress(900, reports.append)
    spark.streams.addListener(listener)
    try:
        parts = {"hot": lambda b: b.where("series = 'hot'"), "counts": lambda b: b.groupBy("series").count()}
        q = rt.drain(rt.fan_out(stream(spark, skewed, replays[4]), parts, out, scratch_path(spark, "ck")), 300)
        import time

        for _ in range(100):
            if sum(r["rows"] for r in reports) >= 900:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert spark.read.parquet(f"{out}/hot").count() == skewed.where("series = 'hot'").count()
    assert spark.read.parquet(f"{out}/counts").agg(F.sum("count")).first()[0] == 900
    assert sum(r["rows"] for r in reports) == 900
    assert [r["n_rows"] for r in rt.progress_table(spark, q).where("n_rows > 0").collect()] == [225] * 4


def test_failed_batch_is_repeated_once(spark, skewed, replays):
    """A sink that fails on one batch fails the query; the restart leaves every row once."""
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "ck")
    write = append_batch_to_table(out)
    state = {"fail": True}

    def flaky(df, batch):
        write(df, batch)
        if batch == 2 and state["fail"]:
            state["fail"] = False
            raise RuntimeError("sink lost")

    with pytest.raises(Exception, match="sink lost"):
        rt.drain(rt.start(stream(spark, skewed, replays[4]), ck, flaky), 300)
    rt.drain(rt.start(stream(spark, skewed, replays[4]), ck, flaky), 300)
    assert table(read_batches(spark, out, skewed.schema), "id") == table(skewed, "id")


def test_streaming_kmeans(spark):
    """Centres after each batch follow the decayed update, written out in plain Python."""
    model = StreamingKMeans(scratch_path(spark, "centres"), ["a"], k=2, halflife=0.5)
    batches = [[0.0, 1.0, 10.0, 11.0], [2.0, 12.0, 13.0], [100.0]]
    frames = [spark.createDataFrame([(x,) for x in b], "a double") for b in batches]
    centres = None
    for i, (xs, df) in enumerate(zip(batches, frames)):
        if centres is None:
            centres = [(0.0, c[0]) for _, c in model._first_centres(df)]
        groups = {0: [], 1: []}
        for x in xs:
            groups[min((0, 1), key=lambda c: (abs(x - centres[c][1]), c))].append(x)
        decayed = [(w * 0.25, c) for w, c in centres]
        centres = [((w * c + sum(g)) / (w + len(g)) if g else c, w + len(g)) for (w, c), g in zip(decayed, groups.values())]
        centres = [(w, c) for c, w in centres]
        got = model.learn(df, i)
        assert [w for w, _ in got] == pytest.approx([w for w, _ in centres])
        assert [c[0] for _, c in got] == pytest.approx([c for _, c in centres])
    again = model.learn(frames[2], 2)  # a repeated batch starts from the batch before it
    assert [c[0] for _, c in again] == pytest.approx([c for _, c in centres])
    assert [c[0] for _, c in model.centres(spark)] == pytest.approx([c for _, c in centres])
    labelled = model.label(frames[1])
    want = clusters.nearest_centroid(frames[1], ["a"], [[c] for _, c in centres])
    assert table(labelled, "a", "cluster") == table(want, "a", "cluster")
    assert StreamingKMeans(scratch_path(spark, "none"), ["a"]).label(frames[0]).where("cluster is not null").count() == 0


def test_knn_per_batch(spark, skewed, replays):
    out = scratch_path(spark, "knn")
    rt.drain(rt.start(stream(spark, skewed, replays[4]), scratch_path(spark, "ck"), knn_batches(out, O, ["x"])), 300)
    rows = spark.read.parquet(out)
    assert rows.groupBy("batch_id").agg(F.max("knn_score").alias("m")).where("m <> 1").count() == 0
    assert rows.count() == skewed.where("x is not null and not isnan(x)").count()


def test_messages_and_sinks(spark, skewed, capfd):
    folder = scratch_path(spark, "messages")
    skewed.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.text(folder)
    messages = read_message_files_stream(spark, folder, max_files=1)
    assert dict(messages.dtypes) == {"value": "binary"}
    out = scratch_path(spark, "json")
    rt.drain(rt.stream_to_json(messages.select(F.col("value").cast("string")), out, scratch_path(spark, "ck")), 300)
    assert spark.read.schema("value string").json(out).count() == 900
    rt.drain(rt.stream_to_console(a.row_count(messages), scratch_path(spark, "ck"), "complete"), 300)
