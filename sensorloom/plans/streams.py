"""Catalogue: the same operators on Structured Streaming, drained to the end."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as a
from ..operators import profile as p
from ..operators.detect import bands
from ..operators.quality import missing_counts, split_by_type
from ..session import scratch_path
from ..sinks.tables import (
    append_batch_to_table, append_rows, assign_batches, backfill_in_batches, read_batches, stage_batches, to_json_messages,
)
from ..sources.tables import stream_batches, stream_files
from ..functions.parsing import parse_message
from ..functions.timefn import parse_ts, time_text
from ..streaming import keyed
from ..streaming import runtime as rt
from ..streaming import stateful as st
from ..streaming.clusters import OnlineKMeans, StreamingKMeans
from ..streaming.detect import knn_batches, ksigma_stream
from ..streaming.percentiles import merge_batches, percentiles, rank_error, sketch_batches, stored_sketches
from .detectors import _CUSUM, _EWMA, _KNN, BASELINES, FIRST_CENTRES, KNN_WHOLE, SQL_SHIFTED, _online_sql, adwin_sql, shifted
from .ingest import MESSAGE, MICROS
from .profiles import FOUR, _union
from .registry import ORACLES, query, r4, r6, r8, table
from .views import ORDER, SERIES, SPLIT_AT, SQL_READINGS, readings, with_gaps


def event_stream(spark, d):
    """Events as a stream of files."""
    return stream_files(spark, f"{d}/events.parquet", table(spark, d, "events").schema)


def reading_stream(spark, d):
    """Events as a stream of messages, parsed and split."""
    messages = to_json_messages(event_stream(spark, d).withColumn("ts", time_text("ts", MICROS)))
    parsed = parse_message(messages, MESSAGE).withColumn("ts", parse_ts("ts", MICROS))
    split = F.when(F.col("ts") < F.lit(SPLIT_AT).cast("timestamp"), "train").otherwise("test")
    return parsed.withColumn("data_type", split)


def collected(df, mode="append"):
    """Drain a stream into a table. Complete mode keeps the last batch, which holds the whole result."""
    spark = df.sparkSession
    out, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "checkpoint")
    run = rt.drain(rt.stream_to_table(df, out, checkpoint, mode))
    if mode != "complete":
        return read_batches(spark, out, df.schema)
    return spark.read.schema(df.schema).parquet(f"{out}/batch_id={run.lastProgress['batchId']}")


_HOURLY = f"""SELECT data_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
    round(avg(value), 6) AS avg_value, count(*) AS record_count FROM ({SQL_READINGS}) GROUP BY data_type, date_trunc('hour', ts)"""


@query(
    "stream_tumbling",
    f"""{_HOURLY} HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 1 HOUR""",
)
def stream_tumbling(spark, d):
    """Append mode gives each window once the watermark has passed its end."""
    means = a.tumbling_mean(reading_stream(spark, d), "ts", ["value"], "1 hour", ["data_type"], watermark="1 hour")
    out = a.window_as_text(collected(means))
    return out.select("data_type", "window_start", r6("avg_value"), "record_count")


@query("stream_tumbling_complete", _HOURLY)
def stream_tumbling_complete(spark, d):
    means = a.tumbling_mean(reading_stream(spark, d), "ts", ["value"], "1 hour", ["data_type"])
    out = a.window_as_text(collected(means, "complete"))
    return out.select("data_type", "window_start", r6("avg_value"), "record_count")


@query("stream_split_counts", f"SELECT data_type, count(*) AS n_rows FROM ({SQL_READINGS}) GROUP BY data_type")
def stream_counts(spark, d):
    return collected(a.row_count(reading_stream(spark, d), ["data_type"]), "complete")


@query(
    "stream_corr",
    _union(
        f"SELECT '{x}' AS column_a, '{y}' AS column_b, round(corr({x}, {y}), 4) AS r FROM lineitem"
        for x in FOUR for y in FOUR if x != y
    ),
)
def stream_corr(spark, d):
    rows = stream_files(spark, f"{d}/lineitem.parquet", table(spark, d, "lineitem").schema)
    return collected(p.pairwise_corr(rows, FOUR), "complete").select("column_a", "column_b", r4("r"))


@query(
    "stream_ksigma",
    f"""WITH r AS ({SQL_READINGS}), s AS (SELECT avg(value) AS m, stddev_samp(value) AS sd FROM r WHERE data_type = 'train')
    SELECT event_id, CASE WHEN value > m + sd OR value < m - sd THEN 1 ELSE 0 END AS anomaly_flag FROM r, s
    WHERE data_type = 'test'""",
)
def stream_ksigma(spark, d):
    """Statistics of a bounded read of the train rows, flags on the test stream."""
    _, test = split_by_type(reading_stream(spark, d))
    flagged = ksigma_stream(readings(spark, d), test, "value", 1, F.col("data_type") == "train")
    return collected(flagged).select("event_id", "anomaly_flag")


@query(
    "stream_fan_out",
    f"""SELECT 'rows' AS result, event_type, count(*) AS n_rows FROM events GROUP BY 2
    UNION ALL SELECT data_type, event_type, count(*) FROM ({SQL_READINGS}) GROUP BY 1, 2""",
)
def stream_fan_out(spark, d):
    """One read of the source, three tables."""
    path, checkpoint = scratch_path(spark, "fanout"), scratch_path(spark, "checkpoint")
    source = reading_stream(spark, d)
    parts = {
        "rows": lambda b: b,
        "train": lambda b: split_by_type(b)[0],
        "test": lambda b: split_by_type(b)[1],
    }
    rt.drain(rt.fan_out(source, parts, path, checkpoint))
    count = lambda n: (
        read_batches(spark, f"{path}/{n}", source.schema)
        .groupBy(F.lit(n).alias("result"), "event_type")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return count("rows").unionByName(count("train")).unionByName(count("test"))


@query(
    "stream_json_sink",
    "SELECT event_id, event_type, round(value, 6) AS value FROM events",
)
def stream_json_sink(spark, d):
    path, checkpoint = scratch_path(spark, "json"), scratch_path(spark, "checkpoint")
    rows = event_stream(spark, d).select("event_id", "event_type", "value")
    rt.drain(rt.stream_to_json(rows, path, checkpoint))
    return spark.read.schema(rows.schema).json(path).select("event_id", "event_type", r6("value"))


@query("replay_in_batches", f"SELECT data_type, count(*) AS n_rows FROM ({SQL_READINGS}) GROUP BY data_type")
def replay_in_batches(spark, d):
    """Train, then test, each pushed in ordered batches into a folder that a stream reads."""
    folder = scratch_path(spark, "replay")
    rows = readings(spark, d).select("event_id", "ts", "data_type", "value")
    for part in split_by_type(rows):
        batch_rows = max(1, -(-part.count() // 4))
        backfill_in_batches(
            part, ORDER, scratch_path(spark, "staging"), lambda df, _: append_rows(df, folder), batch_rows
        )
    replay = stream_files(spark, folder, rows.schema, max_files=8)
    return collected(a.row_count(replay, ["data_type"]), "complete")


def _arrivals(batches):
    """Events arrive in equal parts of their order; one in ten comes a part late."""
    return f"""SELECT *, least((row_number() OVER (ORDER BY ts, event_id) - 1) // (SELECT greatest(count(*) // {batches}, 1) FROM events), {batches - 1})
    + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS batch_no FROM events"""


_ARRIVALS = _arrivals(4)


def arriving(spark, d, late=False, batches=4):
    """Events staged as at least so many ordered files, read as a stream of one file at a time."""
    events = table(spark, d, "events")
    size = max(events.count() // batches, 1)
    rows = assign_batches(events, ORDER, size).withColumn("batch_no", F.least("batch_no", F.lit(batches - 1)))
    if late:
        rows = rows.withColumn("batch_no", F.col("batch_no") + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0))
    folder = scratch_path(spark, "arriving")
    stage_batches(rows, "batch_no", ORDER, folder)
    return stream_batches(spark, folder, rows.schema)


@query(
    "replay_in_order",
    f"""SELECT batch_no AS batch_id, count(*) AS n_rows, min(event_id) AS first_id, max(event_id) AS last_id
    FROM ({_ARRIVALS}) GROUP BY batch_no""",
)
def replay_in_order(spark, d):
    """What each micro-batch of an ordered replay held."""
    out = scratch_path(spark, "replayed")
    rt.drain(rt.start(arriving(spark, d, True), scratch_path(spark, "checkpoint"), append_batch_to_table(out)))
    rows = spark.read.option("basePath", out).parquet(f"{out}/batch_id=*")
    return rows.groupBy(F.col("batch_id").cast("long").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


@query(
    "stream_progress",
    f"""SELECT batch_no AS batch, count(*) AS n_rows, CAST(sum(count(*)) OVER (ORDER BY batch_no) AS BIGINT) AS sent
    FROM ({_ARRIVALS}) GROUP BY batch_no""",
)
def stream_progress(spark, d):
    """Rows of each micro-batch and so far, as the query itself reports them."""
    out = scratch_path(spark, "progress")
    run = rt.drain(rt.start(arriving(spark, d, True), scratch_path(spark, "checkpoint"), append_batch_to_table(out)))
    return rt.progress_table(spark, run).where("n_rows > 0")


@query(
    "stream_batch_metrics",
    f"""SELECT batch_no AS batch, count(*) AS n_rows, CAST(sum(count(*)) OVER (ORDER BY batch_no) AS BIGINT) AS sent,
        count(*) FILTER (event_type = 'error') AS errors, max(event_id) AS last_id FROM ({_arrivals(160)}) GROUP BY batch_no""",
)
def stream_batch_metrics(spark, d):
    """Rows and observed metrics of each of more than 150 micro-batches, as a listener hears of them."""
    rows = arriving(spark, d, True, 160).observe("seen", F.count_if(F.col("event_type") == "error").alias("errors"), F.max("event_id").alias("last_id"))
    with rt.BatchLog(spark, scratch_path(spark, "batch_log"), flush=50) as log:
        run = rt.drain(rt.start(rows, scratch_path(spark, "checkpoint"), fmt="noop"))
        seen = log.table(run).where("n_rows > 0")
    metric = F.from_json("metrics", "seen struct<errors: long, last_id: long>").getField("seen")
    return seen.select("batch", "n_rows", "sent", metric.getField("errors").alias("errors"), metric.getField("last_id").alias("last_id"))


@query(
    "stream_dropped_rows",
    f"""WITH r AS ({_ARRIVALS}), b AS (SELECT batch_no, max(ts) AS newest, count(*) AS n FROM r GROUP BY batch_no),
    u AS (SELECT batch_no, n, max(newest) OVER (ORDER BY batch_no ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS before FROM b)
    SELECT batch_no AS batch, any_value(n) AS n_rows,
        count(*) FILTER (ts <= date_trunc('milliseconds', before) - INTERVAL 6 HOUR) AS dropped FROM r JOIN u USING (batch_no) GROUP BY batch_no""",
)
def stream_dropped_rows(spark, d):
    """How many rows of each micro-batch come behind the watermark, by the state store's own count.

    Rows are held against the watermark that the batch before began with.
    """
    rows = arriving(spark, d, True).withColumn("ts", F.col("ts").cast("timestamp"))
    with rt.BatchLog(spark) as log:
        out = keyed.every_nth_per_key(rows, ["event_type"], ORDER, 10, "6 hours")
        run = rt.drain(rt.start(out, scratch_path(spark, "checkpoint"), fmt="noop"))
        return log.table(run).where("n_rows > 0").select("batch", "n_rows", "dropped")


#: Rows that the watermark has passed at the end, eight days behind the newest.
_PASSED = """date_trunc('milliseconds', ts) <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 8 DAY FROM events)"""


@query(
    "stream_first_per_class",
    """SELECT event_id, event_type, nth FROM (
        SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS nth FROM events) WHERE nth <= 10""",
)
def stream_first_per_class(spark, d):
    """The first ten events of each type; the stream stops as soon as all types have them."""
    path, rows = scratch_path(spark, "firsts"), arriving(spark, d)
    wanted = table(spark, d, "events").select("event_type").distinct()
    short = keyed.take_per_key(rows, SERIES, ORDER, 10, wanted, path, scratch_path(spark, "checkpoint"))
    if short:
        raise RuntimeError(f"{short} types have fewer rows")
    return read_batches(spark, path).select("event_id", "event_type", "nth")


@query(
    "stream_every_nth",
    f"""SELECT event_id, event_type, nth FROM (
        SELECT event_id, event_type, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS nth FROM events)
        WHERE nth % 10 = 0 AND {_PASSED}""",
)
def stream_every_nth(spark, d):
    """Every tenth event of each type in order of time, although one event in ten comes a quarter late."""
    rows = arriving(spark, d, True).withColumn("ts", F.col("ts").cast("timestamp"))
    return collected(keyed.every_nth_per_key(rows, SERIES, ORDER, 10, "8 days")).select("event_id", "event_type", "nth")


@query("stream_adwin_late", adwin_sql(f"SELECT * FROM ({SQL_SHIFTED}) WHERE {_PASSED}", 1))
def stream_adwin_late(spark, d):
    """The row-by-row drift test with its buckets in the state store, over events of which one in ten comes a quarter late."""
    rows = arriving(spark, d, True).withColumn("ts", F.col("ts").cast("timestamp"))
    split = F.when(F.col("ts") < F.lit(SPLIT_AT).cast("timestamp"), "train").otherwise("test")
    out = keyed.adwin_per_key(shifted(rows.withColumn("data_type", split)), ["event_type", "data_type"], ORDER, "value", "8 days")
    return collected(out).select("event_id", "event_type", "data_type", "drift_detected")


@query(
    "stream_late_rows",
    f"""WITH r AS ({_ARRIVALS}), b AS (SELECT batch_no, max(ts) AS newest FROM r GROUP BY batch_no),
    u AS (SELECT batch_no, max(newest) OVER (ORDER BY batch_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM b)
    SELECT event_id, CASE WHEN ts < before - INTERVAL 1 HOUR THEN 'late' ELSE 'on_time' END AS outcome FROM r JOIN u USING (batch_no)""",
)
def stream_late(spark, d):
    """Rows that come after newer ones by more than an hour."""
    path, checkpoint = scratch_path(spark, "late"), scratch_path(spark, "checkpoint")
    rows = arriving(spark, d, True)
    rt.drain(rt.split_late(rows, "ts", "1 hour", path, checkpoint))
    part = lambda n: read_batches(spark, f"{path}/{n}", rows.schema).select("event_id", F.lit(n).alias("outcome"))
    return part("on_time").unionByName(part("late"))


def over_batches(spark, rows, make):
    """Drain a stream through a function of :mod:`streaming.stateful` and read its rows."""
    out = scratch_path(spark, "carried")
    rt.drain(rt.start(rows, scratch_path(spark, "checkpoint"), make(out)))
    return spark.read.parquet(f"{out}/rows/batch_id=*")


@query("stream_ewma", _EWMA)
def stream_ewma(spark, d):
    """Over four micro-batches, each series' average carried on."""
    out = over_batches(spark, arriving(spark, d), lambda path: st.ewma_batches(path, SERIES, ORDER, "value"))
    return out.select("event_id", r6("ewma"))


@query("stream_cusum", _CUSUM)
def stream_cusum(spark, d):
    """Over four micro-batches, each series' two sums carried on."""
    rows = with_gaps(arriving(spark, d))
    out = over_batches(spark, rows, lambda path: st.cusum_batches(path, SERIES, ORDER, "value", 50, 49))
    return out.select("event_id", r6("cusum_pos"), r6("cusum_neg"), "alarm")


def _adwin_stream(spark, d, change=lambda df: df, **options):
    split = F.when(F.col("ts") < F.lit(SPLIT_AT).cast("timestamp"), "train").otherwise("test")
    rows = change(arriving(spark, d).withColumn("data_type", split))
    out = over_batches(spark, rows, lambda path: st.adwin_batches(path, ["event_type", "data_type"], ORDER, "value", **options))
    return out.select("event_id", "event_type", "data_type", "drift_detected")


@query("stream_adwin", adwin_sql(SQL_READINGS, 1))
def stream_adwin(spark, d):
    """Row-by-row drift test with one window per series and split, over four micro-batches."""
    return _adwin_stream(spark, d)


@query("stream_adwin_shifts", adwin_sql(SQL_SHIFTED, 1))
def stream_adwin_shifts(spark, d):
    """Series with many cuts; the rows of a micro-batch are walked in chunks from the window before it."""
    return _adwin_stream(spark, d, shifted, chunk_items=250)


@query("stream_ewma_lag1", ORACLES["ewma_lag1"])
def stream_ewma_lag1(spark, d):
    """Over four micro-batches: the first reading of a batch is blended with the last of the one before."""
    out = over_batches(spark, arriving(spark, d), lambda path: st.ewma_lag1_batches(path, SERIES, ORDER, "value"))
    return out.select("event_id", r6("ewma"))


@query("stream_zscore", ORACLES["zscore_flag"])
def stream_zscore(spark, d):
    """Fixed baselines: no state."""
    rows = stream_files(spark, f"{d}/lineitem.parquet", table(spark, d, "lineitem").schema)
    out = collected(bands.zscore_flag(rows, BASELINES, 1.5))
    return out.select("l_orderkey", "l_linenumber", *[r8(f"z_{c}") for c in BASELINES], *[f"anomaly_{c}" for c in BASELINES])


@query(
    "stream_features",
    ORACLES["tumbling_features"].replace("FROM events", "FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 1 HOUR"),
)
def stream_features(spark, d):
    """Window features in append mode: the windows that the watermark has passed."""
    features = a.window_features(reading_stream(spark, d).withWatermark("ts", "1 hour"), "ts", ["value"], "1 day", ["event_type"])
    return a.window_as_text(collected(features)).select(
        "event_type", "window_start", r6("mean_value"), r4("stddev_value"), r6("min_value"), r6("max_value"), "record_count"
    )


@query("stream_missing_counts", ORACLES["missing_counts"])
def stream_missing(spark, d):
    rows = with_gaps(event_stream(spark, d))
    return collected(missing_counts(rows, ["event_id", "event_type", "value"]), "complete")


@query("stream_mean_std", ORACLES["mean_std"])
def stream_mean_std(spark, d):
    return collected(a.mean_std(event_stream(spark, d), "value"), "complete").select(r6("mean"), r4("std"))


@query("stream_kmeans")
def stream_kmeans(spark, d):
    """Centres learnt from the train stream label the test stream."""
    model = StreamingKMeans(scratch_path(spark, "centres"), ["value", "user_id"])
    out = scratch_path(spark, "labelled")
    train, test = split_by_type(reading_stream(spark, d))
    rt.drain(rt.start(train, scratch_path(spark, "checkpoint"), model.train_batches(f"{out}/train")))
    rt.drain(rt.start(test, scratch_path(spark, "checkpoint"), model.test_batches(f"{out}/test")))
    return spark.read.parquet(f"{out}/test/batch_id=*").select("event_id", "data_type", "cluster")


@query(
    "stream_knn",
    "SELECT event_id, knn_score FROM (" + _KNN.format(
        id="event_id", order="ts, event_id", src="events", v="[value, CAST(user_id AS DOUBLE)]"
    ) + ")",
)
def stream_knn(spark, d):
    """Neighbour scores of each micro-batch."""
    out = scratch_path(spark, "knn")
    rows = event_stream(spark, d).select("event_id", "ts", "value", "user_id")
    rt.drain(rt.start(rows, scratch_path(spark, "checkpoint"), knn_batches(out, ORDER, ["value", "user_id"])))
    return spark.read.parquet(f"{out}/batch_id=*").select("event_id", r6("knn_score"))


@query("stream_knn_whole", KNN_WHOLE.format(src=_ARRIVALS, v="[value, CAST(user_id AS DOUBLE)]", group="batch_no"))
def stream_knn_whole(spark, d):
    """Neighbour scores of each of five micro-batches, every row against all of its batch."""
    out = scratch_path(spark, "knn")
    rows = arriving(spark, d, True).select("event_id", "ts", "value", "user_id")
    rt.drain(rt.start(rows, scratch_path(spark, "checkpoint"), knn_batches(out, ORDER, ["value", "user_id"], block_rows=None)))
    return spark.read.parquet(f"{out}/batch_id=*").select("event_id", r6("knn_score"))


@query("stream_kmeans_online", _online_sql("SELECT event_id, 'test' AS data_type, CAST(cluster AS INTEGER) AS cluster FROM labelled"))
def stream_kmeans_online(spark, d):
    """Centres that move with every train row over four micro-batches label the test rows."""
    split = F.when(F.col("ts") < F.lit(SPLIT_AT).cast("timestamp"), "train").otherwise("test")
    train, test = split_by_type(arriving(spark, d).withColumn("data_type", split))
    model = OnlineKMeans(scratch_path(spark, "centres"), ["value", "user_id"], order=ORDER, start=FIRST_CENTRES)
    out = scratch_path(spark, "labelled")
    rt.drain(rt.start(train, scratch_path(spark, "checkpoint"), model.train_batches(f"{out}/train")))
    rt.drain(rt.start(test, scratch_path(spark, "checkpoint"), model.test_batches(f"{out}/test")))
    return spark.read.parquet(f"{out}/test/batch_id=*").select("event_id", "data_type", "cluster")


@query(
    "stream_percentiles",
    """SELECT event_type, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n_rows, round(min(value), 6) AS min_value,
        round(max(value), 6) AS max_value, TRUE AS p50_holds, TRUE AS p95_holds FROM events GROUP BY event_type, date_trunc('day', ts)""",
)
def stream_percentiles(spark, d):
    """Percentiles of each day and type from sketches of five micro-batches, late rows among them.

    An estimate holds if its rank among the events, counted here for that alone, is within three times the sketch's bound.
    """
    out = scratch_path(spark, "sketches")
    rt.drain(rt.start(arriving(spark, d, True), scratch_path(spark, "checkpoint"), sketch_batches(out, "ts", "value", "1 day", SERIES)))
    merge_batches(spark, out, SERIES)
    found = percentiles(stored_sketches(spark, out), ["event_type", "window_start"], [0.5, 0.95])
    events = table(spark, d, "events").select(F.col("event_type").alias("t"), F.date_trunc("day", "ts").cast("timestamp").alias("day"), "value")
    near = found.join(events, (F.col("event_type") == F.col("t")) & (F.col("window_start") == F.col("day")))
    off = 3 * rank_error()

    def holds(q, share):
        below, upto = F.avg((F.col("value") < F.col(q)).cast("double")), F.avg((F.col("value") <= F.col(q)).cast("double"))
        return ((below - off <= share) & (upto + off >= share)).alias(f"{q}_holds")

    near = near.groupBy("event_type", "window_start", "n_rows", "min_value", "max_value").agg(holds("p50", 0.5), holds("p95", 0.95))
    return near.withColumns({"window_start": time_text("window_start"), "min_value": F.round("min_value", 6), "max_value": F.round("max_value", 6)})
