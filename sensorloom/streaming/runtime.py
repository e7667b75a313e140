"""Starting, draining and watching streaming queries."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..sinks.tables import append_batch_to_table, to_json_messages


def start(
    df: DataFrame,
    checkpoint: str,
    batch_fn: Callable[[DataFrame, int], None] | None = None,
    fmt: str | None = None,
    path: str | None = None,
    mode: str = "append",
    every: str | None = None,
    name: str | None = None,
    **options: object,
) -> StreamingQuery:
    """Start a query with its checkpoint, which is never optional.

    With ``every`` it triggers at that interval and runs on; without it, it takes what
    is available in bounded batches and stops.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.options(**options)
    if name:
        writer = writer.queryName(name)
    if batch_fn:
        writer = writer.foreachBatch(batch_fn)
    elif fmt:
        writer = writer.format(fmt)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path) if path else writer.start()


def drain(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Wait until an available-now query has taken all its input; its failure raises here."""
    done = query.awaitTermination(timeout) if timeout else query.awaitTermination()
    if timeout and not done:
        query.stop()
        raise TimeoutError("streaming query did not finish in time")
    return query


def await_any(spark: SparkSession) -> None:
    """Block until some query of the session ends; a failed one raises."""
    spark.streams.awaitAnyTermination()


def stream_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append", every: str | None = None) -> StreamingQuery:
    """Append each micro-batch to a table; a repeated batch replaces itself.

    In complete and update mode a batch holds newer values of earlier rows; read the last
    batch (complete) or the newest row per key (update).
    """
    return start(df, checkpoint, append_batch_to_table(path), mode=mode, every=every)


def stream_to_json(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append rows as JSON files."""
    return start(df, checkpoint, fmt="json", path=path, every=every)


def stream_to_console(df: DataFrame, checkpoint: str, mode: str = "append", rows: int = 20, every: str | None = None) -> StreamingQuery:
    """Show rows, for debugging."""
    return start(df, checkpoint, fmt="console", mode=mode, every=every, numRows=rows, truncate=False)


def stream_to_topic(df: DataFrame, servers: str, topic: str, checkpoint: str, key: str | None = None, every: str | None = None) -> StreamingQuery:
    """Send every row to a topic as JSON."""
    return start(
        to_json_messages(df, key), checkpoint, fmt="kafka", every=every,
        **{"kafka.bootstrap.servers": servers, "topic": topic},
    )


def fan_out(
    df: DataFrame, outputs: Mapping[str, Callable[[DataFrame], DataFrame]], path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """One source, several result tables below ``path``: the source is read and parsed once.

    Each micro-batch is kept in executor memory while its results are written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, transform in outputs.items():
                append_batch_to_table(f"{path}/{name}")(transform(batch), batch_id)
        finally:
            batch.unpersist()

    return start(df, checkpoint, write, every=every)


def split_late(
    df: DataFrame, ts: str, delay: str, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write rows to ``path/on_time`` or, when older than the newest time of the batches
    before minus ``delay``, to ``path/late``.

    The newest time up to each batch is stored with the batch, so a restart finds it again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            newest = None
            if batch_id > 0:
                newest = spark.read.parquet(f"{path}/newest/batch_id={batch_id - 1}").first()["newest"]
            before = F.lit(newest).cast("timestamp")
            upto = F.greatest(F.max(F.col(ts).cast("timestamp")), before).alias("newest")
            batch.agg(upto).write.mode("overwrite").parquet(f"{path}/newest/batch_id={batch_id}")
            edge = before - F.expr(f"interval {delay}")
            late = F.coalesce(F.col(ts).cast("timestamp") < edge, F.lit(False))
            append_batch_to_table(f"{path}/on_time")(batch.where(~late), batch_id)
            append_batch_to_table(f"{path}/late")(batch.where(late), batch_id)
        finally:
            batch.unpersist()

    return start(df, checkpoint, write, every=every)


_BATCH = "batch long, n_rows long, sent long, dropped long, seconds double, watermark string, metrics string"


class BatchLog(StreamingQueryListener):
    """Every finished micro-batch of every query, however many there are.

    A query itself remembers only its last hundred reports; this listener gets each one when its batch ends. ``path`` takes them as
    small JSON files of ``flush`` batches each, so that a query may run for months; without it they stay in memory.
    Use as a context: ``with BatchLog(spark) as log: ...; log.table(query)``.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, flush: int = 1000):
        self.spark, self.path, self.flush = spark, path, flush
        self._lock = threading.Lock()
        self._rows: dict[str, list[tuple]] = {}
        self._sent: dict[str, int] = {}
        self._ended: dict[str, threading.Event] = {}

    def __enter__(self) -> BatchLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        self.spark.streams.removeListener(self)

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        run = str(p.runId)
        dropped = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        metrics = {name: row.asDict() for name, row in p.observedMetrics.items()}
        with self._lock:
            sent = self._sent[run] = self._sent.get(run, 0) + p.numInputRows
            watermark = dict(p.eventTime).get("watermark")
            rows = self._rows.setdefault(run, [])
            rows.append((p.batchId, p.numInputRows, sent, dropped, p.batchDuration / 1000, watermark, json.dumps(metrics, default=str)))
            full = rows[: self.flush] if self.path and len(rows) >= self.flush else []
            del rows[: len(full)]
        if full:
            self.spark.createDataFrame(full, _BATCH).coalesce(1).write.mode("append").json(f"{self.path}/run={run}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def table(self, query: StreamingQuery, timeout: float = 60) -> DataFrame:
        """A row per micro-batch of the query, the ended ones if it still runs: its number, its rows and the rows so far, the rows that a
        stateful operator dropped because the watermark had passed them, its duration, the watermark it began with, and the
        metrics of ``DataFrame.observe`` as JSON.

        Aggregations count a dropped row per task and group, as they add up first; all others count rows.
        """
        run = str(query.runId)
        # Reports come from a queue: that of the end is behind those of all batches.
        if not query.isActive and not self._end(run).wait(timeout):
            raise TimeoutError("the reports of the query did not arrive in time")
        with self._lock:
            rows = list(self._rows.get(run, []))
        out = self.spark.createDataFrame(rows, _BATCH)
        if self.path and self._sent.get(run) and len(rows) < (rows[-1][0] + 1 if rows else 1):
            out = out.unionByName(self.spark.read.schema(_BATCH).json(f"{self.path}/run={run}"))
        return out


def progress_table(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Batch number, rows of the batch and rows so far, from what the query remembers: its last hundred reports.

    :class:`BatchLog` has them all.
    """
    rows, sent = [], 0
    for p in query.recentProgress:
        sent += p["numInputRows"]
        rows.append((p["batchId"], p["numInputRows"], sent))
    return spark.createDataFrame(rows, "batch long, n_rows long, sent long")


class ReplayProgress(StreamingQueryListener):
    """Hands (batch, rows, rows so far, total) of every finished batch to a callback."""

    def __init__(self, total: int, report: Callable[[dict], None]):
        self.total, self.report, self.sent = total, report, 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.sent += p.numInputRows
        self.report({"batch": p.batchId, "rows": p.numInputRows, "sent": self.sent, "total": self.total})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
