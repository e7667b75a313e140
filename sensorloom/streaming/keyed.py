"""Operators whose state lives in the state store, one typed value, list or map per key.

They run on ``transformWithState`` of Spark 4: state is read and written entry by entry, so that a key's state may be larger than a
worker's memory, each entry can expire by itself, and timers wake a key when the watermark passes a time. The store must be the one
on RocksDB (:func:`use_state_store`). A key's rows go through one task, as in every keyed stream; the batch-carried
forms of :mod:`.stateful` spread them.

Order. Rows of a micro-batch reach a key in no order. Without ``delay`` an operator sorts what a micro-batch brings for a key (its
rate limit bounds that) and rows must not come out of order across micro-batches; the first n rows are picked without sorting the
others. With ``delay`` rows may come late by that much: they wait until the watermark passes their time (milliseconds), and are then
handled in order of the order columns, whatever order they came in. They wait packed, some thousand to an entry of a map state, by
slots of time a 256th of the delay long, so that the calls to the state grow with the slots and not with the rows; the rows of a slot
and key are sorted together in memory. A key has one timer, at its first waiting row. Rows behind the watermark or without a time are
dropped; Spark counts the former (:class:`.runtime.BatchLog`).
"""

from __future__ import annotations

import heapq
import pickle
import threading
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.detect.drift_walk import Rule, Window, _centred, _plain, walk
from ..operators.ordered import join_same
from ..sinks.tables import append_batch_to_table
from .runtime import drain, start

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB, which ``transformWithState`` needs, and of its versions only a few."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


#: A waiting row's time in milliseconds.
_AT = "__at"
#: Slots of time in a delay; waiting rows of an entry of the state, and of a worker before they are written.
SLOTS, BLOCK_ROWS, HELD_ROWS = 256, 4096, 65_536


class _Ordered(StatefulProcessor):
    """Hands a key's rows, as tuples, to :meth:`step` in order; subclasses say what state they have and what a row becomes.

    ``columns`` are a row's columns as they are kept and given out, ``out`` the names of an output row, ``slot_ms`` the
    length of a slot for rows that wait (0: none do).
    """

    def __init__(self, order: Sequence[str], columns: T.StructType, out: Sequence[str], slot_ms: int):
        self.order, self.columns, self.slot_ms = list(order), columns, slot_ms
        self.made = Row(*out)
        self.at = {c: k for k, c in enumerate(columns.names)}

    def open(self, handle: StatefulProcessorHandle) -> None:
        """Declare the operator's own state."""
        raise NotImplementedError

    def step(self, rows: list[tuple]) -> Iterable[tuple[tuple, object]]:
        """For rows in order those that come out, each with what the operator adds."""
        raise NotImplementedError

    def in_order(self, rows: Iterable[tuple]) -> list[tuple]:
        """The rows of a key that :meth:`step` needs."""
        return sorted(rows, key=self._place)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        if self.slot_ms:
            # Packed rows of a slot, numbered; how many entries each slot has and the time of its first row.
            kind = lambda **names: T.StructType([T.StructField(c, t) for c, t in names.items()])
            self.waiting = handle.getMapState("blocks", kind(slot=T.LongType(), nth=T.LongType()), kind(rows=T.BinaryType()))
            longs = T.ArrayType(T.LongType())
            self.slots = handle.getValueState("slots", kind(slot=longs, n=longs, first=longs))
        self.open(handle)

    def _place(self, row: tuple) -> list:
        """Sort key: missing order columns come first."""
        return [(row[k] is not None, 0 if row[k] is None else row[k]) for k in map(self.at.__getitem__, self.order)]

    def _out(self, key: tuple, rows: Iterable[tuple]) -> Iterator[Row]:
        for r, added in self.step(self.in_order(rows)):
            yield self.made(*key, *r, added)

    def _kept(self, rows: Iterator[Row]) -> Iterator[tuple[tuple, tuple]]:
        """Each whole row and its kept columns, both as plain tuples."""
        places = None
        for row in rows:
            places = places or [row.__fields__.index(c) for c in self.columns.names]
            whole = tuple(row)
            yield row, tuple([whole[k] for k in places])

    def _slots(self) -> dict[int, list[int]]:
        return {s: [n, first] for s, n, first in zip(*self.slots.get(), strict=True)} if self.slots.exists() else {}

    def _put(self, found: dict[int, list[int]], slot: int, rows: list[tuple[int, tuple]]) -> None:
        """Let the rows of a slot, each with its time, wait."""
        known = found.setdefault(slot, [0, rows[0][0]])
        for a in range(0, len(rows), BLOCK_ROWS):
            self.waiting.updateValue((slot, known[0]), (pickle.dumps(rows[a : a + BLOCK_ROWS], protocol=4),))
            known[0] += 1
        known[1] = min(known[1], min(at for at, _ in rows))

    def _store(self, found: dict[int, list[int]], timer: int | None) -> None:
        """Store the slots, and move the key's timer from ``timer`` to the first waiting row."""
        if not found:
            self.slots.clear()
            return
        order = sorted(found)
        self.slots.update((order, [found[s][0] for s in order], [found[s][1] for s in order]))
        due = found[order[0]][1]
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if not self.slot_ms:
            yield from self._out(key, (kept for _, kept in self._kept(rows)))
            return
        found = self._slots()
        timer = found[min(found)][1] if found else None
        held: dict[int, list] = {}
        size = 0
        for row, kept in self._kept(rows):
            at = row[_AT]
            held.setdefault(at // self.slot_ms, []).append((at, kept))
            size += 1
            if size == HELD_ROWS:
                for slot, some in held.items():
                    self._put(found, slot, some)
                held, size = {}, 0
        for slot, some in held.items():
            self._put(found, slot, some)
        self._store(found, timer)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """All rows that the watermark has passed, slot by slot."""
        watermark = timerValues.getCurrentWatermarkInMs()
        found = self._slots()
        for slot in sorted(found):
            n, first = found[slot]
            if first > watermark:
                break
            rows = []
            for k in range(n):
                rows += pickle.loads(self.waiting.getValue((slot, k))[0])
                self.waiting.removeKey((slot, k))
            del found[slot]
            later = [r for r in rows if r[0] > watermark]
            if later:
                self._put(found, slot, later)
            yield from self._out(key, [r for at, r in rows if at <= watermark])
        self._store(found, None)  # the timer that has expired goes by itself

    def close(self) -> None:
        pass


class _FirstN(_Ordered):
    def __init__(self, n: int, ttl_ms: int | None, *args):
        super().__init__(*args)
        self.n, self.ttl_ms = n, ttl_ms

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.taken = handle.getValueState("taken", T.StructType([T.StructField("n", T.LongType())]), self.ttl_ms)

    def in_order(self, rows: Iterable[tuple]) -> list[tuple]:
        """Only the first rows that are still wanted, so that no more are held at a time."""
        taken = self.taken.get()[0] if self.taken.exists() else 0
        return heapq.nsmallest(self.n - taken, rows, key=self._place) if taken < self.n else []

    def step(self, rows: list[tuple]) -> Iterable[tuple[tuple, object]]:
        taken = self.taken.get()[0] if self.taken.exists() else 0
        if rows:
            self.taken.update((taken + len(rows),))
        for k, r in enumerate(rows, taken + 1):
            yield r, k


class _EveryNth(_Ordered):
    def __init__(self, n: int, *args):
        super().__init__(*args)
        self.n = n

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("n", T.LongType())]))

    def step(self, rows: list[tuple]) -> Iterable[tuple[tuple, object]]:
        seen = self.seen.get()[0] if self.seen.exists() else 0
        for k, r in enumerate(rows, seen + 1):
            if k % self.n == 0:
                yield r, k
        if rows:
            self.seen.update((seen + len(rows),))


class _Adwin(_Ordered):
    def __init__(self, column: str, rule: Rule, *args):
        super().__init__(*args)
        self.column, self.rule = column, rule

    def open(self, handle: StatefulProcessorHandle) -> None:
        number = lambda *names: T.StructType([T.StructField(c, T.DoubleType()) for c in names])
        # One entry per bucket, oldest first; how many buckets there are on each level, and the rows since the last look.
        self.buckets = handle.getListState("buckets", number("n", "total", "m2"))
        self.shape = handle.getValueState("shape", T.StructType([T.StructField("counts", T.ArrayType(T.IntegerType())), T.StructField("wait", T.IntegerType())]))

    def step(self, rows: list[tuple]) -> Iterable[tuple[tuple, object]]:
        values = [r[self.at[self.column]] for r in rows]
        known = [k for k, x in enumerate(values) if x is not None and not np.isnan(x)]
        drift = set()
        if known:
            x = np.array([float(values[k]) for k in known])
            shift = float(x.mean())
            window, wait = Window.empty(), 0
            if self.shape.exists():
                counts, wait = self.shape.get()
                old = np.array([tuple(b) for b in self.buckets.get()], dtype=float).reshape(-1, 3)
                window = Window(tuple(counts), np.r_[np.zeros((1, 3)), np.cumsum(_centred(*old.T, shift), axis=0)])
            cuts, window = walk(_centred(np.ones(len(x)), x, np.zeros(len(x)), shift), window, wait, self.rule)
            drift = {known[c] for c in cuts}
            self.buckets.put([tuple(map(float, b)) for b in _plain(window, shift)])
            self.shape.update((list(window.counts), (wait + len(x)) % self.rule.every))
        for k, r in enumerate(rows):
            yield r, int(k in drift)


def _keyed(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    delay: str | None,
    added: str,
    make: Callable[..., _Ordered],
    ttl_ms: int | None = None,
) -> DataFrame:
    """Run the processor that ``make`` gives over the keys ``series``."""
    use_state_store(df.sparkSession)
    series, order = list(series), list(order)
    if not series:
        return _keyed(df.withColumn("__one", F.lit(0)), ["__one"], order, delay, added, make, ttl_ms).drop("__one")
    if delay and ttl_ms:
        raise ValueError("state expires by processing time, rows wait by event time: one of both")
    columns = T.StructType([df.schema[c] for c in df.columns if c not in series])
    out = T.StructType([*[df.schema[c] for c in series], *columns, *T.StructType.fromDDL(added)])
    if not delay:
        processor = make(order, columns, out.names, 0)
        return df.groupBy(*series).transformWithState(processor, out, "append", "ProcessingTime" if ttl_ms else "None")
    at = F.unix_millis(F.col(order[0]).cast("timestamp"))
    whole = df.sparkSession.range(1).select(F.unix_millis(F.timestamp_millis(F.lit(0)) + F.expr(f"interval {delay}"))).first()[0]
    processor = make(order, columns, out.names, max(1, whole // SLOTS))
    rows = df.where(F.col(order[0]).isNotNull()).withColumn(_AT, at).withWatermark(order[0], delay)
    return rows.groupBy(*series).transformWithState(processor, out, "append", "EventTime")


def first_per_key(
    df: DataFrame, series: Sequence[str], order: Sequence[str], n: int, delay: str | None = None, ttl_ms: int | None = None
) -> DataFrame:
    """The first ``n`` rows of each key of a stream, with their number in ``nth``.

    With ``ttl_ms`` a key that has had no row taken for that long (processing time) starts anew; as time goes on without rows, such a
    query never ends by itself and needs an interval (``every``). A key that has its rows keeps one number of state.
    """
    return _keyed(df, series, order, delay, "nth long", lambda *a: _FirstN(n, ttl_ms, *a), ttl_ms)


def take_per_key(
    df: DataFrame, series: Sequence[str], order: Sequence[str], n: int, wanted: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> int:
    """Store the first ``n`` rows of each key of a stream below ``path`` and stop when every key of ``wanted`` has them.

    The rows taken so far are counted after each micro-batch that brought some: at most ``n`` for each key.
    Returns how many keys of ``wanted`` are still short, which may be when the stream ends first.
    """
    full = threading.Event()
    write = append_batch_to_table(path)

    def short(spark: SparkSession) -> int:
        counts = spark.read.parquet(f"{path}/batch_id=*").groupBy(*series).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= n)
        return join_same(wanted.select(*series).distinct(), counts, list(series), "left_anti").count()

    def take(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if not short(batch.sparkSession):
            full.set()

    query = start(first_per_key(df, series, order, n), checkpoint, take, every=every)
    while query.isActive and not full.wait(0.2):
        pass
    if full.is_set():
        query.stop()
    else:
        drain(query)
    return short(df.sparkSession)


def every_nth_per_key(df: DataFrame, series: Sequence[str], order: Sequence[str], n: int, delay: str | None = None) -> DataFrame:
    """Rows number n, 2n, 3n, ... of each key of a stream, with their number in ``nth``."""
    return _keyed(df, series, order, delay, "nth long", lambda *a: _EveryNth(n, *a))


def adwin_per_key(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    column: str,
    delay: str | None = None,
    delta: float = 0.002,
    clock: int = 32,
    max_buckets: int = 5,
    min_window: int = 5,
    grace: int = 10,
) -> DataFrame:
    """Adaptive windowing row by row; ``drift_detected`` is 1 on the row that cuts the window. The buckets are a list state."""
    rule = Rule(delta, clock, max_buckets, min_window, grace)
    return _keyed(df, series, order, delay, "drift_detected int", lambda *a: _Adwin(column, rule, *a))
