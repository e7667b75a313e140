"""What keyed operators ask of the state store, and what they hold in memory."""

import datetime
import tracemalloc

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

from sensorloom.session import scratch_path
from sensorloom.sinks.tables import read_batches
from sensorloom.sources.tables import stream_files
from sensorloom.streaming import keyed as k
from sensorloom.streaming import runtime as rt

KEPT = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("id", T.LongType())])
START = datetime.datetime(2024, 1, 1)


class Store:
    """The state of one key, its timers, and the number of calls."""

    def __init__(self):
        self.data, self.calls, self.timers = {}, 0, set()

    def __getattr__(self, name):
        def make(state, *_):
            return Part(self, state)

        return make

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)


class Part:
    def __init__(self, store, name):
        self.store, self.name = store, name

    def __getattr__(self, name):
        def call(*a):
            data = self.store.data
            self.store.calls += 1
            if name == "exists":
                return self.name in data
            if name == "get":
                return data[self.name]
            if name == "update":
                data[self.name] = a[0]
            elif name == "clear":
                data.pop(self.name, None)
            elif name == "containsKey":
                return (self.name, a[0]) in data
            elif name == "getValue":
                return data[self.name, a[0]]
            elif name == "updateValue":
                data[self.name, a[0]] = a[1]
            elif name == "removeKey":
                data.pop((self.name, a[0]), None)

        return call


class Now:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at

    def getExpiryTimeInMs(self):
        return self.at


def row(i):
    return Row(series="a", ts=START + datetime.timedelta(milliseconds=i), id=i, __at=i)


def test_waiting_rows_cost_calls_by_slots_and_not_by_rows():
    store = Store()
    op = k._EveryNth(10, ["ts", "id"], KEPT, ["series", "ts", "id", "nth"], 10_000)
    op.init(store)
    n = 40_000
    list(op.handleInputRows(("a",), (row(i * 7919 % n) for i in range(n)), Now(0)))
    assert store.timers == {0} and store.calls < 200
    got = []
    for watermark in (12_344, n):
        for timer in sorted(t for t in store.timers if t <= watermark):
            got += op.handleExpiredTimer(("a",), Now(watermark), Now(timer))
            store.timers.discard(timer)
        assert [r.id for r in got] == list(range(9, min(watermark + 1, n), 10))
    assert [r.nth for r in got] == list(range(10, n + 1, 10))
    assert store.calls < 200 and store.data.keys() == {"seen"} and not store.timers


def test_first_rows_are_picked_without_holding_the_others():
    store = Store()
    op = k._FirstN(5, None, ["ts", "id"], KEPT, ["series", "ts", "id", "nth"], 0)
    op.init(store)
    n = 30_000
    tracemalloc.start()
    got = list(op.handleInputRows(("a",), (row(i * 7919 % n) for i in range(n)), Now(0)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(r.id, r.nth) for r in got] == [(i, i + 1) for i in range(5)]
    assert peak < 1 << 20
    assert not list(op.handleInputRows(("a",), iter([row(0)]), Now(0)))


@pytest.mark.parametrize("minutes", [5])
def test_a_row_at_the_watermark_has_been_passed(spark, minutes):
    rows = [("a", START + datetime.timedelta(minutes=i), i) for i in range(11)]
    folder = scratch_path(spark, "in")
    spark.createDataFrame(rows, "series string, ts timestamp, id long").coalesce(1).write.parquet(folder)
    source = stream_files(spark, folder, spark.read.parquet(folder).schema)
    out = k.every_nth_per_key(source, ["series"], ["ts", "id"], 1, f"{minutes} minutes")
    path = scratch_path(spark, "out")
    rt.drain(rt.stream_to_table(out, path, scratch_path(spark, "ck")), 300)
    assert sorted(r.id for r in read_batches(spark, path, out.schema).collect()) == list(range(11 - minutes))
