"""Streaming twins of the sequential detectors.

Two forms. The ``*_batches`` functions are for ``foreachBatch``: each micro-batch goes through the
batch operator, with one row per series in front that stands for its past, so that a series may
hold any share of a batch; the states after each batch are a small table stored under its number.
A repeated batch starts from the states before it and replaces what it wrote. What a batch writes beside its rows
and states is deleted when it ends, and of the states the last two stay.

The ``*_stream`` functions keep the state in Spark's state store, for low latency and micro-batches
that a rate limit keeps small: there the state of a series (one or two numbers, or the buckets of an adaptive window) lives
in the state store under its key, so it survives restarts and never mixes series or
splits. Inside a micro-batch a series' rows are put in order first; the reader's rate
limit bounds how many there are. Rows must not arrive out of order across batches.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions.parsing import no_nan
from ..operators.detect.cumulative import ROUNDING, cusum, ewma, ewma_lag1
from ..operators.detect.drift import AdaptiveWindow
from ..operators.detect.drift_walk import CHUNK_ITEMS, Rule, walk_series
from ..operators.ordered import join_same, with_rank
from ..session import delete_folder, scratch_scope, write_scratch
from ..sinks.tables import append_batch_to_table

#: States of so many last micro-batches are kept: a repeated batch starts from the one before it.
KEPT_STATES = 2


class _States:
    """A small table of states per micro-batch below ``path``."""

    def __init__(self, path: str, schema: str):
        self.path, self.schema = path, schema

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        if batch_id == 0:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(f"{self.path}/batch_id={batch_id - 1}")

    def store(self, after: DataFrame, series: Sequence[str], batch_id: int) -> None:
        """A series without a state in ``after`` keeps the one it had; older states go."""
        spark = after.sparkSession
        kept = join_same(self.before(spark, batch_id), after.hint("merge"), series, "left_anti").unionByName(after)
        kept.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        if batch_id >= KEPT_STATES:
            delete_folder(spark, f"{self.path}/batch_id={batch_id - KEPT_STATES}")


def _carried(
    path: str,
    series: Sequence[str],
    states: str,
    twin: Callable[[DataFrame], DataFrame],
    after: Callable[[DataFrame], DataFrame],
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function around ``twin``, which gets a batch with the rows of the past in front
    (``__past`` true, its state in the columns of the DDL ``states``, all else of it NULL but the
    series) and returns the results. They are written once; ``after`` takes the states from what was written.
    What the batch writes beside results and states goes when it ends."""
    write = append_batch_to_table(f"{path}/rows")
    names = [x.split()[0] for x in states.split(", ")]

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kinds = dict(batch.dtypes)
        store = _States(f"{path}/states", ", ".join([*[f"`{c}` {kinds[c]}" for c in series], states]))
        with scratch_scope(spark):
            batch.persist()
            try:
                past = store.before(spark, batch_id).withColumn("__past", F.lit(True))
                made = twin(batch.withColumn("__past", F.lit(False)).unionByName(past, allowMissingColumns=True))
                made = made.where("NOT __past").drop("__past", *names)
                write(made, batch_id)
            finally:
                batch.unpersist()
            store.store(after(spark.read.schema(made.schema).parquet(f"{path}/rows/batch_id={batch_id}")), series, batch_id)

    return run


def ewma_batches(path: str, series: Sequence[str], order: Sequence[str], column: str, alpha: float = 0.2, name: str = "ewma"):
    """Recursive exponential average whose state goes on over micro-batches; rows go to ``path/rows``."""
    series, order = list(series), list(order)

    def twin(both: DataFrame) -> DataFrame:
        # The past counts as the first reading; its order key is missing and so comes first.
        rows = both.withColumn("__reading", F.when(F.col("__past"), F.col("__e")).otherwise(F.col(column)))
        return ewma(rows, series, order, "__reading", alpha, name).drop("__reading")

    def after(out: DataFrame) -> DataFrame:
        return out.where(F.col(name).isNotNull()).groupBy(*series).agg(F.max_by(name, F.struct(*order)).alias("__e"))

    return _carried(path, series, "__e double", twin, after)


def ewma_lag1_batches(path: str, series: Sequence[str], order: Sequence[str], column: str, alpha: float = 0.2, name: str = "ewma"):
    """Each reading blended with the one before it, which may lie in an earlier micro-batch; rows go to ``path/rows``."""
    series, order = list(series), list(order)

    def twin(both: DataFrame) -> DataFrame:
        rows = both.withColumn("__reading", F.when(F.col("__past"), F.col("__b")).otherwise(F.col(column)))
        return ewma_lag1(rows, series, order, "__reading", alpha, name).drop("__reading")

    def after(out: DataFrame) -> DataFrame:
        return out.groupBy(*series).agg(F.max_by(F.col(column).cast("double"), F.struct(*order)).alias("__b"))

    return _carried(path, series, "__b double", twin, after)


def cusum_batches(
    path: str, series: Sequence[str], order: Sequence[str], column: str, mean: float, sd: float, k: float = 0.5, h: float = 5.0
):
    """Two-sided CUSUM whose two sums go on over micro-batches; rows go to ``path/rows``."""
    series, order = list(series), list(order)

    def twin(both: DataFrame) -> DataFrame:
        return cusum(both, series, order, column, mean, sd, k, h, start=("__up0", "__down0"))

    def after(out: DataFrame) -> DataFrame:
        sums = F.max_by(F.struct("cusum_pos", "cusum_neg"), F.struct(*order)).alias("__s")
        last = out.where("cusum_pos IS NOT NULL").groupBy(*series).agg(sums)
        return last.select(*series, F.col("__s.cusum_pos").alias("__up0"), F.col("__s.cusum_neg").alias("__down0"))

    return _carried(path, series, "__up0 double, __down0 double", twin, after)


def adwin_batches(
    path: str,
    series: Sequence[str],
    order: Sequence[str],
    column: str,
    delta: float = 0.002,
    clock: int = 32,
    max_buckets: int = 5,
    min_window: int = 5,
    grace: int = 10,
    chunk_rows: int | None = None,
    chunk_items: int = CHUNK_ITEMS,
):
    """Adaptive windowing row by row over micro-batches; rows go to ``path/rows``.

    The rows of a series are numbered, and walked in chunks by all tasks from the window that the batch before left
    (:mod:`..operators.detect.drift_walk`). Rows come back by that number, so that order columns need only be unique inside a
    series; rows without a reading stay and are no drift, rows with missing order keys come first.
    """
    series, order = list(series), list(order)
    rule = Rule(delta, clock, max_buckets, min_window, grace)
    write = append_batch_to_table(f"{path}/rows")
    keys = series or ["__one"]

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch if series else batch.withColumn("__one", F.lit(0))
        kinds = dict(rows.dtypes)
        store = _States(f"{path}/states", ", ".join([*[f"`{c}` {kinds[c]}" for c in keys], "counts array<int>, buckets array<double>, wait int"]))
        with scratch_scope(spark):
            rows = write_scratch(rows, "batch").withColumn("__x", no_nan(column))
            numbered = write_scratch(with_rank(rows.where("__x IS NOT NULL"), keys, order, "__rank", chunk_rows), "numbered")
            items = numbered.select(
                *keys, (F.col("__rank") - 1).alias("item"), F.lit(1.0).alias("n"), F.col("__x").alias("total"), F.lit(0.0).alias("m2")
            )
            found, after = walk_series(items, keys, rule, store.before(spark, batch_id), chunk_items)
            # A cut goes to its row by shuffle: there may be as many as a share of the rows. Rows without a reading stay aside.
            hits = found.select(*keys, (F.col("item") + 1).alias("__rank"), F.lit(1).alias("__hit")).hint("merge")
            made = join_same(numbered, hits, [*keys, "__rank"]).unionByName(rows.where("__x IS NULL"), allowMissingColumns=True)
            made = made.withColumn("drift_detected", F.coalesce("__hit", F.lit(0)))
            write(made.drop("__x", "__rank", "__hit", "__one"), batch_id)
            store.store(after, keys, batch_id)

    return run


def keyed_scan(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    outputs: str,
    step: Callable[[dict | None, pd.DataFrame], tuple[dict, dict[str, Iterable]]],
) -> DataFrame:
    """Run ``step(state, rows)`` over each series in order, carrying the state along.

    ``step`` returns the new state (JSON-serialisable) and the output columns, whose DDL
    is ``outputs``. Result: series, order and ``columns`` of the input, then the outputs.
    """
    kept = list(dict.fromkeys([*series, *order, *columns]))
    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", " + outputs

    def scan(key, batches, state):
        pdf = pd.concat(list(batches)).sort_values(list(order))
        before = json.loads(state.get[0]) if state.exists else None
        after, made = step(before, pdf)
        state.update((json.dumps(after),))
        yield pdf[kept].assign(**made)

    return (
        df.select(*kept)
        .groupBy(*series)
        .applyInPandasWithState(scan, schema, "state string", "append", GroupStateTimeout.NoTimeout)
    )


def ewma_stream(
    df: DataFrame, series: Sequence[str], order: Sequence[str], column: str, alpha: float = 0.2, name: str = "ewma"
) -> DataFrame:
    """Recursive exponential average whose state goes on over micro-batches."""

    def step(state, pdf):
        value = None if state is None else state["e"]
        out = []
        for x in pdf[column].to_numpy(dtype="float64"):
            if np.isnan(x):
                out.append(None)
                continue
            value = x if value is None else alpha * x + (1 - alpha) * value
            out.append(value)
        return {"e": value}, {name: out}

    return keyed_scan(df, series, order, [column], f"`{name}` double", step)


def cusum_stream(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    column: str,
    mean: float,
    sd: float,
    k: float = 0.5,
    h: float = 5.0,
) -> DataFrame:
    """Two-sided CUSUM with two numbers of state per series."""

    def step(state, pdf):
        up, down = (0.0, 0.0) if state is None else state["s"]
        ups, downs, alarms = [], [], []
        for x in pdf[column].to_numpy(dtype="float64"):
            if np.isnan(x):
                ups.append(None)
                downs.append(None)
                alarms.append(0)
                continue
            z = (x - mean) / sd
            up, down = max(0.0, up + z - k), max(0.0, down - z - k)
            ups.append(up)
            downs.append(down)
            alarms.append(int(max(up, down) > h + ROUNDING * (abs(h) + 1)))
        return {"s": [up, down]}, {"cusum_pos": ups, "cusum_neg": downs, "alarm": alarms}

    return keyed_scan(df, series, order, [column], "cusum_pos double, cusum_neg double, alarm int", step)


def adwin_stream(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    column: str,
    delta: float = 0.002,
    clock: int = 32,
    max_buckets: int = 5,
    min_window: int = 5,
    grace: int = 10,
) -> DataFrame:
    """Adaptive windowing row by row; ``drift_detected`` is 1 on the row that cuts the window."""

    def step(state, pdf):
        window = AdaptiveWindow(delta, clock, max_buckets, min_window, grace)
        if state is not None:
            window.rows, window.seen, window.since_check = state["rows"], state["seen"], state["wait"]
        hits = [
            0 if np.isnan(x) else int(window.add(1, float(x)))
            for x in pdf[column].to_numpy(dtype="float64")
        ]
        return (
            {"rows": window.rows, "seen": window.seen, "wait": window.since_check},
            {"drift_detected": hits},
        )

    return keyed_scan(df, series, order, [column], "drift_detected int", step)
