"""Detectors with memory of the whole past: CUSUM and exponential averages.

Both recursions are rewritten as window expressions inside a chunk of the series
plus one carried value per chunk (see :mod:`sensorloom.operators.ordered`), so a
long series is worked on by many tasks and stays inside whole-stage code.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ...functions.parsing import flag, no_nan
from ..ordered import Chunked, chunked, with_lookback

#: What counts as equal to a limit, as running sums of a million readings are off by some 1e-9.
ROUNDING = 1e-8


def cusum(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    column: str,
    mean: float,
    sd: float,
    k: float = 0.5,
    h: float = 5.0,
    chunk_rows: int | None = None,
    start: tuple[str, str] | None = None,
) -> DataFrame:
    """Two-sided CUSUM (Page 1954) as ``cusum_pos``, ``cusum_neg`` and ``alarm``.

    ``start`` names two columns that are set on a row standing for the past of its series: its
    sums so far.

    S(t) = max(0, S(t-1) + z(t) - k) equals P(t) + max(S_in, -min P) where P is the
    running sum of z - k since the chunk began and S_in the value carried into it.
    A missing reading leaves the state as it is and gets NULL scores, alarm 0. An alarm needs a sum above
    ``h`` by more than running sums are off by (ROUNDING of ``h`` and one step), so that a sum of just ``h`` is none.
    """
    c = chunked(df, series, order, chunk_rows)
    z = (no_nan(column) - F.lit(mean)) / F.lit(sd)
    upto = c.window().rowsBetween(Window.unboundedPreceding, 0)
    past = [F.col(x) for x in start] if start else [F.lit(None).cast("double")] * 2
    rows = c.df.select(
        "*",
        F.coalesce(past[0], z - k, F.lit(0.0)).alias("__up"),
        F.coalesce(past[1], -z - k, F.lit(0.0)).alias("__down"),
    )
    sides = {"__up": "cusum_pos", "__down": "cusum_neg"}
    rows = rows.select("*", *[F.sum(s).over(upto).alias(f"{s}_p") for s in sides])
    rows = rows.select("*", *[F.min(f"{s}_p").over(upto).alias(f"{s}_m") for s in sides])
    if c.split:
        rows = _carry_cusum(c, rows, list(sides))
    carried = lambda s: F.coalesce(F.col(f"{s}_in"), F.lit(0.0)) if c.split else F.lit(0.0)
    known = z.isNotNull() | past[0].isNotNull()
    score = lambda s: F.when(
        known, F.col(f"{s}_p") + F.greatest(carried(s), -F.col(f"{s}_m"))
    )
    out = rows.select(*c.df.columns, *[score(s).alias(n) for s, n in sides.items()])
    out = out.withColumn("alarm", flag(F.greatest("cusum_pos", "cusum_neg") > h + ROUNDING * (abs(h) + 1)))
    return c.finish(out)


def _carry_cusum(c: Chunked, rows: DataFrame, sides: list[str]) -> DataFrame:
    """State entering each chunk.

    A chunk maps S to max(S + A, B); composing the maps over the chunks before gives
    C + max(0, max(B - C)) with C the running sum of A.
    """
    maps = rows.groupBy(*c.keys).agg(
        *[F.sum(s).alias(f"{s}_a") for s in sides],
        *[(F.sum(s) - F.min(f"{s}_p")).alias(f"{s}_b") for s in sides],
    )
    upto = Window.partitionBy(*c.series).orderBy(c.keys[-1]).rowsBetween(Window.unboundedPreceding, 0)
    maps = maps.select("*", *[F.sum(f"{s}_a").over(upto).alias(f"{s}_c") for s in sides])
    maps = c.before(
        maps,
        {f"{s}_in": F.last(f"{s}_c") for s in sides}
        | {f"{s}_t": F.max(F.col(f"{s}_b") - F.col(f"{s}_c")) for s in sides},
    )
    state = maps.select(
        *c.keys,
        *[(F.col(f"{s}_in") + F.greatest(F.lit(0.0), F.col(f"{s}_t"))).alias(f"{s}_in") for s in sides],
    )
    return c.attach(rows, state)


def ewma_lag1(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    column: str,
    alpha: float = 0.2,
    name: str = "ewma",
    chunk_rows: int | None = None,
) -> DataFrame:
    """alpha·x + (1-alpha)·previous x; the first row, and a row after NULL, is x."""

    def blend(w) -> Column:
        before = F.lag(column).over(w)
        return F.when(before.isNull(), F.col(column)).otherwise(
            alpha * F.col(column) + (1 - alpha) * before
        )

    return with_lookback(df, series, order, 1, {name: blend}, chunk_rows)


def ewma(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    column: str,
    alpha: float = 0.2,
    name: str = "ewma",
    chunk_rows: int | None = None,
) -> DataFrame:
    """Recursive average e(t) = alpha·x(t) + (1-alpha)·e(t-1), e(first) = x(first).

    A missing reading leaves the average as it is and gets NULL.

    A chunk is cut into cells short enough for (1-alpha)^-n to stay a plain double;
    inside a cell the recursion is one scaled running sum. A full cell dampens what
    came before it by about 1e-100, so two cells back is beyond double precision.
    """
    if not 0 < alpha <= 1:
        raise ValueError("alpha must be in (0, 1]")
    keep = 1 - alpha
    cell_rows = 1 if keep == 0 else max(1, math.floor(230 / -math.log(keep)))
    c = chunked(df, series, order, chunk_rows)
    x = no_nan(column)
    upto = c.window().rowsBetween(Window.unboundedPreceding, 0)
    rows = c.df.select(
        "*",
        x.alias("__x"),
        F.count(x).over(upto).alias("__i"),
        F.first(x, ignorenulls=True).over(upto).alias("__first"),
    )
    rows = rows.withColumns(
        {
            "__cell": F.floor((F.greatest(F.col("__i"), F.lit(1)) - 1) / cell_rows),
            "__j": F.pmod(F.greatest(F.col("__i"), F.lit(1)) - 1, F.lit(cell_rows)),
        }
    )
    decay = lambda n: F.pow(F.lit(float(keep)), n.cast("double"))
    in_cell = Window.partitionBy(*c.keys, "__cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    if keep == 0:
        local = F.col("__x")
    else:
        local = decay(F.col("__j")) * F.sum(alpha * F.col("__x") * decay(-F.col("__j"))).over(in_cell)
    rows = rows.withColumn("__local", F.coalesce(local, F.lit(0.0)))
    # Values at the end of the one and two cells before, if the chunk has them.
    by_cell = Window.partitionBy(*c.keys).orderBy("__cell")
    cell_last = Window.partitionBy(*c.keys, "__cell").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    rows = rows.withColumn("__end", F.last("__local").over(cell_last))
    rows = rows.select(
        "*",
        F.max("__end").over(by_cell.rangeBetween(-1, -1)).alias("__b1"),
        F.max("__end").over(by_cell.rangeBetween(-2, -2)).alias("__b2"),
    )
    if c.split:
        rows = _carry_ewma(c, rows, keep)
        start = F.coalesce("__in", "__first")
    else:
        start = F.col("__first")
    before = F.coalesce("__b1", F.lit(0.0)) + decay(F.lit(cell_rows)) * F.coalesce("__b2", F.lit(0.0))
    value = F.col("__local") + decay(F.col("__j") + 1) * before + decay(F.col("__i")) * start
    out = rows.select(*c.df.columns, F.when(F.col("__x").isNotNull(), value).alias(name))
    return c.finish(out)


def _carry_ewma(c: Chunked, rows: DataFrame, keep: float) -> DataFrame:
    """Average entering each chunk: fold e -> keep^n·e + b over the chunks before.

    One short group per series (a row per chunk, bounded by the cuts) is folded in order.
    """
    end = F.struct(*c.order)
    last_value = F.max_by(
        F.col("__local")
        + F.pow(F.lit(float(keep)), (F.col("__j") + 1).cast("double")) * F.coalesce("__b1", F.lit(0.0)),
        end,
    )
    maps = rows.groupBy(*c.keys).agg(
        F.max("__i").alias("n"), last_value.alias("b"), F.max_by("__first", end).alias("first")
    )
    keys = c.keys

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(keys[-1])
        state, entering = None, []
        for n, b, first in zip(pdf["n"], pdf["b"], pdf["first"]):
            entering.append(state)
            if n > 0:
                state = keep ** float(n) * (first if state is None else state) + b
        return pdf[keys].assign(__in=pd.Series(entering, index=pdf.index, dtype="float64"))

    kinds = dict(maps.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", __in double"
    carried = maps.groupBy(*c.series).applyInPandas(fold, schema=schema)
    carried = carried.withColumn("__in", F.nanvl("__in", F.lit(None).cast("double")))
    return c.attach(rows, carried)
