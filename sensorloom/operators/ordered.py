"""Row-order operators over series that may hold a large share of all rows.

A window partitioned by series puts a whole series into one task. Here a series
longer than ``chunk_rows`` is cut into contiguous chunks of the row order, every
chunk is worked on in its own task, and what must cross a chunk border (a count,
a sum, the last ``n`` rows, a detector state) travels through a table with one
row per chunk.

How chunks are cut: the rows are dealt by range of (series, order), sorted in each range and
written once, with their place. A chunk is up to ``chunk_rows`` neighbouring rows of one
range and one series, so its number follows from the place alone: no row ever carries a
list of cuts, and any number of chunks costs the same. Sizes come from the written table.
A :class:`Chunked` can be passed on in place of a frame, so that several steps share one
layout. Which rows share a chunk never changes a result.

The order columns must identify a row inside its series (end them with an id).
The input is read more than once when chunks are needed, so it must be
deterministic; :func:`sensorloom.session.write_scratch` makes it so.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import write_scratch

CHUNK_ROWS = 1_000_000
MAX_CHUNKS = 100_000
RANGE_ROWS = 1_000_000

_CHUNK = "__chunk"
_AT = "__at_row"
_ALL = "__all"


def join_same(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which NULL keys match NULL keys; key columns come from ``left``."""
    renamed = right
    for c in on:
        renamed = renamed.withColumnRenamed(c, f"__r_{c}")
    cond = None
    for c in on:
        term = left[c].eqNullSafe(renamed[f"__r_{c}"])
        cond = term if cond is None else cond & term
    return left.join(renamed, cond, how).drop(*[f"__r_{c}" for c in on])


def broadcast_small(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """``df`` written to the shared folder, with a broadcast hint if it has few rows.

    A larger one stays without the hint, and the join shuffles both sides.
    """
    stored = write_scratch(df, "side")
    return F.broadcast(stored) if stored.count() <= rows else stored


@dataclass
class Chunked:
    """Rows with their chunk number, and how to window over them."""

    df: DataFrame
    series: list[str]
    order: list[str]
    split: bool

    @property
    def keys(self) -> list[str]:
        return [*self.series, _CHUNK] if self.split else list(self.series)

    def window(self, descending: bool = False) -> WindowSpec:
        cols = [F.col(c).desc() if descending else F.col(c).asc() for c in self.order]
        return Window.partitionBy(*self.keys).orderBy(*cols)

    def counts(self) -> DataFrame:
        """Per chunk: rows ``__n``, rows of the series before it ``__before``, place of its last row."""
        per_chunk = self.df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("__n"), F.max(_AT).alias("__last"))
        return self.before(per_chunk, {"__before": F.sum("__n")})

    def before(self, per_chunk: DataFrame, folds: dict[str, Column], default: object = 0) -> DataFrame:
        """Fold a per-chunk table over the chunks that precede each chunk."""
        w = (
            Window.partitionBy(*self.series)
            .orderBy(_CHUNK)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        return per_chunk.select(
            "*", *[F.coalesce(c.over(w), F.lit(default)).alias(n) for n, c in folds.items()]
        )

    def attach(self, rows: DataFrame, per_chunk: DataFrame) -> DataFrame:
        """Left-join carried values; only chunks after the first of a series carry any.

        Those are fewer than the chunks of a full ``chunk_rows`` and the ranges together,
        which bounds the broadcast.
        """
        nth = F.row_number().over(Window.partitionBy(*self.series).orderBy(_CHUNK))
        carried = per_chunk.withColumn("__nth", nth).where(F.col("__nth") > 1).drop("__nth")
        return join_same(rows, F.broadcast(carried), self.keys)

    def finish(self, rows: DataFrame, *drop: str) -> DataFrame:
        return rows.drop(_CHUNK, _AT, _ALL, *drop)


def chunked(
    df: DataFrame | Chunked,
    series: Sequence[str],
    order: Sequence[str],
    chunk_rows: int | None = None,
    max_chunks: int = MAX_CHUNKS,
) -> Chunked:
    """Cut long series into chunks; short tables keep one window per series.

    One count per series (partial aggregation, no row moves) decides. ``max_chunks`` bounds
    the tables that carry values from chunk to chunk.
    """
    if isinstance(df, Chunked):
        return df
    series, order = list(series), list(order)
    chunk_rows = chunk_rows or CHUNK_ROWS
    if not series:
        df, series = df.withColumn(_ALL, F.lit(0)), [_ALL]
    sizes = df.groupBy(*series).agg(F.count(F.lit(1)).alias("__n"))
    total, longest = sizes.agg(F.sum("__n"), F.max("__n")).first()
    if (longest or 0) <= chunk_rows:
        return Chunked(df, series, order, False)

    rows_per_chunk = max(chunk_rows, -(-total // max_chunks))
    at_least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(min(at_least, -(-total // rows_per_chunk)), -(-total // RANGE_ROWS))
    dealt = df.repartitionByRange(ranges, *series, *order).sortWithinPartitions(*series, *order)
    # The place of a row: its range in the high bits, its row there in the low 33.
    stored = write_scratch(dealt.withColumn(_AT, F.monotonically_increasing_id()), "chunks")
    row = F.col(_AT).bitwiseAND(F.lit((1 << 33) - 1))
    return Chunked(stored.withColumn(_CHUNK, F.col(_AT) - F.pmod(row, F.lit(rows_per_chunk))), series, order, True)


def with_rank(
    df: DataFrame | Chunked,
    series: Sequence[str],
    order: Sequence[str],
    name: str = "rank",
    chunk_rows: int | None = None,
) -> DataFrame:
    """1-based row number of every row in its series."""
    c = chunked(df, series, order, chunk_rows)
    rows = c.df.withColumn(name, F.row_number().over(c.window()).cast("long"))
    if c.split:
        rows = c.attach(rows, c.counts().drop("__n", "__last"))
        rows = rows.withColumn(name, F.col(name) + F.coalesce(F.col("__before"), F.lit(0)))
    return c.finish(rows, "__before")


def with_running_sum(
    df: DataFrame | Chunked,
    series: Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column],
    chunk_rows: int | None = None,
) -> DataFrame:
    """Running sums from the first row of the series up to each row."""
    c = chunked(df, series, order, chunk_rows)
    w = c.window().rowsBetween(Window.unboundedPreceding, 0)
    rows = c.df.select("*", *[F.sum(e).over(w).alias(n) for n, e in sums.items()])
    if c.split:
        totals = c.df.groupBy(*c.keys).agg(*[F.sum(e).alias(f"__t_{n}") for n, e in sums.items()])
        carried = c.before(totals, {f"__b_{n}": F.sum(f"__t_{n}") for n in sums})
        rows = c.attach(rows, carried.drop(*[f"__t_{n}" for n in sums]))
        rows = rows.withColumns(
            {n: F.col(n) + F.coalesce(F.col(f"__b_{n}"), F.lit(0)) for n in sums}
        )
    return c.finish(rows, *[f"__b_{n}" for n in sums])


def with_lookback(
    df: DataFrame | Chunked,
    series: Sequence[str],
    order: Sequence[str],
    rows_back: int,
    outputs: dict[str, Callable[[WindowSpec], Column]],
    chunk_rows: int | None = None,
) -> DataFrame:
    """Window expressions that look at most ``rows_back`` rows back.

    ``outputs`` maps a column name to a function of the ordered window, such as
    ``lambda w: F.avg("x").over(w.rowsBetween(-49, 0))``. Chunks first receive a
    copy of the ``rows_back`` rows before them, wherever those lie.
    """
    c = chunked(df, series, order, chunk_rows)
    if not c.split:
        w = c.window()
        return c.finish(c.df.select("*", *[f(w).alias(n) for n, f in outputs.items()]))

    counts = c.counts()
    # Only series that were cut have chunks to feed; their chunk table is bounded by the cuts.
    cut_series = counts.where(F.col("__before") > 0).select(*c.series).distinct()
    cut_counts = join_same(counts, F.broadcast(cut_series), c.series, "left_semi")
    # Rows of a chunk lie side by side, so that the last ones follow from their place.
    tail = join_same(c.df, F.broadcast(cut_counts), c.keys, "inner")
    tail = tail.withColumn("__rev", F.col("__last") - F.col(_AT) + 1).where(F.col("__rev") <= rows_back)
    tail = tail.withColumn("__at", F.col("__before") + F.col("__n") - F.col("__rev") + 1)
    # Row number r feeds every chunk that starts after r and within rows_back of it.
    cell = lambda col: F.floor(col / F.lit(rows_back))
    tail = tail.drop("__n", "__before", "__last", _CHUNK).withColumn(
        "__cell",
        F.explode(F.array_distinct(F.array(cell(F.col("__at")), cell(F.col("__at") + rows_back - 1)))),
    )
    starts = counts.where(F.col("__before") > 0).select(
        *c.series, _CHUNK, F.col("__before").alias("__start"), cell(F.col("__before")).alias("__cell")
    )
    halo = join_same(tail, F.broadcast(starts), [*c.series, "__cell"], "inner").where(
        F.col("__start").between(F.col("__at"), F.col("__at") + rows_back - 1)
    )
    halo = halo.select(*c.df.columns, F.lit(True).alias("__halo"))
    both = c.df.withColumn("__halo", F.lit(False)).unionByName(halo)
    w = c.window()
    out = both.select("*", *[f(w).alias(n) for n, f in outputs.items()])
    return c.finish(out.where(~F.col("__halo")), "__halo")


def first_per_series(df: DataFrame, series: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of each series.

    Spark turns ``row_number() <= n`` into a group limit before the shuffle, so a
    long series sends ``n`` rows per task, not all of them.
    """
    w = Window.partitionBy(*series).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def every_nth(
    df: DataFrame, series: Sequence[str], order: Sequence[str], n: int, chunk_rows: int | None = None
) -> DataFrame:
    """Thin each series to its rows number n, 2n, 3n and so on."""
    ranked = with_rank(df, series, order, "__rank", chunk_rows)
    return ranked.where(F.col("__rank") % n == 0).drop("__rank")


def previous_value(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    column: str,
    name: str = "previous",
    chunk_rows: int | None = None,
) -> DataFrame:
    """Value of the row before, NULL on the first row of a series."""
    return with_lookback(
        df, series, order, 1, {name: lambda w: F.lag(column).over(w)}, chunk_rows
    )


def rolling_stats(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    column: str,
    rows: int = 50,
    mean_name: str = "rolling_mean",
    std_name: str = "rolling_std",
    chunk_rows: int | None = None,
) -> DataFrame:
    """Mean and sample deviation of the current row and the ``rows - 1`` before it."""
    return with_lookback(
        df,
        series,
        order,
        rows - 1,
        {
            mean_name: lambda w: F.avg(column).over(w.rowsBetween(-(rows - 1), 0)),
            std_name: lambda w: F.stddev_samp(column).over(w.rowsBetween(-(rows - 1), 0)),
        },
        chunk_rows,
    )
