"""Adaptive windowing drift test (Bifet & Gavaldà 2007)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.parsing import no_nan
from ...session import write_scratch
from ..ordered import broadcast_small, join_same, with_rank
from .drift_walk import CHUNK_ITEMS, Rule, walk_series


@dataclass
class AdaptiveWindow:
    """Window of recent values as an exponential histogram of (n, sum, m2) buckets.

    ``m2`` is the sum of squared deviations inside a bucket. ``rows[i]`` holds the
    buckets made of 2**i inserted items, newest last; a row with more than
    ``max_buckets`` merges its two oldest into the next row. The whole state is a few
    numbers per power of two, so it fits a state store row.
    """

    delta: float = 0.002
    clock: int = 32
    max_buckets: int = 5
    min_window: int = 5
    grace: int = 10
    rows: list[list[list[float]]] = field(default_factory=lambda: [[]])
    seen: int = 0
    since_check: int = 0

    def _merge(self, a: Sequence[float], b: Sequence[float]) -> list[float]:
        n = a[0] + b[0]
        gap = a[1] / a[0] - b[1] / b[0]
        return [n, a[1] + b[1], a[2] + b[2] + gap * gap * a[0] * b[0] / n]

    def add(self, n: float, total: float, m2: float = 0.0) -> bool:
        """Insert one item (a value, or a block of values); True if drift is found."""
        self.rows[0].append([n, total, m2])
        level = 0
        while len(self.rows[level]) > self.max_buckets:
            if level + 1 == len(self.rows):
                self.rows.append([])
            first, second = self.rows[level][:2]
            del self.rows[level][:2]
            self.rows[level + 1].append(self._merge(first, second))
            level += 1
        self.seen += int(n)
        self.since_check += int(n)
        if self.since_check < self.clock:
            return False
        self.since_check = 0
        return self._shrink()

    def _oldest_first(self) -> list[list[float]]:
        return [b for row in reversed(self.rows) for b in row]

    def _shrink(self) -> bool:
        drift = False
        while self._has_cut():
            drift = True
            for row in reversed(self.rows):
                if row:
                    del row[0]
                    break
            while len(self.rows) > 1 and not self.rows[-1]:
                self.rows.pop()
        return drift

    def _has_cut(self) -> bool:
        buckets = self._oldest_first()
        if len(buckets) < 2:
            return False
        whole = buckets[0]
        for b in buckets[1:]:
            whole = self._merge(whole, b)
        n, total = whole[0], whole[1]
        if n <= self.grace:
            return False
        variance = whole[2] / n
        spread = math.log(2 * math.log(n) / self.delta)
        n0 = s0 = 0.0
        for b in buckets[:-1]:
            n0, s0 = n0 + b[0], s0 + b[1]
            n1 = n - n0
            if n1 < self.min_window:
                break
            if n0 < self.min_window:
                continue
            harmonic = 1 / (n0 - self.min_window + 1) + 1 / (n1 - self.min_window + 1)
            bound = math.sqrt(2 * harmonic * variance * spread) + 2 / 3 * harmonic * spread
            if abs(s0 / n0 - (total - s0) / n1) > bound:
                return True
        return False


def adwin_blocks(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    column: str,
    block_rows: int,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Consecutive readings of a series summed up in blocks: ``n, total, m2, end``.

    Blocks are made with partial aggregation; ``end`` is the order key of the last row.
    """
    known = df.select(*series, *order, no_nan(column).alias("__x")).where("__x is not null")
    ranked = with_rank(known, series, order, "__rank", chunk_rows)
    block = F.floor((F.col("__rank") - 1) / block_rows).alias("block")
    return ranked.groupBy(*series, block).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.sum("__x").alias("total"),
        (F.var_pop("__x") * F.count(F.lit(1))).alias("m2"),
        F.max(F.struct(*order)).alias("end"),
    )


def adwin(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    column: str,
    delta: float = 0.002,
    clock: int = 32,
    max_buckets: int = 5,
    min_window: int = 5,
    grace: int = 10,
    block_rows: int | None = None,
    chunk_rows: int | None = None,
    chunk_blocks: int | None = None,
) -> DataFrame:
    """Add ``drift_detected``: 1 on the row at which the test cuts its window, else 0.

    The test is sequential, and looks for a cut every ``clock`` rows. So rows are first
    summed in blocks of ``block_rows`` by all tasks: by default one clock step each, whatever the size of the table.
    A window that would cut between two rows of a block cuts at its border instead;
    ``block_rows=1`` walks single rows and equals the streaming twin. The blocks of a series are walked in
    chunks of ``chunk_blocks`` by all tasks (:mod:`.drift_walk`), with the cuts of one walk from end to end.
    """
    series, order = list(series), list(order)
    if not series:
        flagged = adwin(
            df.withColumn("__one", F.lit(0)), ["__one"], order, column, delta, clock, max_buckets,
            min_window, grace, block_rows, chunk_rows, chunk_blocks,
        )
        return flagged.drop("__one")
    rule = Rule(delta, clock, max_buckets, min_window, grace, block_rows or clock)
    blocks = write_scratch(adwin_blocks(df, series, order, column, rule.block_rows, chunk_rows), "blocks")
    found, _ = walk_series(blocks.withColumnRenamed("block", "item"), series, rule, chunk_items=chunk_blocks or CHUNK_ITEMS)
    # Back to rows: a drifting block is marked by the key of its last row.
    ends = join_same(found.withColumnRenamed("item", "block"), blocks.select(*series, "block", "end"), [*series, "block"], "inner")
    ends = ends.select(*series, "end.*", F.lit(1).alias("__drift"))
    out = join_same(df, broadcast_small(ends), [*series, *order])
    return out.withColumn("drift_detected", F.coalesce("__drift", F.lit(0))).drop("__drift")
