"""Exact distances to the nearest neighbours inside groups of any size.

A group, such as a micro-batch or a day, is cut into cells by the splits of a k-d tree that a bounded sample gives; no cell
depends on the others, so that no task holds a group. Equal points are one point with a weight, so that
copies, however many, never fill a cell.

A point's neighbours inside its own cell bound how far its true neighbours can be. Where that ball crosses into other
cells, the point is sent there, and only there; the neighbours found in all of them are the exact ones. Where a cell
holds fewer points than asked for, the nearest points of the sample give the bound.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...session import write_scratch
from ..ordered import join_same
from ..quality import drop_incomplete

#: Points of a cell as the sample expects it, and points of the sample that splits come from.
CELL_POINTS = 2000
SAMPLE_POINTS = 200_000
_TILE = 512


class Splits:
    """The splits of one group: a binary tree over the axes, whose leaves are the cells."""

    def __init__(self, sample: np.ndarray, cells: int):
        #: By node: axis and value, and its two children; a cell has axis -1 and its number in ``value``.
        self.axis: list[int] = []
        self.value: list[float] = []
        self.low: list[int] = []
        self.high: list[int] = []
        self.cells = 0
        self._grow(sample, cells)

    def _grow(self, sample: np.ndarray, cells: int) -> int:
        node = len(self.axis)
        self.axis.append(-1)
        self.value.append(float(self.cells))
        self.low.append(-1)
        self.high.append(-1)
        spread = np.ptp(sample, axis=0) if len(sample) > 1 else np.zeros(1)
        axis = int(np.argmax(spread))
        if cells > 1 and spread[axis] > 0:
            values = np.sort(sample[:, axis])
            cut = values[len(values) // 2]
            if cut == values[0]:  # Points at the cut lie above it: some must lie below.
                cut = values[np.searchsorted(values, cut, side="right")]
            below = sample[:, axis] < cut
            self.axis[node], self.value[node] = axis, float(cut)
            self.low[node] = self._grow(sample[below], cells // 2)
            self.high[node] = self._grow(sample[~below], cells - cells // 2)
        else:
            self.cells += 1
        return node

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(x) for x in (self.axis, self.value, self.low, self.high))


def cell_of(splits: tuple[np.ndarray, ...], points: np.ndarray) -> np.ndarray:
    """The cell of each point."""
    axis, value, low, high = splits[:4]
    node = np.zeros(len(points), np.int64)
    while True:
        inner = np.flatnonzero(axis[node] >= 0)
        if not len(inner):
            return value[node].astype(np.int64)
        n = node[inner]
        below = points[inner, axis[n]] < value[n]
        node[inner] = np.where(below, low[n], high[n])


def cells_within(splits: tuple[np.ndarray, ...], points: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(point, cell)`` for every cell that a ball around a point reaches."""
    axis, value, low, high = splits[:4]
    point, node = np.arange(len(points)), np.zeros(len(points), np.int64)
    # A little more than the radius, whose rounding must not hide a point just on it.
    reach = np.where(radius < 0, -1.0, radius**2 * (1 + 1e-12))
    # The squared distance to a node's box grows by one axis at a time; gaps by axis are kept to replace them.
    gaps = np.zeros((len(points), points.shape[1]))
    found = []
    while len(node):
        leaf = axis[node] < 0
        found.append((point[leaf], value[node[leaf]].astype(np.int64)))
        point, node, gaps = point[~leaf], node[~leaf], gaps[~leaf]
        a, v = axis[node], value[node]
        off = points[point, a] - v
        sides = []
        for child, away in ((low, np.maximum(off, 0)), (high, np.maximum(-off, 0))):
            g = gaps.copy()
            rows = np.arange(len(node))
            g[rows, a] = np.maximum(g[rows, a], away)
            near = (g * g).sum(axis=1) <= reach[point]
            sides.append((point[near], child[node[near]], g[near]))
        point, node, gaps = (np.concatenate(x) for x in zip(*sides))
    return tuple(np.concatenate(x) for x in zip(*found))


def _nearest(points: np.ndarray, weights: np.ndarray, asked: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """The distances from each point ``asked`` to the ``k`` nearest of ``points`` by weight, infinite beyond the last.

    ``own`` is the place of an asked point among ``points`` (one of its weight is itself), or -1.
    """
    out = np.full((len(asked), k), np.inf)
    for a in range(0, len(asked), _TILE):
        part, mine = asked[a : a + _TILE], own[a : a + _TILE]
        square = np.zeros((len(part), len(points)))
        for axis in range(points.shape[1]):
            gap = part[:, axis, None] - points[None, :, axis]
            square += gap * gap
        have = np.broadcast_to(weights, square.shape)
        inside = np.flatnonzero(mine >= 0)
        if len(inside):
            have = have.copy()
            have[inside, mine[inside]] -= 1
            # A point alone in its place is no neighbour of itself.
            gone = inside[have[inside, mine[inside]] == 0]
            square[gone, mine[gone]] = np.inf
        some = min(k, len(points))
        near = np.argpartition(square, some - 1, axis=1)[:, :some]
        distance = np.take_along_axis(square, near, axis=1)
        order = np.argsort(distance, axis=1, kind="stable")
        distance = np.sqrt(np.take_along_axis(distance, order, axis=1))
        copies = np.take_along_axis(have, np.take_along_axis(near, order, axis=1), axis=1)
        # The j-th neighbour is the first point up to which more than j rows lie.
        upto = np.cumsum(np.minimum(copies, k), axis=1)
        for j in range(k):
            at = (upto <= j).sum(axis=1)
            full = at < some
            out[a + np.flatnonzero(full), j] = distance[full, at[full]]
    return out


def _splits(points: DataFrame, sizes: DataFrame, columns: Sequence[str], cell_points: int) -> dict[str, tuple[np.ndarray, ...]]:
    """The splits of the groups of more than a cell, from a sample of bounded size over all of them, and that sample."""
    large = {r.group: r.n for r in sizes.where(F.col("n") > cell_points).collect()}
    if not large:
        return {}
    total = sum(large.values())
    some = points.join(sizes.where(F.col("n") > cell_points).select("group"), "group", "left_semi")
    # By a hash, so that a rerun draws the same points.
    share = min(1.0, SAMPLE_POINTS / total)
    draw = F.pmod(F.xxhash64("group", *columns), F.lit(1_000_000)) < int(share * 1_000_000) + 1
    drawn: dict[str, list] = {g: [] for g in large}
    for r in some.where(draw).select("group", *columns).collect():
        drawn[r["group"]].append(tuple(r)[1:])
    samples = {g: np.array(p, float).reshape(-1, len(columns)) for g, p in drawn.items()}
    return {g: (*Splits(samples[g], -(-n // cell_points)).arrays(), samples[g]) for g, n in large.items()}


def nearest_distances(points: DataFrame, columns: Sequence[str], k: int, cell_points: int = CELL_POINTS) -> DataFrame:
    """``group, columns, distances`` for distinct points with a ``weight`` in groups ``group`` (a text).

    ``distances`` are those to the ``k`` nearest other rows of the group, as many as there are.
    """
    spark, columns = points.sparkSession, list(columns)
    points = write_scratch(points.select("group", *columns, "weight"), "points")
    sizes = write_scratch(points.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("rows")), "sizes")
    shared = spark.sparkContext.broadcast(_splits(points, sizes, columns, cell_points))
    kinds = ", ".join(f"`{c}` double" for c in columns)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cell = np.zeros(len(pdf), np.int64)
            for group, at in pdf.groupby("group").indices.items():
                if group in shared.value:
                    cell[at] = cell_of(shared.value[group], pdf[columns].to_numpy(dtype=float)[at])
            yield pdf.assign(cell=cell)

    at_home = points.mapInPandas(placed, f"group string, {kinds}, weight long, cell long")
    at_home = write_scratch(at_home.join(sizes.select("group", "rows"), "group"), "cells")

    def home(pdf: pd.DataFrame) -> pd.DataFrame:
        x, w = pdf[columns].to_numpy(dtype=float), pdf["weight"].to_numpy()
        found = _nearest(x, w, x, np.arange(len(x)), k)
        return pdf[["group", *columns, "rows", "cell"]].assign(distances=list(found))

    schema = f"group string, {kinds}, rows long, cell long, distances array<double>"
    bounded = write_scratch(at_home.groupBy("group", "cell").applyInPandas(home, schema), "bounded")

    def abroad(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A row for each other cell that may hold nearer points."""
        for pdf in batches:
            distances = np.stack(pdf["distances"].to_numpy()) if len(pdf) else np.zeros((0, k))
            out = []
            for group, at in pdf.groupby("group").indices.items():
                if group not in shared.value:
                    continue
                splits, x = shared.value[group], pdf[columns].to_numpy(dtype=float)[at]
                want = np.minimum(k, pdf["rows"].to_numpy()[at] - 1)
                radius = np.where(want > 0, distances[at, np.maximum(want, 1) - 1], -1.0)
                if (few := np.flatnonzero(np.isinf(radius))).size:
                    # The nearest points of the sample but one, which may be the point itself.
                    near = _nearest(splits[4], np.ones(len(splits[4]), np.int64), x[few], np.full(len(few), -1), k + 1)
                    radius[few] = near[np.arange(len(few)), want[few]]
                point, cell = cells_within(splits, x, radius)
                other = cell != pdf["cell"].to_numpy()[at][point]
                out.append(pdf.iloc[at[point[other]]][["group", *columns]].assign(cell=cell[other]))
            yield pd.concat(out) if out else pd.DataFrame(columns=["group", *columns, "cell"])

    asked = bounded.mapInPandas(abroad, f"group string, {kinds}, cell long")

    def guests(key: tuple, home_rows: pd.DataFrame, guest_rows: pd.DataFrame) -> pd.DataFrame:
        x, g = home_rows[columns].to_numpy(dtype=float), guest_rows[columns].to_numpy(dtype=float)
        if not len(g) or not len(x):
            return pd.DataFrame(columns=["group", *columns, "distances"])
        found = _nearest(x, home_rows["weight"].to_numpy(), g, np.full(len(g), -1), k)
        return guest_rows[["group", *columns]].assign(distances=list(found))

    more = asked.groupBy("group", "cell").cogroup(at_home.groupBy("group", "cell"))
    more = more.applyInPandas(lambda key, a, b: guests(key, b, a), f"group string, {kinds}, distances array<double>")
    every = bounded.select("group", *columns, "distances").unionByName(more)
    # A point has its own cell's list and one of each cell that its ball reaches.
    merged = every.groupBy("group", *columns).agg(F.flatten(F.collect_list("distances")).alias("all"))
    finite = F.filter("all", lambda d: d < float("inf"))
    return merged.select("group", *columns, F.slice(F.array_sort(finite), 1, k).alias("distances"))


def knn_score_whole(
    df: DataFrame,
    group: Sequence[str],
    columns: Sequence[str],
    k: int = 5,
    name: str = "knn_score",
    cell_points: int = CELL_POINTS,
) -> DataFrame:
    """Mean distance to the ``k`` nearest other rows of the group, over the group's largest; exact for groups of any size.

    Without ``group`` the whole frame is one. Incomplete rows (NULL or NaN in ``columns``) are dropped. A row alone in its group has a
    NULL score, as have the rows of a group whose largest mean is 0; NULL group keys are a group. Infinite values are refused.
    """
    group, columns = list(group), list(columns)
    rows = drop_incomplete(df, columns)
    names = [f"__x{i}" for i in range(len(columns))]
    # Adding 0 turns -0 into 0, which is the same point.
    rows = rows.withColumns({n: F.col(c).cast("double") + F.lit(0.0) for n, c in zip(names, columns)})
    key = F.to_json(F.struct(*[F.coalesce(F.concat(F.lit("k"), F.col(c).cast("string")), F.lit("")).alias(f"k{i}") for i, c in enumerate(group)], F.lit("").alias("end")))
    rows = write_scratch(rows.withColumn("__group", key), "knn_rows")
    endless = " OR ".join(f"abs({n}) = double('infinity')" for n in names)
    if rows.where(endless).limit(1).count():
        raise ValueError("infinite values have no distances")
    points = rows.groupBy(F.col("__group").alias("group"), *names).agg(F.count(F.lit(1)).alias("weight"))
    found = nearest_distances(points, names, k, cell_points)
    mean = F.aggregate("distances", F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size("distances"), F.lit(0))
    scored = write_scratch(found.select(F.col("group").alias("__group"), *names, mean.alias("__mean")), "knn_means")
    tops = scored.groupBy("__group").agg(F.nullif(F.max("__mean"), F.lit(0.0)).alias("__top"))
    out = join_same(rows, scored, ["__group", *names])
    out = out.join(tops, "__group")
    return out.withColumn(name, F.col("__mean") / F.col("__top")).drop("__group", "__mean", "__top", *names)
