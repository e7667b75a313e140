"""Isolation forest (Liu, Ting & Zhou 2008).

Trees are built on small samples by one task each and kept as a table of nodes; the
table (trees x at most twice the sample size) is what scoring ships to the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..quality import drop_incomplete

_EULER = 0.5772156649015329  # fixed value: Euler–Mascheroni constant
NODE_SCHEMA = "tree int, node int, feature int, split double, left int, right int, size int, depth int"


def path_correction(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, dtype="float64")
    big = 2 * (np.log(np.maximum(n - 1, 1)) + _EULER) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


@dataclass
class IsolationForest:
    """Node table, its features, and the score above which a row is an anomaly."""

    nodes: DataFrame
    columns: list[str]
    sample_rows: int
    threshold: float | None = None

    def save(self, path: str) -> None:
        meta = {"columns": self.columns, "sample_rows": self.sample_rows, "threshold": self.threshold}
        spark = self.nodes.sparkSession
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame(
            [meta], "columns array<string>, sample_rows int, threshold double"
        ).write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> IsolationForest:
        meta = spark.read.parquet(f"{path}/meta").first()
        return IsolationForest(
            spark.read.parquet(f"{path}/nodes"), list(meta.columns), meta.sample_rows, meta.threshold
        )


def _grow(points: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes of one tree as (node, feature, split, left, right, size, depth)."""
    nodes: list[tuple] = []
    todo = [(0, np.arange(len(points)), 0)]
    next_id = 1
    while todo:
        node, idx, depth = todo.pop()
        part = points[idx]
        lo, hi = part.min(axis=0), part.max(axis=0)
        open_axes = np.flatnonzero(hi > lo)
        if depth >= limit or len(idx) < 2 or not len(open_axes):
            nodes.append((node, -1, 0.0, -1, -1, len(idx), depth))
            continue
        axis = int(rng.choice(open_axes))
        split = float(rng.uniform(lo[axis], hi[axis]))
        below = part[:, axis] <= split
        if below.all() or not below.any():
            split = float((lo[axis] + hi[axis]) / 2)
            below = part[:, axis] <= split
        nodes.append((node, axis, split, next_id, next_id + 1, len(idx), depth))
        todo += [(next_id, idx[below], depth + 1), (next_id + 1, idx[~below], depth + 1)]
        next_id += 2
    return nodes


def iforest_fit(
    df: DataFrame,
    id_column: str,
    columns: Sequence[str],
    trees: int = 100,
    sample_rows: int = 256,
    seed: int = 42,
    contamination: float | None = 0.05,
) -> IsolationForest:
    """Grow ``trees`` trees on ``sample_rows`` rows each.

    Rows are sampled by a hash of their id, so a retried task draws the same rows. A
    pool of up to trees x sample_rows rows is a top-k over the table; it goes to all tasks, and every tree draws
    its rows from it by a seed of its own.
    ``contamination`` sets the score threshold to that upper quantile of the train scores.
    """
    columns = list(columns)
    whole = drop_incomplete(df, columns)
    features = [F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(columns)]
    rows = whole.select(F.col(id_column).alias("__id"), *features)
    draw = F.xxhash64(F.lit(seed), F.col("__id"))
    wanted = trees * sample_rows
    pool = rows.orderBy(draw, "__id").limit(wanted).drop("__id").toArrow()
    points = np.stack([pool.column(c).to_numpy() for c in rows.columns[1:]], axis=1) if pool.num_rows else np.zeros((0, len(columns)))
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(points)
    limit = math.ceil(math.log2(max(sample_rows, 2)))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for tree in pdf["id"].tolist():
                rng = np.random.default_rng([seed, tree])
                drawn = rng.permutation(len(shared.value))[:sample_rows]
                nodes = _grow(shared.value[drawn], rng, limit) if len(drawn) else []
                out = pd.DataFrame(nodes, columns=["node", "feature", "split", "left", "right", "size", "depth"])
                yield out.assign(tree=tree)[["tree", "node", "feature", "split", "left", "right", "size", "depth"]]

    grown = spark.range(0, trees, 1, min(trees, spark.sparkContext.defaultParallelism)).mapInPandas(build, NODE_SCHEMA)
    # The model is small by construction; fixing it here keeps later scores the same.
    model = grown.toPandas()
    used = int(model.loc[model["node"] == 0, "size"].max()) if len(model) else 0
    forest = IsolationForest(spark.createDataFrame(model, NODE_SCHEMA), columns, used)
    if contamination is not None and used:
        scores = iforest_score(whole.select(*columns), forest)
        forest.threshold = scores.agg(
            F.percentile_approx("anomaly_score", 1 - contamination, 10000)
        ).first()[0]
    return forest


def iforest_score(df: DataFrame, forest: IsolationForest) -> DataFrame:
    """Add ``anomaly_score`` in (0, 1] and, with a threshold, ``anomaly`` 0/1.

    Incomplete rows get a NULL score. All rows of an Arrow batch walk a tree level by level.
    """
    model = forest.nodes.toPandas()
    spark = df.sparkSession
    grown = []
    for _, part in model.groupby("tree"):
        part = part.sort_values("node")
        leaf = part["depth"].to_numpy() + path_correction(part["size"].to_numpy())
        grown.append(
            (
                part["feature"].to_numpy(), part["split"].to_numpy(),
                part["left"].to_numpy(), part["right"].to_numpy(), leaf,
            )
        )
    shared = spark.sparkContext.broadcast(grown)
    norm = float(path_correction(forest.sample_rows)) or 1.0
    columns = forest.columns

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for pdf in batches:
            x = pdf.to_numpy(dtype="float64")
            known = ~np.isnan(x).any(axis=1)
            pts = x[known]
            depth = np.zeros(len(pts))
            for feature, split, left, right, leaf in shared.value:
                at = np.zeros(len(pts), dtype="int64")
                walking = np.flatnonzero(feature[at] >= 0)
                while len(walking):
                    node = at[walking]
                    below = pts[walking, feature[node]] <= split[node]
                    at[walking] = np.where(below, left[node], right[node])
                    walking = walking[feature[at[walking]] >= 0]
                depth += leaf[at]
            out = np.full(len(x), np.nan)
            out[known] = np.power(2.0, -depth / max(len(shared.value), 1) / norm)
            yield pd.Series(out).where(pd.Series(known), None)

    packed = F.struct(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(columns)])
    out = df.withColumn("anomaly_score", F.nanvl(score(packed), F.lit(None).cast("double")))
    if forest.threshold is None:
        return out
    return out.withColumn("anomaly", F.when(F.col("anomaly_score") > forest.threshold, 1).otherwise(0))
