"""Distance of a row to its nearest neighbours."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..ordered import with_rank
from ..quality import drop_incomplete

_TILE = 256


def _mean_distance(points: np.ndarray, k: int) -> np.ndarray:
    """Mean distance of each point to its k nearest other points (all others if fewer)."""
    n = len(points)
    near = min(k, n - 1)
    if near < 1:
        return np.full(n, np.nan)
    out = np.empty(n)
    for lo in range(0, n, _TILE):
        part = points[lo : lo + _TILE]
        d2 = np.zeros((len(part), n))
        for axis in range(points.shape[1]):
            gap = part[:, axis, None] - points[None, :, axis]
            d2 += gap * gap
        d2[np.arange(len(part)), np.arange(lo, lo + len(part))] = np.inf
        out[lo : lo + _TILE] = np.sqrt(np.partition(d2, near - 1, axis=1)[:, :near]).mean(axis=1)
    return out


def knn_score(
    df: DataFrame,
    order: Sequence[str],
    columns: Sequence[str],
    k: int = 5,
    block_rows: int = 500,
    name: str = "knn_score",
    chunk_rows: int | None = None,
) -> DataFrame:
    """Mean distance to the ``k`` nearest other rows of the block, over the block's largest.

    A block is the batch equivalent of a micro-batch: ``block_rows`` consecutive rows in
    ``order``, so no task ever holds more, and work grows linearly with the table.
    Incomplete rows are dropped. A block whose largest mean is 0 has NULL scores.
    Adds ``block`` and the score.
    """
    rows = with_rank(drop_incomplete(df, columns), [], order, "__rank", chunk_rows)
    rows = rows.withColumn("block", F.floor((F.col("__rank") - 1) / block_rows)).drop("__rank")
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in rows.columns) + f", `{name}` double"

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        mean = _mean_distance(pdf[list(columns)].to_numpy(dtype="float64"), k)
        top = mean.max()
        return pdf.assign(**{name: mean / top if top > 0 else None})

    return rows.groupBy("block").applyInPandas(score, schema=schema)
