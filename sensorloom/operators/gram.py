"""Correlation of some hundred columns by matrix products.

An expression per pair grows with the square of the columns and ends in one generated method. Here every task adds up
matrix products of its rows, a batch at a time, and sends one row per column; these are added up in two steps, so that no task
holds the sums of all. Missing values leave a row out of the pairs that need them, and out of no others.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import no_nan

#: Sums of a column are added up in so many parts first.
PARTS = 64
_SUMS = ("n", "x", "xx", "xy")


def column_means(df: DataFrame, columns: Sequence[str]) -> list[float]:
    """The mean of each column, 0 for one without values: sums around it lose no digits."""
    row = df.agg(*[F.avg(no_nan(F.col(f"`{c}`"))).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return [0.0 if v is None else float(v) for v in row]


def pair_sums(df: DataFrame, columns: Sequence[str], centre: Sequence[float] | None = None) -> DataFrame:
    """``place, n, x, xx, xy``: for each column its sums with every column, in the order of ``columns``.

    Over the rows that have both values: how many, the column's own sum and sum of squares, and the sum of products, all
    around ``centre`` (the means, unless given). NaN is missing. An empty table has no rows.
    """
    columns = list(columns)
    middle = np.array(column_means(df, columns) if centre is None else centre, dtype=float)
    size = len(columns)
    numbers = df.select(F.array(*[no_nan(F.col(f"`{c}`")) for c in columns]).alias("v"))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, size, size))
        seen = False
        for batch in batches:
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)  # null as NaN
            have = ~np.isnan(v)
            x = np.where(have, v - middle, 0.0)
            have = have.astype(float)
            sums += (have.T @ have, x.T @ have, (x * x).T @ have, x.T @ x)
            seen = seen or len(v) > 0
        if seen:
            part = TaskContext.get().partitionId() % PARTS
            flat = [pa.array(list(s)) for s in sums]
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array([part] * size, pa.int32()), *flat], ["place", "part", *_SUMS])

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pdf.iloc[:1].copy()
        for c in _SUMS:
            out.at[out.index[0], c] = np.sum(np.stack(pdf[c].to_numpy()), axis=0)
        return out

    kinds = "place int, part int, " + ", ".join(f"{c} array<double>" for c in _SUMS)
    rows = numbers.mapInArrow(products, kinds)
    some = rows.groupBy("place", "part").applyInPandas(added, kinds)
    return some.groupBy("place").applyInPandas(added, kinds).drop("part")


def corr_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_a, column_b, n, r``: Pearson r of every ordered pair of different columns over the rows that have both values.

    NULL if either is constant there, or if fewer than two rows have both.
    """
    columns = list(columns)
    sums = pair_sums(df, columns)
    # The other column's own sums of the same pair stand in its row.
    each = sums.select("place", F.posexplode(F.arrays_zip(*_SUMS)).alias("other", "s")).select("place", "other", "s.*")
    back = each.select(F.col("other").alias("place"), F.col("place").alias("other"), F.col("x").alias("y"), F.col("xx").alias("yy"))
    n, x, y = F.col("n"), F.col("x"), F.col("y")
    both = each.where("place <> other").join(back, ["place", "other"])
    over, across = F.col("xx") - x * x / n, F.col("yy") - y * y / n
    # What rounding leaves of a constant column is none.
    varied = (over > F.lit(1e-12) * F.col("xx")) & (across > F.lit(1e-12) * F.col("yy"))
    r = (F.col("xy") - x * y / n) / F.sqrt(over * across)
    r = F.when((n > 1) & varied, F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))
    names = F.array(*[F.lit(c) for c in columns])
    return both.where("n > 0").select(
        F.get(names, F.col("place")).alias("column_a"), F.get(names, F.col("other")).alias("column_b"), n.cast("long").alias("n"), r.alias("r")
    )
