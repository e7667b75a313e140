"""Table profiles: statistics, exact percentiles, correlation, histograms."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions.parsing import any_of, no_nan, numeric_columns
from ..session import write_scratch
from .ordered import broadcast_small, join_same, with_running_sum

_SKETCH = 2000


def _long(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    wide = df.select(*by, *[no_nan(c).alias(c) for c in columns])
    return wide.unpivot(list(by), list(columns), "column_name", "value").where("value is not null")


def _positions(n: int, fractions: Sequence[float]) -> list[int]:
    """Row numbers (from 0) that the percentiles of n sorted values touch."""
    spots = set()
    for f in fractions:
        at = f * (n - 1)
        spots |= {math.floor(at), math.ceil(at)}
    return sorted(spots)


@dataclass
class _Range:
    """Values of a column between two data values, and how many values lie below."""

    column: str
    lo: float
    hi: float
    below: int
    spots: list[int]


def _first_scan(df: DataFrame, columns: Sequence[str], fractions: Sequence[float]) -> list[Row]:
    """Per column: count, mean, deviation, extremes and the sketch's values for the fractions."""
    stats = []
    for i, c in enumerate(columns):
        x = no_nan(c)
        stats.append(
            F.struct(
                F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                F.min(x).alias("lo"), F.max(x).alias("hi"),
                F.percentile_approx(x, list(fractions), _SKETCH).alias("q"),
            ).alias(f"c{i}")
        )
    return list(df.agg(*stats).first())


def _around(fractions: Sequence[float]) -> list[float]:
    """A fraction below and one above each wanted one."""
    slack = 4 / _SKETCH
    return [min(max(f + d, 0.0), 1.0) for f in fractions for d in (-slack, slack)]


def _thin_ranges(
    df: DataFrame, columns: Sequence[str], fractions: Sequence[float], first: list[Row]
) -> list[_Range]:
    """A thin range of values around each wanted position.

    The sketch proposes the range and a counting scan proves that the position lies in it;
    where it does not, the range is the whole column. The scan returns one row.
    """
    ends = _around(fractions)
    proposed = []
    for c, e in zip(columns, first):
        for i, f in enumerate(fractions):
            if e["n"]:
                lo = e["lo"] if ends[2 * i] == 0 else e["q"][2 * i]
                hi = e["hi"] if ends[2 * i + 1] == 1 else e["q"][2 * i + 1]
                proposed.append(_Range(c, lo, hi, 0, _positions(e["n"], [f])))
    if not proposed:
        return []
    proof = df.agg(
        *[
            F.struct(
                F.count_if(no_nan(r.column) < r.lo).alias("below"),
                F.count_if(no_nan(r.column) <= r.hi).alias("upto"),
            ).alias(f"r{i}")
            for i, r in enumerate(proposed)
        ]
    ).first()
    extremes = {c: (e["lo"], e["hi"]) for c, e in zip(columns, first)}
    ranges = []
    for r, p in zip(proposed, proof):
        if p["below"] <= r.spots[0] and r.spots[-1] < p["upto"]:
            ranges.append(_Range(r.column, r.lo, r.hi, p["below"], r.spots))
        else:
            ranges.append(_Range(r.column, *extremes[r.column], 0, r.spots))
    return ranges


def _values_at(df: DataFrame, ranges: list[_Range], chunk_rows: int | None) -> dict[tuple[str, int], float]:
    """The values at the wanted positions, from the rows of the narrowed ranges."""
    done = {(r.column, s): r.lo for r in ranges if r.lo == r.hi for s in r.spots}
    ranges = [r for r in ranges if r.lo < r.hi]
    if not ranges:
        return done
    inside = [no_nan(r.column).between(r.lo, r.hi) for r in ranges]
    slots = [
        F.when(test, F.struct(F.lit(i).alias("range"), no_nan(r.column).alias("value")))
        for i, (r, test) in enumerate(zip(ranges, inside))
    ]
    rows = df.where(any_of(inside)).select(F.explode(F.array(*slots)).alias("s"))
    rows = rows.where("s is not null").select("s.*")
    freq = write_scratch(rows.groupBy("range", "value").agg(F.count(F.lit(1)).alias("n")), "percentiles")
    upto = with_running_sum(freq, ["range"], ["value"], {"upto": F.col("n")}, chunk_rows)
    wanted = F.array(*[F.array(*[F.lit(s - r.below) for s in r.spots]).cast("array<long>") for r in ranges])
    hits = upto.select(
        "range", "value",
        F.filter(F.get(wanted, F.col("range")), lambda s: (s >= F.col("upto") - F.col("n")) & (s < F.col("upto"))).alias("s"),
    ).where(F.size("s") > 0)
    for h in hits.collect():  # one row per wanted position at most
        for s in h["s"]:
            r = ranges[h["range"]]
            done[(r.column, s + r.below)] = h["value"]
    return done


def exact_percentiles(
    df: DataFrame,
    columns: Sequence[str],
    fractions: Sequence[float] = (0.25, 0.5, 0.75),
    chunk_rows: int | None = None,
) -> DataFrame:
    """Linear-interpolated percentiles as (column_name, fraction, value).

    Two scans find a thin range of values around each wanted position; only rows inside
    those ranges are then sorted, as counts per distinct value. So hardly any row is
    shuffled, and no task sees a whole column.
    """
    first = _first_scan(df, columns, _around(fractions))
    values = _percentile_values(df, columns, fractions, first, chunk_rows)
    rows = [(c, float(f), v) for c, per_column in zip(columns, values) for f, v in zip(fractions, per_column)]
    return df.sparkSession.createDataFrame(rows, "column_name string, fraction double, value double")


def _percentile_values(
    df: DataFrame, columns: Sequence[str], fractions: Sequence[float], first: list[Row], chunk_rows: int | None
) -> list[list[float | None]]:
    values = _values_at(df, _thin_ranges(df, columns, fractions, first), chunk_rows)
    out = []
    for c, e in zip(columns, first):
        line: list[float | None] = []
        for f in fractions:
            at = f * (e["n"] - 1)
            if e["n"]:
                lo, hi = values[(c, math.floor(at))], values[(c, math.ceil(at))]
                line.append(lo + (hi - lo) * (at - math.floor(at)) if hi > lo else lo)
            else:
                line.append(None)
        out.append(line)
    return out


def exact_percentiles_by(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str],
    fractions: Sequence[float] = (0.25, 0.5, 0.75),
    chunk_rows: int | None = None,
) -> DataFrame:
    """The same per group, as (``by``, column_name, fraction, value), for any number of groups.

    Equal values are counted first; a running count over the distinct values then
    tells which of them covers a wanted position.
    """
    keys = [*by, "column_name"]
    freq = _long(df, columns, by).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    freq = write_scratch(freq, "percentiles")
    upto = with_running_sum(freq, keys, ["value"], {"upto": F.col("n")}, chunk_rows)
    totals = freq.groupBy(*keys).agg(F.sum("n").alias("total"))
    at = lambda f: F.lit(float(f)) * (F.col("total") - 1)
    wanted = totals.select(
        *keys, F.array(*[F.struct(F.lit(float(f)).alias("fraction"), at(f).alias("at")) for f in fractions]).alias("wanted")
    )
    hit = join_same(upto, broadcast_small(wanted), keys, "inner")
    first, last = F.col("upto") - F.col("n"), F.col("upto") - 1
    covered = F.filter(
        "wanted",
        lambda w: F.floor(w["at"]).between(first, last) | F.ceil(w["at"]).between(first, last),
    )
    hit = hit.select(*keys, "value", "n", "upto", F.explode(covered).alias("w"))
    low, high = F.floor("w.at"), F.ceil("w.at")
    part = lambda at: F.max(F.when(at.between(first, last), F.col("value")))
    picked = hit.groupBy(*keys, F.col("w.fraction").alias("fraction"), F.col("w.at").alias("at")).agg(
        part(low).alias("lo"), part(high).alias("hi")
    )
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("at") - F.floor("at"))
    return picked.select(*keys, "fraction", value.alias("value"))


def describe(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    approximate: bool = False,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum, one row per column.

    The quartiles are exact; ``approximate`` takes them from the sketch, which needs one
    scan and no shuffle of values. NaN counts as missing.
    """
    columns = list(columns or numeric_columns(df))
    quarters = [0.25, 0.5, 0.75]
    if approximate:
        first = _first_scan(df, columns, quarters)
        values = [e["q"] or [None] * 3 for e in first]
    else:
        first = _first_scan(df, columns, _around(quarters))
        values = _percentile_values(df, columns, quarters, first, chunk_rows)
    rows = [
        (c, e["n"], e["mean"], e["std"], e["lo"], *(float(v) if v is not None else None for v in q), e["hi"])
        for c, e, q in zip(columns, first, values)
    ]
    schema = "column_name string, n long, mean double, std double, min double, p25 double, p50 double, p75 double, max double"
    return df.sparkSession.createDataFrame(rows, schema)


def pearson(a: str, b: str) -> Column:
    """Pearson r over the rows that have both values; NULL if a column is constant.

    The built-in ``corr`` divides by zero there, which ANSI mode reports as an error.
    """
    x = F.when(F.col(b).isNotNull(), F.col(a))
    y = F.when(F.col(a).isNotNull(), F.col(b))
    return F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))


def pairwise_corr(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r of every ordered pair of different columns, in one pass.

    Valid on a stream too (complete or update mode).
    """
    pairs = list(permutations(columns, 2))
    known = {tuple(sorted(p)) for p in pairs}
    r = {p: pearson(*p) for p in sorted(known)}
    entries = [
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), r[tuple(sorted((a, b)))].alias("r"))
        for a, b in pairs
    ]
    return df.agg(F.array(*entries).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def corr_with_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Columns ranked by their correlation with the target, strongest positive first."""
    others = [c for c in columns if c != target]
    entries = [F.struct(F.lit(c).alias("column_name"), pearson(c, target).alias("r")) for c in others]
    rows = df.agg(F.array(*entries).alias("p")).select(F.explode("p").alias("p")).select("p.*")
    return rows.orderBy(F.desc_nulls_last("r"), "column_name")


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full correlation matrix, one row per column."""
    lines = [
        F.struct(F.lit(a).alias("column_name"), *[pearson(a, b).alias(b) for b in columns]) for a in columns
    ]
    return df.agg(F.array(*lines).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def histogram(df: DataFrame, column: str, buckets: int = 20) -> DataFrame:
    """Rows per equal-width bucket between the smallest and the largest value.

    The last bucket includes the maximum; empty buckets are left out.
    """
    x = no_nan(column)
    ends = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi")).alias("e")).scalar()
    lo, hi = ends.getField("lo"), ends.getField("hi")
    width = (hi - lo) / F.lit(float(buckets))
    spread = F.when(hi > lo, F.floor((x - lo) / width)).otherwise(F.lit(0))
    placed = df.where(x.isNotNull()).select(F.least(spread, F.lit(buckets - 1)).cast("int").alias("bucket"))
    counted = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select("bucket", (lo + F.col("bucket") * width).alias("bucket_start"), "n_rows")


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, non-NULL values, and the table's rows."""
    entries = [
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.count(F.col(f"`{f.name}`")).alias("non_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), F.array(*entries).alias("p"))
    return counted.select("n_rows", F.explode("p").alias("p")).select("p.*", "n_rows")
