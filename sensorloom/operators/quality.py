"""Row quality: what to keep, what to reject, how to split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import all_of, any_of


def columns_by_prefix(
    df: DataFrame, prefixes: Sequence[str], keep: Sequence[str] = (), first: int | None = None
) -> DataFrame:
    """Columns whose name starts with a prefix, in table order.

    ``first`` limits each prefix to its first columns; ``keep`` names columns that
    stay in front.
    """
    chosen = list(keep)
    for prefix in prefixes:
        chosen += [c for c in df.columns if c.startswith(prefix) and c not in chosen][:first]
    return df.select(*chosen)


def group_columns(df: DataFrame, prefixes: Sequence[str]) -> dict[str, list[str]]:
    """Column names per prefix."""
    return {p: [c for c in df.columns if c.startswith(p)] for p in prefixes}


def drop_missing_time(df: DataFrame, column: str) -> DataFrame:
    """Rows that have a time; blank text counts as missing."""
    if dict(df.dtypes)[column] == "string":
        return df.where(F.nullif(F.trim(F.col(column)), F.lit("")).isNotNull())
    return df.where(F.col(column).isNotNull())


def drop_blank_or_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which some listed column is neither NULL nor 0."""
    return df.where(any_of([F.col(c) != 0 for c in columns]))


def drop_all_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in at least one listed column."""
    return df.na.drop(how="all", subset=list(columns))


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in every listed column."""
    return df.na.drop(how="any", subset=list(columns))


def split_by_type(
    df: DataFrame, column: str = "data_type", values: Sequence[str] = ("train", "test")
) -> tuple[DataFrame, ...]:
    """One frame per value of the split column."""
    return tuple(df.where(F.col(column) == v) for v in values)


def present(df: DataFrame, columns: Sequence[str]) -> Column:
    """True where every mandatory field is there; blank text counts as missing."""
    kinds = dict(df.dtypes)
    tests = []
    for c in columns:
        if kinds[c] == "string":
            tests.append(F.coalesce(F.trim(F.col(c)) != "", F.lit(False)))
        else:
            tests.append(F.col(c).isNotNull())
    return all_of(tests)


def require_fields(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with the names of what they lack."""
    ok = present(df, columns)
    lacking = F.array_compact(
        F.array(*[F.when(~present(df, [c]), F.lit(c)) for c in columns])
    )
    rejected = df.where(~ok).withColumn("missing_fields", lacking)
    return df.where(ok), rejected


def reject_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many rows pass and fail :func:`require_fields`."""
    ok = present(df, columns)
    return df.groupBy(F.when(ok, "good").otherwise("rejected").alias("outcome")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def table_query(
    df: DataFrame,
    filters: dict[str, object] | None = None,
    order_by: Sequence[str | Column] = (),
    limit: int | None = None,
) -> DataFrame:
    """Equality filters, sort and limit; sort with limit becomes a top-k."""
    for column, value in (filters or {}).items():
        df = df.where(F.col(column).isNull() if value is None else F.col(column) == F.lit(value))
    if order_by:
        df = df.orderBy(*order_by)
    return df if limit is None else df.limit(limit)


def attach_by_key(df: DataFrame, source: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Bring back columns of ``source`` through a unique key, never by row position."""
    return df.join(source.select(*key, *columns), list(key), "left")


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL or NaN values per column, one row per column, in one pass."""
    columns = list(columns or df.columns)
    kinds = dict(df.dtypes)

    def missing(c: str) -> Column:
        col = F.col(c)
        return col.isNull() | F.isnan(col) if kinds[c] in ("double", "float") else col.isNull()

    counted = df.agg(*[F.count_if(missing(c)).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "missing")
