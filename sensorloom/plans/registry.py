"""The catalogue: a name, a Spark plan, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a plan under ``name``; without ``sql`` it is checked by the tests only."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def r6(c: str | Column, name: str | None = None) -> Column:
    """Rounded to 6 places for comparison."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name or c)


def r4(c: str | Column, name: str | None = None) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 4).alias(name or c)


def r8(c: str | Column, name: str | None = None) -> Column:
    """For means and scores whose exact decimals would tie at 6 places."""
    return F.round(F.col(c) if isinstance(c, str) else c, 8).alias(name or c)
