"""The test tables in the roles of readings, logs and labelled predictions.

Each frame has the SQL text of the same view beside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import flag
from .registry import table

SPLIT_AT = "2024-01-21"

SERIES, ORDER = ["event_type"], ["ts", "event_id"]

SQL_READINGS = f"""
SELECT *, CASE WHEN ts < TIMESTAMP '{SPLIT_AT}' THEN 'train' ELSE 'test' END AS data_type,
       CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k
FROM events"""


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Events with their split and the number inside ``props``."""
    df = table(spark, folder, "events")
    early = F.col("ts") < F.lit(SPLIT_AT).cast("timestamp_ntz")
    return df.withColumns(
        {
            "data_type": F.when(early, "train").otherwise("test"),
            "k": F.from_json("props", "k bigint").getField("k"),
        }
    )


SQL_GAPPY = """
SELECT event_id, ts, user_id,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END AS value
FROM events"""


def with_gaps(e: DataFrame) -> DataFrame:
    """Events with made-up missing types, readings and NaN."""
    every = lambda n: F.col("event_id") % n == 0
    return e.select(
        "event_id", "ts", "user_id",
        F.when(~every(13), F.col("event_type")).alias("event_type"),
        F.when(every(17), None).when(every(19), F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
    )


def gappy(spark: SparkSession, folder: str) -> DataFrame:
    return with_gaps(table(spark, folder, "events"))


SQL_SENSORS = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_discount END AS l_discount,
       CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_tax END AS l_tax
FROM lineitem"""


def sensors(spark: SparkSession, folder: str) -> DataFrame:
    """Two line-item measures with made-up NULLs."""
    li = table(spark, folder, "lineitem")
    every = lambda n: F.col("l_orderkey") % n == 0
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(~every(7), F.col("l_discount")).alias("l_discount"),
        F.when(~every(5), F.col("l_tax")).alias("l_tax"),
    )


SQL_SCORED = """
SELECT CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS truth,
       CASE WHEN value > 100 THEN 1 ELSE 0 END AS prediction
FROM events"""


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Truth and a threshold prediction per event."""
    e = table(spark, folder, "events")
    return e.select(
        flag(F.col("event_type") == "error").alias("truth"), flag(F.col("value") > 100).alias("prediction")
    )


SQL_LOGS = """
SELECT event_id, ts, event_type AS service, user_id % 4 AS shard,
       CASE event_type WHEN 'error' THEN 'ERR' WHEN 'click' THEN 'info' WHEN 'view' THEN 'debug'
            WHEN 'signup' THEN 'Warn' ELSE 'notice' END AS level,
       CASE WHEN event_type = 'view' THEN props ELSE
            'user=' || CAST(user_id AS VARCHAR) || ' took=' || regexp_extract(props, '"k": *([0-9]+)', 1)
            || 'ms size=' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)
            || 'KB msg="' || event_type || ' done"' END AS line
FROM events"""


def logs(spark: SparkSession, folder: str) -> DataFrame:
    """Events as log lines: JSON for views, logfmt for the rest."""
    e = readings(spark, folder)
    kind = F.col("event_type")
    level = (
        F.when(kind == "error", "ERR").when(kind == "click", "info").when(kind == "view", "debug")
        .when(kind == "signup", "Warn").otherwise("notice")
    )
    text = F.concat(
        F.lit("user="), F.col("user_id").cast("string"), F.lit(" took="), F.col("k").cast("string"),
        F.lit("ms size="), F.floor("value").cast("string"), F.lit('KB msg="'), kind, F.lit(' done"'),
    )
    return e.select(
        "event_id", "ts", kind.alias("service"), (F.col("user_id") % 4).alias("shard"), level.alias("level"),
        F.when(kind == "view", F.col("props")).otherwise(text).alias("line"),
    )


def vectors(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    """Embeddings with one double column per dimension; vectors of several sizes are an error."""
    e = table(spark, folder, "embeddings")
    size, most = e.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if size != most:
        raise ValueError(f"vectors have {size} to {most} dimensions")
    names = [f"x{i}" for i in range(size)]
    return e.select(
        "vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)]
    ), names


__all__ = [
    "ORDER", "SERIES", "SPLIT_AT", "SQL_GAPPY", "SQL_LOGS", "SQL_READINGS", "SQL_SCORED", "SQL_SENSORS",
    "gappy", "logs", "readings", "scored", "sensors", "vectors", "with_gaps",
]
