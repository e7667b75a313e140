"""Catalogue: messages, parsing, row quality, stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.parsing import (
    flag, legacy_regex_extract, map_label, message_text, number, parse_message,
)
from ..functions.timefn import parse_ts, time_range, time_text
from ..operators import quality as q
from ..session import scratch_path
from ..sinks import tables as sinks
from ..sinks.versions import VersionedTable
from ..sources.tables import infer_table_schema, read_exported_csv, read_table
from .registry import query, r4, r6, table
from .views import SQL_GAPPY, SQL_READINGS, SQL_SENSORS, gappy, readings, sensors

MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
MESSAGE = "event_id bigint, ts string, user_id bigint, event_type string, value double, props string"


def messages(spark, d):
    """Events as topic messages."""
    e = table(spark, d, "events")
    return sinks.to_json_messages(e.withColumn("ts", time_text("ts", MICROS)))


@query(
    "parse_json_envelope",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, round(value, 6) AS value, props
    FROM events""",
)
def parse_json_envelope(spark, d):
    parsed = parse_message(messages(spark, d), MESSAGE)
    ts = time_text(parse_ts("ts", MICROS), MICROS).alias("ts")
    return parsed.select("event_id", ts, "user_id", "event_type", r6("value"), "props")


@query(
    "legacy_regex_extract",
    "SELECT event_id, event_type, round(value, 6) AS value FROM events",
)
def legacy(spark, d):
    raw = messages(spark, d).select(message_text().alias("raw"))
    return raw.select(
        legacy_regex_extract("raw", "event_id", "digits").try_cast("bigint").alias("event_id"),
        legacy_regex_extract("raw", "event_type", "string").alias("event_type"),
        r6(number(legacy_regex_extract("raw", "value")), "value"),
    )


@query(
    "tolerant_cast",
    """SELECT l_returnflag, count(*) AS n_rows, count(TRY_CAST(CASE WHEN l_orderkey % 3 = 0 THEN '' WHEN l_orderkey % 3 = 1
        THEN l_returnflag ELSE CAST(l_linenumber AS VARCHAR) END AS DOUBLE)) AS n_numbers
    FROM lineitem GROUP BY l_returnflag""",
)
def tolerant_cast(spark, d):
    third = F.col("l_orderkey") % 3
    text = F.when(third == 0, "").when(third == 1, F.col("l_returnflag")).otherwise(F.col("l_linenumber").cast("string"))
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(number(text)).alias("n_numbers")
    )


_MEASURES = ["l_discount", "l_tax"]
_SHOWN = "SELECT l_orderkey, l_linenumber, round(l_discount, 6) AS l_discount, round(l_tax, 6) AS l_tax"


def _shown(df):
    return df.select("l_orderkey", "l_linenumber", r6("l_discount"), r6("l_tax"))


@query("drop_blank_or_zero", f"{_SHOWN} FROM ({SQL_SENSORS}) WHERE l_discount <> 0 OR l_tax <> 0")
def drop_blank_or_zero(spark, d):
    return _shown(q.drop_blank_or_zero(sensors(spark, d), _MEASURES))


@query("drop_all_null", f"{_SHOWN} FROM ({SQL_SENSORS}) WHERE l_discount IS NOT NULL OR l_tax IS NOT NULL")
def drop_all_null(spark, d):
    return _shown(q.drop_all_null(sensors(spark, d), _MEASURES))


@query("drop_incomplete", f"{_SHOWN} FROM ({SQL_SENSORS}) WHERE l_discount IS NOT NULL AND l_tax IS NOT NULL")
def drop_incomplete(spark, d):
    return _shown(q.drop_incomplete(sensors(spark, d), _MEASURES))


@query(
    "drop_missing_time",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:00') AS minute FROM events WHERE event_id % 11 <> 0""",
)
def drop_missing_time(spark, d):
    e = table(spark, d, "events")
    text = F.when(F.col("event_id") % 11 == 0, "  ").otherwise(time_text("ts", "yyyy.MM.dd HH:mm"))
    kept = q.drop_missing_time(e.select("event_id", text.alias("timestamp")), "timestamp")
    return kept.select("event_id", time_text(parse_ts("timestamp")).alias("minute"))


@query("split_counts", f"SELECT data_type, count(*) AS n_rows FROM ({SQL_READINGS}) GROUP BY data_type")
def split_counts(spark, d):
    return readings(spark, d).groupBy("data_type").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "quarantine_missing_type",
    f"""SELECT CASE WHEN event_type IS NULL THEN 'rejected' ELSE 'good' END AS outcome, count(*) AS n_rows
    FROM ({SQL_GAPPY}) GROUP BY 1""",
)
def quarantine(spark, d):
    return q.reject_counts(gappy(spark, d), ["event_type"])


@query(
    "rejected_rows",
    f"""SELECT event_id, concat_ws(',', CASE WHEN event_type IS NULL THEN 'event_type' END,
        CASE WHEN value IS NULL THEN 'value' END) AS missing FROM ({SQL_GAPPY})
    WHERE event_type IS NULL OR value IS NULL""",
)
def rejected(spark, d):
    _, bad = q.require_fields(gappy(spark, d), ["event_type", "value"])
    return bad.select("event_id", F.array_join("missing_fields", ",").alias("missing"))


@query(
    "time_range",
    """SELECT event_id, event_type, round(value, 6) AS value FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-10 00:00:00'""",
)
def in_range(spark, d):
    rows = time_range(table(spark, d, "events"), "ts", "2024-01-08 00:00:00", "2024-01-10 00:00:00")
    return rows.select("event_id", "event_type", r6("value"))


@query(
    "table_query",
    """SELECT event_id, user_id, round(value, 6) AS value FROM events WHERE event_type = 'click'
    ORDER BY value DESC, event_id LIMIT 100""",
)
def top_clicks(spark, d):
    rows = q.table_query(table(spark, d, "events"), {"event_type": "click"}, [F.desc("value"), "event_id"], 100)
    return rows.select("event_id", "user_id", r6("value"))


@query(
    "columns_by_prefix",
    "SELECT l_orderkey, l_linenumber, round(l_discount, 6) AS l_discount, round(l_tax, 6) AS l_tax FROM lineitem",
)
def by_prefix(spark, d):
    return _shown(q.columns_by_prefix(table(spark, d, "lineitem"), ["l_d", "l_t"], keep=["l_orderkey", "l_linenumber"]))


@query(
    "map_label",
    """SELECT label, CASE WHEN label = 0 THEN 1 ELSE 0 END AS prediction, count(*) AS n_rows FROM embeddings GROUP BY 1, 2""",
)
def labels(spark, d):
    e = table(spark, d, "embeddings")
    return e.groupBy("label", map_label("label", 0).alias("prediction")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "threshold_flag",
    "SELECT event_id, CASE WHEN value > 100 THEN 1 ELSE 0 END AS flagged FROM events",
)
def threshold(spark, d):
    return table(spark, d, "events").select("event_id", flag(F.col("value") > 100).alias("flagged"))


@query(
    "attach_by_key",
    """SELECT doc_id, quality, toxic, n_chars, lang FROM labels LEFT JOIN documents USING (doc_id)""",
)
def attach(spark, d):
    docs = table(spark, d, "documents")
    return q.attach_by_key(table(spark, d, "labels"), docs, ["doc_id"], ["n_chars", "lang"])


@query(
    "missing_counts",
    f"""SELECT 'event_id' AS column_name, count(*) FILTER (WHERE event_id IS NULL) AS missing FROM ({SQL_GAPPY})
    UNION ALL SELECT 'event_type', count(*) FILTER (WHERE event_type IS NULL) FROM ({SQL_GAPPY})
    UNION ALL SELECT 'value', count(*) FILTER (WHERE value IS NULL OR isnan(value)) FROM ({SQL_GAPPY})""",
)
def missing(spark, d):
    return q.missing_counts(gappy(spark, d), ["event_id", "event_type", "value"])


@query(
    "backfill_batches",
    """SELECT batch_no, count(*) AS n_rows, min(event_id) AS first_id, max(event_id) AS last_id FROM (
        SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 1000 AS batch_no FROM events)
    GROUP BY batch_no""",
)
def backfill(spark, d):
    rows = sinks.assign_batches(table(spark, d, "events"), ["ts", "event_id"], 1000, chunk_rows=2000)
    return rows.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


@query(
    "append_batches",
    "SELECT event_type, count(*) AS n_rows, round(sum(value), 4) AS total FROM events GROUP BY event_type",
)
def append_batches(spark, d):
    """Train and test as two batches, the first written twice: the table holds each row once."""
    path = scratch_path(spark, "append")
    write = sinks.append_batch_to_table(path)
    train, test = q.split_by_type(readings(spark, d))
    for df, batch in ((train, 0), (train, 0), (test, 1)):
        write(df, batch)
    rows = sinks.read_batches(spark, path, train.schema)
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"), r4(F.sum("value"), "total"))


@query("stored_table", "SELECT event_type, count(*) AS n_rows FROM events GROUP BY event_type")
def stored_table(spark, d):
    """A table read back by its path."""
    path = scratch_path(spark, "stored")
    sinks.append_rows(table(spark, d, "events").select("event_id", "event_type"), path, rows_per_file=5000)
    return read_table(spark, path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"))


@query("replace_table", "SELECT event_id, round(value * 2, 6) AS value FROM events")
def replace(spark, d):
    """A table rewritten from itself."""
    path = scratch_path(spark, "replace")
    sinks.append_rows(table(spark, d, "events").select("event_id", "value"), path)
    stored = spark.read.parquet(path)
    sinks.replace_table(stored.withColumn("value", F.col("value") * 2), path)
    return spark.read.parquet(path).select("event_id", r6("value"))


@query(
    "delete_rows",
    f"SELECT event_id, event_type FROM ({SQL_GAPPY}) WHERE NOT coalesce(event_type = 'click', false)",
)
def delete(spark, d):
    path = scratch_path(spark, "delete")
    sinks.append_rows(gappy(spark, d).select("event_id", "event_type"), path)
    sinks.delete_rows(spark, path, F.col("event_type") == "click")
    return spark.read.parquet(path)


@query(
    "versioned_table",
    f"""WITH g AS ({SQL_GAPPY}),
    v1 AS (SELECT event_id, event_type, event_id % 3 AS part FROM g),
    v2 AS (SELECT * REPLACE (part * 10 AS part) FROM v1),
    v3 AS (SELECT * FROM v2 WHERE NOT coalesce(event_type = 'click', false)),
    v4 AS (SELECT * FROM v3 UNION ALL SELECT * FROM v1 WHERE part = 0)
    SELECT 1 AS version, event_type, part, count(*) AS n_rows FROM v1 GROUP BY ALL UNION ALL SELECT 2, event_type, part, count(*) FROM v2 GROUP BY ALL
    UNION ALL SELECT 3, event_type, part, count(*) FROM v3 GROUP BY ALL UNION ALL SELECT 4, event_type, part, count(*) FROM v4 GROUP BY ALL""",
)
def versioned_table(spark, d):
    """A table rewritten from itself, without some rows, and with more; every version is still there."""
    stored = VersionedTable(spark, scratch_path(spark, "versioned"))
    rows = gappy(spark, d).select("event_id", "event_type", (F.col("event_id") % 3).alias("part"))
    stored.replace(rows)
    stored.change(lambda df: df.withColumn("part", F.col("part") * 10))
    stored.delete(F.col("event_type") == "click")
    stored.append(rows.where("part = 0"))
    each = [stored.read(v).select(F.lit(v).alias("version"), "event_type", "part") for v in stored.versions()]
    whole = each[0]
    for more in each[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy("version", "event_type", "part").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "csv_round_trip",
    "SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer",
)
def csv_round_trip(spark, d):
    path = scratch_path(spark, "csv")
    customer = table(spark, d, "customer")
    sinks.export_csv(customer, path, sep=";")
    return read_exported_csv(spark, path, customer.schema, ";").withColumn("c_acctbal", F.round("c_acctbal", 6))


@query(
    "csv_round_trip_text",
    """SELECT doc_id, text, CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '' ELSE 'a "b" ' || chr(10) || lang END AS note FROM documents""",
)
def csv_round_trip_text(spark, d):
    """Long texts with line breaks, and missing, empty and quoted ones."""
    path = scratch_path(spark, "csv")
    note = F.when(F.col("doc_id") % 3 == 1, "").when(F.col("doc_id") % 3 == 2, F.concat(F.lit('a "b" \n'), "lang"))
    documents = table(spark, d, "documents").select("doc_id", "text", note.alias("note"))
    sinks.export_csv(documents, path)
    return read_exported_csv(spark, path, documents.schema)


@query(
    "stored_schema",
    """SELECT count(*) AS n_rows, 'event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, props STRING' AS ddl FROM events""",
)
def stored_schema(spark, d):
    e = table(spark, d, "events").drop("ts")
    ddl = ", ".join(f"{c} {t}" for c, t in infer_table_schema(e).items())
    return e.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("ddl", F.lit(ddl))
