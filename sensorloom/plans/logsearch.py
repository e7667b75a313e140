"""Catalogue: log exploration."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.logtext import level_rank, normalise_level
from ..functions.timefn import auto_interval, bucket_start, dashboard_range, time_text
from ..operators import logs as lg
from ..operators import templates as tm
from ..operators.quality import table_query
from .registry import query, r4, r6, table
from .views import SQL_LOGS, logs, readings

_HOUR = "strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS bucket"
_DAY = "strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS bucket"
_LEVEL = "CASE level WHEN 'ERR' THEN 'error' WHEN 'Warn' THEN 'warning' WHEN 'notice' THEN 'unknown' ELSE level END"


def _bucket(df):
    return df.withColumn("bucket", time_text("bucket"))


@query(
    "label_filter",
    f"""SELECT event_id FROM ({SQL_LOGS}) WHERE service IN ('error', 'signup', 'view') AND shard IN (1, 2, 3)
    AND NOT level IN ('debug')""",
)
def label_filter(spark, d):
    rows = lg.label_filter(
        logs(spark, d), {"service": ["error", "signup", "view"], "shard": [1, 2, 3]}, {"level": ["debug"]}
    )
    return rows.select("event_id")


@query("line_contains", "SELECT doc_id FROM documents WHERE contains(lower(text), 'data')")
def contains(spark, d):
    return lg.line_contains(table(spark, d, "documents"), "Data", "text", case_sensitive=False).select("doc_id")


@query("line_contains_exact", "SELECT conv_id, turn FROM conversations WHERE contains(text, '. ')")
def contains_exact(spark, d):
    return lg.line_contains(table(spark, d, "conversations"), ". ", "text").select("conv_id", "turn")


@query(
    "parse_line",
    f"""SELECT event_id, CASE WHEN service <> 'view' THEN regexp_extract(line, 'user=([0-9]+)', 1) END AS user_id,
        CASE WHEN service <> 'view' THEN service || ' done' END AS msg,
        CASE WHEN service = 'view' THEN regexp_extract(line, '"k": *([0-9]+)', 1) END AS k FROM ({SQL_LOGS})""",
)
def parse_line(spark, d):
    p = lg.parse_line(logs(spark, d))
    return p.select(
        "event_id", lg.field_value("user").alias("user_id"), lg.field_value("msg").alias("msg"), lg.field_value("k").alias("k")
    )


@query(
    "field_filter",
    """SELECT event_id FROM events WHERE CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) >= 50""",
)
def field_filter(spark, d):
    p = lg.parse_line(table(spark, d, "events"), "json", "props")
    return lg.field_filter(p, "k", ">=", 50).select("event_id")


@query(
    "field_filter_duration",
    f"SELECT event_id FROM ({SQL_LOGS}) WHERE service <> 'view' AND CAST(regexp_extract(line, 'took=([0-9]+)', 1) AS BIGINT) < 30",
)
def field_filter_duration(spark, d):
    return lg.field_filter(lg.parse_line(logs(spark, d)), "took", "<", "0.03s", "duration").select("event_id")


@query("log_volume", f"SELECT {_HOUR}, {_LEVEL} AS level, count(*) AS n_lines FROM ({SQL_LOGS}) GROUP BY 1, 2")
def log_volume(spark, d):
    return _bucket(lg.log_volume(logs(spark, d), 3600, normalise=True))


_FROM, _TO = 1704672000000, 1706659200000  # a dashboard range in epoch milliseconds


@query(
    "log_volume_auto",
    f"""SELECT strftime(make_timestamp(CAST(floor(epoch(ts) / 3600) * 3600000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS bucket,
        level, count(*) AS n_lines FROM ({SQL_LOGS})
    WHERE epoch(ts) >= {_FROM} / 1000 AND epoch(ts) < {_TO} / 1000 GROUP BY 1, 2""",
)
def log_volume_auto(spark, d):
    """A range cut into at most 600 buckets: 552 hours give buckets of an hour."""
    rows = dashboard_range(logs(spark, d), "ts", _FROM, _TO)
    return _bucket(lg.log_volume(rows, auto_interval(_FROM, _TO, 600)))


@query(
    "newest_lines",
    f"SELECT event_id, line FROM ({SQL_LOGS}) ORDER BY ts DESC, event_id DESC LIMIT 1000",
)
def newest_lines(spark, d):
    rows = table_query(logs(spark, d), order_by=[F.desc("ts"), F.desc("event_id")], limit=1000)
    return rows.select("event_id", "line")


@query(
    "breakdown",
    f"""SELECT {_HOUR}, regexp_extract(props, '"k": *([0-9]+)', 1) AS label_value, count(*) AS n_lines FROM events GROUP BY 1, 2""",
)
def breakdown(spark, d):
    p = lg.parse_line(table(spark, d, "events"), "json", "props")
    return _bucket(lg.breakdown(p, lg.field_value("k"), 3600))


@query(
    "field_avg",
    f"""SELECT {_DAY}, round(avg(CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT)), 6) AS mean_value, count(*) AS n_lines
    FROM events GROUP BY 1""",
)
def field_avg(spark, d):
    p = lg.parse_line(table(spark, d, "events"), "json", "props")
    return _bucket(lg.field_avg(p, "k", 86400)).select("bucket", r6("mean_value"), "n_lines")


@query(
    "field_avg_bytes",
    f"""SELECT {_DAY}, round(avg(1000 * CAST(regexp_extract(line, 'size=([0-9]+)', 1) AS BIGINT)), 4) AS mean_value, count(*) AS n_lines
    FROM ({SQL_LOGS}) WHERE service <> 'view' GROUP BY 1""",
)
def field_avg_bytes(spark, d):
    out = lg.field_avg(lg.parse_line(logs(spark, d)), "size", 86400, "bytes")
    return _bucket(out).select("bucket", r4("mean_value"), "n_lines")


@query("sum_preaggregated", f"SELECT level, CAST(count(*) AS BIGINT) AS n_lines FROM ({SQL_LOGS}) GROUP BY level")
def preaggregated(spark, d):
    return lg.sum_preaggregated(lg.log_volume(logs(spark, d), 600), "n_lines")


@query(
    "volume_by",
    f"SELECT service, CAST(sum(octet_length(encode(line))) AS BIGINT) AS volume FROM ({SQL_LOGS}) GROUP BY service",
)
def volume_by(spark, d):
    return lg.volume_by(logs(spark, d), "service")


@query(
    "detected_labels",
    f"""SELECT 'service' AS label, count(DISTINCT service) AS cardinality FROM ({SQL_LOGS})
    UNION ALL SELECT 'shard', count(DISTINCT shard) FROM ({SQL_LOGS}) UNION ALL SELECT 'level', count(DISTINCT level) FROM ({SQL_LOGS})""",
)
def detected_labels(spark, d):
    return lg.detected_labels(logs(spark, d), ["service", "shard", "level"], exact=True)


@query(
    "detected_fields",
    f"""WITH l AS ({SQL_LOGS}), f AS (
        SELECT 'user' AS field, 'logfmt' AS parser, 'float' AS field_type, regexp_extract(line, 'user=([0-9]+)', 1) AS v FROM l WHERE service <> 'view'
        UNION ALL SELECT 'took', 'logfmt', 'duration', regexp_extract(line, 'took=([0-9]+ms)', 1) FROM l WHERE service <> 'view'
        UNION ALL SELECT 'size', 'logfmt', 'bytes', regexp_extract(line, 'size=([0-9]+KB)', 1) FROM l WHERE service <> 'view'
        UNION ALL SELECT 'msg', 'logfmt', 'string', service FROM l WHERE service <> 'view'
        UNION ALL SELECT 'k', 'json', 'float', regexp_extract(line, '"k": *([0-9]+)', 1) FROM l WHERE service = 'view')
    SELECT field, parser, field_type, count(DISTINCT v) AS cardinality FROM f GROUP BY 1, 2, 3""",
)
def detected_fields(spark, d):
    return lg.detected_fields(logs(spark, d), exact=True)


@query(
    "field_presence",
    f"""SELECT 'took' AS field, round(100 * avg(CASE WHEN service <> 'view' THEN 1.0 ELSE 0.0 END), 4) AS percent, count(*) AS n_lines
    FROM ({SQL_LOGS})""",
)
def field_presence(spark, d):
    return lg.field_presence(lg.parse_line(logs(spark, d)), "took").withColumn("percent", F.round("percent", 4))


_TEMPLATE = r"""regexp_replace(regexp_replace(line, '([:=] ?)"[^"]*"', '\1<_>', 'g'), '[0-9]+', '<_>', 'g')"""


@query(
    "log_patterns",
    f"""WITH c AS (SELECT {_TEMPLATE} AS template, {_DAY}, count(*) AS n_lines FROM ({SQL_LOGS}) GROUP BY 1, 2)
    SELECT template, bucket, n_lines, CAST(sum(n_lines) OVER (PARTITION BY template) AS BIGINT) AS total FROM c""",
)
def log_patterns(spark, d):
    return _bucket(lg.log_patterns(logs(spark, d), 86400))


@query(
    "pattern_filter",
    rf"""SELECT event_id FROM ({SQL_LOGS}) WHERE (line LIKE 'user=% took=%' OR line LIKE '{{"k"%') AND NOT line LIKE '%msg="click%'""",
)
def pattern_filter(spark, d):
    rows = lg.pattern_filter(logs(spark, d), ["user=<_> took=<_>", '{"k"<_>'], ['<_>msg="click<_>'])
    return rows.select("event_id")


@query(
    "pattern_fields",
    f"""WITH l AS (SELECT line FROM ({SQL_LOGS}) WHERE service <> 'view')
    SELECT field, value, count(*) AS n_lines FROM (
        SELECT 'field_1' AS field, regexp_extract(line, 'user=([0-9]+)', 1) AS value FROM l
        UNION ALL SELECT 'field_2', regexp_extract(line, 'took=([0-9]+)', 1) FROM l
        UNION ALL SELECT 'field_3', regexp_extract(line, 'ms (.*)$', 1) FROM l) GROUP BY 1, 2""",
)
def pattern_fields(spark, d):
    return lg.pattern_fields(logs(spark, d), "user=<_> took=<_>ms <_>")


def _daily(spark, d):
    return table(spark, d, "events").groupBy(bucket_start("ts", 86400).alias("bucket"), "event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg("value").alias("mean_value")
    )


_SERIES = "SELECT event_type, count(*) AS n_rows FROM events GROUP BY event_type, date_trunc('day', ts)"


@query(
    "sort_series",
    f"SELECT event_type, round(stddev_pop(n_rows), 4) AS sort_value FROM ({_SERIES}) GROUP BY event_type",
)
def sort_series(spark, d):
    return lg.sort_series(_daily(spark, d), "event_type", "n_rows").select("event_type", r4("sort_value"))


@query(
    "sort_series_max",
    f"SELECT event_type, round(CAST(max(n_rows) AS DOUBLE), 4) AS sort_value FROM ({_SERIES}) GROUP BY event_type",
)
def sort_series_max(spark, d):
    return lg.sort_series(_daily(spark, d), "event_type", "n_rows", "max", descending=False).select("event_type", r4("sort_value"))


@query(
    "normalise_level",
    f"""SELECT {_LEVEL} AS level, CASE {_LEVEL} WHEN 'error' THEN 1 WHEN 'warning' THEN 2 WHEN 'info' THEN 3 WHEN 'debug' THEN 4
        ELSE 6 END AS severity, count(*) AS n_lines FROM ({SQL_LOGS}) GROUP BY 1, 2""",
)
def levels(spark, d):
    named = logs(spark, d).select(normalise_level("level").alias("level"))
    return named.groupBy("level", level_rank("level").alias("severity")).agg(F.count(F.lit(1)).alias("n_lines"))


@query("changepoint_count")
def changepoints(spark, d):
    return lg.changepoint_count(_daily(spark, d), "event_type", "bucket", "mean_value")


@query(
    "outlier_series",
    """WITH v AS (SELECT event_type, date_trunc('day', ts) AS b, CAST(count(*) AS DOUBLE) AS v FROM events GROUP BY 1, 2),
    e AS (SELECT stddev_pop(v) * 0.6 AS eps FROM v),
    g AS (SELECT event_type, b, CASE WHEN v - lag(v) OVER (PARTITION BY b ORDER BY v, event_type) <= eps THEN 0 ELSE 1 END AS s, v FROM v, e),
    c AS (SELECT event_type, b, sum(s) OVER (PARTITION BY b ORDER BY v, event_type) AS c FROM g),
    o AS (SELECT event_type, b, CASE WHEN 2 * count(*) OVER (PARTITION BY b, c) < count(*) OVER (PARTITION BY b) THEN 1 ELSE 0 END AS o FROM c),
    t AS (SELECT *, lag(o, 1, 0) OVER (PARTITION BY event_type ORDER BY b) AS p FROM o)
    SELECT event_type, count(*) FILTER (WHERE o = 1 AND p = 0) AS outlier_intervals, CAST(sum(o) AS BIGINT) AS outlier_steps
    FROM t GROUP BY event_type""",
)
def outliers(spark, d):
    return lg.outlier_series(_daily(spark, d), "event_type", "bucket", "n_rows")


#: Lines whose words vary: a host's name has no digit that a mask would find.
SQL_HOSTS = """
SELECT event_id, CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 49 = 0 THEN '' ELSE
    event_type || ' from ' || chr(97 + CAST(user_id % 23 AS INTEGER)) || chr(97 + CAST(user_id // 23 % 19 AS INTEGER)) || '.example took ' || regexp_extract(props, '"k": *([0-9]+)', 1)
    || 'ms and was ' || CASE WHEN value > 100 THEN 'slow' ELSE 'fine' END
    || CASE WHEN event_id % 3 = 0 THEN ' at gate ' || chr(97 + CAST(user_id % 5 AS INTEGER)) ELSE '' END END AS line FROM events"""


def host_lines(spark, d):
    """Events as the lines of :data:`SQL_HOSTS`."""
    e = readings(spark, d)
    letter = lambda n, of: F.expr(f"char(97 + pmod({n}, {of}))")
    text = F.concat(
        "event_type", F.lit(" from "), letter("user_id", 23), letter("user_id div 23", 19), F.lit(".example took "), F.col("k").cast("string"),
        F.lit("ms and was "), F.when(F.col("value") > 100, "slow").otherwise("fine"),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(" at gate "), letter("user_id", 5))).otherwise(""),
    )
    line = F.when(F.col("event_id") % 50 == 0, None).when(F.col("event_id") % 49 == 0, "").otherwise(text)
    return e.select("event_id", line.alias("line"))


def _templates_sql(last: str, depth: int = 3) -> str:
    """The token tree, level by level; ``last`` selects from ``made`` (masked, template, n_lines)."""
    steps = [f"""lines AS (SELECT regexp_replace(line, '[0-9]+', '<_>', 'g') AS masked, count(*) AS n_lines FROM ({SQL_HOSTS}) WHERE line IS NOT NULL GROUP BY 1),
    l0 AS (SELECT *, string_split_regex(masked, '[ ]+') AS t, CAST(len(string_split_regex(masked, '[ ]+')) AS VARCHAR) AS node FROM lines)"""]
    for i in range(depth):
        steps.append(f"""c{i} AS (SELECT node, t[{i + 1}] AS token, sum(n_lines) AS n FROM l{i} WHERE len(t) > {i} GROUP BY 1, 2),
    k{i} AS (SELECT node, token FROM (SELECT *, sum(n) OVER w AS s, count(*) OVER w AS kinds FROM c{i} WINDOW w AS (PARTITION BY node)) WHERE kinds <= 20 OR n >= 0.05 * s),
    l{i + 1} AS (SELECT masked, n_lines, t, CASE WHEN len(t) <= {i} THEN l.node ELSE l.node || chr(10) || CASE WHEN k.token IS NULL THEN '<_>' ELSE k.token END END AS node
        FROM l{i} l LEFT JOIN k{i} k ON l.node = k.node AND l.t[{i + 1}] = k.token)""")
    return f"""WITH {", ".join(steps)},
    p AS (SELECT masked, node, n_lines, unnest(t) AS token, unnest(range(len(t))) AS place FROM l{depth}),
    c AS (SELECT node, place, token, sum(n_lines) AS n FROM p WHERE place >= {depth} GROUP BY ALL),
    k AS (SELECT node, place, token FROM (SELECT *, sum(n) OVER w AS s, count(*) OVER w AS kinds FROM c WINDOW w AS (PARTITION BY node, place)) WHERE kinds <= 20 OR n >= 0.05 * s),
    made AS (
        SELECT masked, any_value(n_lines) AS n_lines, string_agg(CASE WHEN place < {depth} THEN string_split(node, chr(10))[place + 2]
            WHEN k.token IS NULL THEN '<_>' ELSE k.token END, ' ' ORDER BY place) AS template
        FROM p LEFT JOIN k USING (node, place, token) GROUP BY masked)
    {last}"""


@query("mined_templates", _templates_sql("SELECT template, CAST(sum(n_lines) AS BIGINT) AS n_lines, count(*) AS n_forms, min(masked) AS example FROM made GROUP BY template"))
def mined_templates(spark, d):
    """Templates of lines in which words vary, not only numbers."""
    return tm.mined_templates(host_lines(spark, d))


@query(
    "lines_with_template",
    _templates_sql(f"SELECT event_id, template FROM ({SQL_HOSTS}) LEFT JOIN made ON masked = regexp_replace(line, '[0-9]+', '<_>', 'g')"),
)
def lines_with_template(spark, d):
    return tm.with_template(host_lines(spark, d)).select("event_id", "template")


#: Nested JSON lines of several shapes; views of them are text.
SQL_NESTED = """
SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'plain text ' || event_id ELSE
    '{"user": {"id": ' || user_id || ', "shard": {"n": ' || (user_id % 4) || ', "a b": "s' || (user_id % 3) || '"}}, "kind": "' || event_type || '", "big": ' || (value > 100)
    || CASE WHEN event_id % 3 = 0 THEN ', "code": ' || (event_id % 7) ELSE ', "code": "c' || (event_id % 5) || '"' END
    || CASE WHEN event_id % 4 = 0 THEN ', "tags": ["' || event_type || '"], "none": null' ELSE '' END || '}' END AS line FROM events"""


def nested_lines(spark, d):
    """Events as the lines of :data:`SQL_NESTED`."""
    e = table(spark, d, "events")
    text = lambda c: F.expr(f"CAST({c} AS STRING)")
    line = F.concat(
        F.lit('{"user": {"id": '), text("user_id"), F.lit(', "shard": {"n": '), text("user_id % 4"), F.lit(', "a b": "s'), text("user_id % 3"),
        F.lit('"}}, "kind": "'), "event_type", F.lit('", "big": '), text("value > 100"),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(', "code": '), text("event_id % 7"))).otherwise(F.concat(F.lit(', "code": "c'), text("event_id % 5"), F.lit('"'))),
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit(', "tags": ["'), "event_type", F.lit('"], "none": null'))).otherwise(""), F.lit("}"),
    )
    plain = F.concat(F.lit("plain text "), text("event_id"))
    return e.select("event_id", F.when(F.col("event_id") % 11 == 0, plain).otherwise(line).alias("line"))


@query(
    "typed_fields",
    """WITH e AS (SELECT *, event_id % 3 = 0 AS t, event_id % 4 = 0 AS f FROM events WHERE event_id % 11 <> 0)
    SELECT '$.user.id' AS path, 'bigint' AS field_type, count(*) AS n_lines, count(DISTINCT user_id) AS cardinality FROM e
    UNION ALL SELECT '$.user.shard.n', 'bigint', count(*), count(DISTINCT user_id % 4) FROM e
    UNION ALL SELECT '$.user.shard[''a b'']', 'string', count(*), count(DISTINCT user_id % 3) FROM e
    UNION ALL SELECT '$.kind', 'string', count(*), count(DISTINCT event_type) FROM e
    UNION ALL SELECT '$.big', 'boolean', count(*), count(DISTINCT value > 100) FROM e
    UNION ALL SELECT '$.code', 'mixed', count(*), count(DISTINCT CASE WHEN t THEN CAST(event_id % 7 AS VARCHAR) ELSE 'c' || (event_id % 5) END) FROM e
    UNION ALL SELECT '$.tags', 'array<string>', count(*), count(DISTINCT event_type) FROM e WHERE f
    UNION ALL SELECT '$.none', 'null', 0, 0""",
)
def typed_fields(spark, d):
    """Paths, types and cardinalities of nested JSON lines."""
    return lg.typed_fields(nested_lines(spark, d), exact=True)


@query(
    "extract_typed_fields",
    """SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN user_id END AS user_id, CASE WHEN event_id % 11 <> 0 THEN 's' || (user_id % 3) END AS shard,
        CASE WHEN event_id % 11 <> 0 AND event_id % 3 = 0 THEN event_id % 7 END AS code, CASE WHEN event_id % 11 <> 0 AND event_id % 4 = 0 THEN event_type END AS tag FROM events""",
)
def extract_typed_fields(spark, d):
    paths = {"user_id": "$.user.id bigint", "shard": "$.user.shard['a b'] string", "code": "$.code bigint", "tag": "$.tags[0] string"}
    return lg.with_typed_fields(nested_lines(spark, d), paths).drop("line")
