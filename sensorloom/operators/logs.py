"""Log exploration on a (ts, labels…, line) table."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.logtext import (
    HOLE, field_number, field_type, message_template, normalise_level, template_regex,
)
from ..functions.parsing import all_of, any_of, json_map, line_fields, logfmt_map
from ..functions.timefn import bucket_start
from ..session import write_scratch
from .ordered import broadcast_small, join_same, with_lookback, with_rank, with_running_sum

_COMPARE = {
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}


# --- filters -------------------------------------------------------------------------


def label_filter(
    df: DataFrame,
    equal: Mapping[str, Sequence[object]] | None = None,
    not_equal: Mapping[str, Sequence[object]] | None = None,
) -> DataFrame:
    """Values of one label are alternatives; labels and exclusions must all hold."""
    tests = [F.col(c).isin(list(v)) for c, v in (equal or {}).items()]
    tests += [~F.coalesce(F.col(c).isin(list(v)), F.lit(False)) for c, v in (not_equal or {}).items()]
    return df.where(all_of(tests)) if tests else df


def line_contains(df: DataFrame, text: str, line: str = "line", case_sensitive: bool = True) -> DataFrame:
    """Rows whose line contains the literal text."""
    if case_sensitive:
        return df.where(F.col(line).contains(text))
    return df.where(F.lower(F.col(line)).contains(text.lower()))


def parse_line(df: DataFrame, fmt: str = "mixed", line: str = "line", name: str = "fields") -> DataFrame:
    """Add the fields of the line as a map; unparsable lines stay with an empty map."""
    return df.withColumn(name, line_fields(line, fmt))


def field_value(field: str, fields: str = "fields") -> Column:
    """A field's text, NULL when the line has no such field."""
    return F.try_element_at(F.col(fields), F.lit(field))


def field_filter(
    df: DataFrame, field: str, op: str, value: object = None, unit: str = "float", fields: str = "fields"
) -> DataFrame:
    """Keep rows by a field: ``=``, ``!=``, ``empty``, ``non-empty``, ``>``, ``>=``, ``<``, ``<=``.

    A missing field equals the empty text. Several values of ``=`` are alternatives,
    of ``!=`` all excluded. Comparisons read the text in its unit and drop text that
    has none.
    """
    text = F.coalesce(field_value(field, fields), F.lit(""))
    many = [str(v) for v in value] if isinstance(value, (list, tuple)) else [str(value)]
    if op == "=":
        return df.where(text.isin(many))
    if op == "!=":
        return df.where(~text.isin(many))
    if op == "empty":
        return df.where(text == "")
    if op == "non-empty":
        return df.where(text != "")
    if op in _COMPARE:
        limit = field_number(F.lit(str(value)), unit)
        return df.where(_COMPARE[op](field_number(text, unit), limit))
    raise ValueError(f"unknown operator {op!r}")


# --- volumes -------------------------------------------------------------------------


def log_volume(
    df: DataFrame, seconds: int, ts: str = "ts", by: str = "level", normalise: bool = False
) -> DataFrame:
    """Lines per bucket and level."""
    level = normalise_level(by) if normalise else F.col(by)
    return df.groupBy(bucket_start(ts, seconds).alias("bucket"), level.alias(by)).agg(
        F.count(F.lit(1)).alias("n_lines")
    )


def breakdown(df: DataFrame, label: str | Column, seconds: int, ts: str = "ts") -> DataFrame:
    """Lines per bucket and value of a label or field; empty values are left out."""
    value = (F.col(label) if isinstance(label, str) else label).cast("string")
    return (
        df.select(bucket_start(ts, seconds).alias("bucket"), value.alias("label_value"))
        .where(F.coalesce(F.col("label_value"), F.lit("")) != "")
        .groupBy("bucket", "label_value")
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )


def field_avg(
    df: DataFrame, field: str, seconds: int, unit: str = "float", ts: str = "ts", fields: str = "fields"
) -> DataFrame:
    """Mean of a numeric field per bucket; rows whose text has no such number are left out."""
    x = field_number(field_value(field, fields), unit).alias("x")
    means = df.select(bucket_start(ts, seconds).alias("bucket"), x).groupBy("bucket").agg(
        F.avg("x").alias("mean_value"), F.count("x").alias("n_lines")
    )
    return means.where(F.col("n_lines") > 0)


def sum_preaggregated(df: DataFrame, count_column: str, by: str = "level") -> DataFrame:
    """Totals of stored counts."""
    return df.groupBy(by).agg(F.sum(count_column).alias("n_lines"))


def volume_by(df: DataFrame, label: str, line: str = "line", limit: int | None = None) -> DataFrame:
    """Bytes of log text per label value, largest first; ``limit`` keeps that many."""
    size = F.sum(F.octet_length(line))
    volumes = df.groupBy(label).agg(size.alias("volume")).orderBy(F.desc("volume"), label)
    return volumes if limit is None else volumes.limit(limit)


# --- labels and fields ---------------------------------------------------------------


def _cardinality_order(name: str) -> list[Column]:
    """Fewest values first, but a single value comes last."""
    return [(F.col("cardinality") == 1).asc(), F.col("cardinality").asc(), F.col(name).asc()]


def detected_labels(df: DataFrame, labels: Sequence[str], exact: bool = False) -> DataFrame:
    """Number of different values per label, in one pass."""
    count = F.count_distinct if exact else F.approx_count_distinct
    row = df.agg(*[count(F.col(c)).alias(c) for c in labels])
    return row.unpivot([], list(labels), "label", "cardinality").orderBy(*_cardinality_order("label"))


def detected_fields(df: DataFrame, line: str = "line", exact: bool = False) -> DataFrame:
    """Fields found in the lines: cardinality, parser that found them, and type.

    A field that shows more than one type is a string.
    """
    parsed = json_map(line)
    is_json = F.ltrim(F.col(line)).startswith("{")
    by_json = F.when(is_json, parsed)
    rows = df.select(by_json.alias("j"), F.when(~is_json, logfmt_map(line)).alias("l")).select(
        F.when(F.col("j").isNotNull(), "json").otherwise("logfmt").alias("parser"),
        F.explode(F.coalesce("j", "l")).alias("field", "value"),
    )
    # Each value once per field and parser: types are then tested on distinct values only.
    seen = rows.where("value is not null").groupBy("field", "parser", "value").agg(F.lit(1).alias("one"))
    seen = seen.withColumn("kind", field_type("value"))
    cardinality = F.count_distinct("value") if exact else F.approx_count_distinct("value")
    return (
        seen.groupBy("field")
        .agg(
            cardinality.alias("cardinality"),
            F.array_join(F.array_sort(F.collect_set("parser")), ", ").alias("parser"),
            F.min("kind").alias("a"),
            F.max("kind").alias("b"),
        )
        .select(
            "field", "cardinality", "parser",
            F.when(F.col("a") == F.col("b"), F.col("a")).otherwise("string").alias("field_type"),
        )
        .orderBy(*_cardinality_order("field"))
    )


#: Paths of JSON lines whose numbers are taken in one pass.
PATHS_AT_ONCE = 100


def _leaves(kind: T.DataType, path: str = "$", readable: bool = True) -> list[tuple[str, str, bool]]:
    """``(path, type, whether variant_get can read the path)`` of all that is no object."""
    if isinstance(kind, T.StructType):
        out = []
        for f in kind.fields:
            quote = '"' if "'" in f.name else "'"
            step = f".{f.name}" if re.fullmatch(r"[A-Za-z_]\w*", f.name) else f"[{quote}{f.name}{quote}]"
            out += _leaves(f.dataType, path + step, readable and quote not in f.name)
        return out
    if isinstance(kind, T.ArrayType):
        inner = "object" if isinstance(kind.elementType, T.StructType) else _leaves(kind.elementType)[0][1]
        return [(path, f"array<{inner}>", readable)]
    names = {"void": "null", "variant": "mixed"}
    text = kind.simpleString()
    return [(path, "decimal" if text.startswith("decimal") else names.get(text, text), readable)]


def json_schema(df: DataFrame, line: str = "line") -> T.StructType | None:
    """The type that all JSON objects among the lines share, nested objects included, in one pass; None if there are none.

    Types are merged in every partition first. A field of several types is a variant, one that is always null void.
    """
    v = F.try_parse_json(line)
    found = df.where(F.ltrim(F.col(line)).startswith("{")).where(v.isNotNull()).agg(F.schema_of_variant_agg(v)).first()[0]
    if not found or not found.startswith("OBJECT<"):
        return None
    # Outside quoted names an object is a struct.
    return T.DataType.fromDDL(re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], found))


def typed_fields(df: DataFrame, line: str = "line", exact: bool = False) -> DataFrame:
    """Every path of the JSON lines, however deep: its type, the lines that have a value there, and how many different values.

    ``path`` is as ``variant_get`` takes it. Types are those of all lines together; ``mixed`` where they differ, ``decimal`` for any number
    with a fraction, ``null`` where no line has a value; an array is one path. Different values are estimated, or
    counted with ``exact``. Lines that are no JSON object have no paths, nor have names with both kinds of quotes values.
    """
    spark = df.sparkSession
    schema = json_schema(df, line)
    paths = _leaves(schema) if schema is not None else []
    count = F.count_distinct if exact else F.approx_count_distinct
    v = df.where(F.ltrim(F.col(line)).startswith("{")).select(F.try_parse_json(line).alias("v")).where("v IS NOT NULL")
    out = spark.createDataFrame([], "path string, field_type string, n_lines long, cardinality long")
    for at in range(0, len(paths), PATHS_AT_ONCE):
        part = [(i, *leaf) for i, leaf in enumerate(paths[at : at + PATHS_AT_ONCE])]
        read = {i: F.try_variant_get("v", p, "string") if readable else F.lit(None).cast("string") for i, p, _, readable in part}
        values = v.select(*[c.alias(f"p{i}") for i, c in read.items()])
        row = values.agg(*[f(f"p{i}").alias(f"{name}{i}") for i in read for name, f in (("n", F.count), ("c", count))])
        each = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(kind).alias("field_type"), F.col(f"n{i}").alias("n_lines"), F.col(f"c{i}").alias("cardinality")) for i, p, kind, _ in part])
        out = out.unionByName(row.select(F.explode(each).alias("e")).select("e.*"))
    return out


def with_typed_fields(df: DataFrame, paths: Mapping[str, str], line: str = "line") -> DataFrame:
    """Add columns: ``paths`` maps a column's name to ``(path, type)`` text such as ``$.user.id bigint``; a line is parsed once.

    NULL where a line is no JSON, lacks the path, or has another type there.
    """
    found = df.withColumn("__v", F.try_parse_json(line))
    made = {}
    for name, text in paths.items():
        path, _, kind = text.rpartition(" ")
        made[name] = F.try_variant_get("__v", path, kind)
    return found.withColumns(made).drop("__v")


def field_presence(
    df: DataFrame, field: str, fields: str = "fields", sample_rows: int | None = None
) -> DataFrame:
    """Share of lines that carry the field, in percent, and how many lines were looked at.

    ``sample_rows`` looks at that many lines only.
    """
    rows = df if sample_rows is None else df.limit(sample_rows)
    there = F.coalesce(field_value(field, fields), F.lit("")) != ""
    return rows.agg(
        F.lit(field).alias("field"),
        (F.avg(there.cast("double")) * 100).alias("percent"),
        F.count(F.lit(1)).alias("n_lines"),
    )


# --- patterns ------------------------------------------------------------------------


def log_patterns(df: DataFrame, seconds: int, ts: str = "ts", line: str = "line") -> DataFrame:
    """Lines per message template and bucket, with the template's total; largest total first.

    The total is summed from the per-bucket counts, so lines are counted once.
    """
    counts = df.groupBy(message_template(line).alias("template"), bucket_start(ts, seconds).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_lines")
    )
    totals = counts.groupBy("template").agg(F.sum("n_lines").alias("total"))
    return counts.join(totals, "template").orderBy(F.desc("total"), "template", "bucket")


def pattern_filter(
    df: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = (), line: str = "line"
) -> DataFrame:
    """Lines that match any included template and no excluded one."""
    c = F.col(line)
    tests = [any_of([c.rlike(template_regex(p)) for p in include])] if include else []
    tests += [~c.rlike(template_regex(p)) for p in exclude]
    return df.where(all_of(tests)) if tests else df


def pattern_fields(df: DataFrame, pattern: str, line: str = "line") -> DataFrame:
    """Values in the holes of a template, per hole with their counts."""
    holes = pattern.count(HOLE)
    regex = template_regex(pattern, capture=True)
    matched = df.where(F.col(line).rlike(regex))
    values = F.array(
        *[
            F.struct(F.lit(f"field_{i}").alias("field"), F.regexp_extract(F.col(line), regex, i).alias("value"))
            for i in range(1, holes + 1)
        ]
    )
    return (
        matched.select(F.explode(values).alias("v"))
        .groupBy("v.field", "v.value")
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )


# --- series over time ----------------------------------------------------------------


def sort_series(
    df: DataFrame, series: str, value: str, by: str = "stddev", descending: bool = True, ts: str = "bucket"
) -> DataFrame:
    """Series with their sort value, in order.

    ``by`` is stddev, sum, max, min, count, pNN (a percentile), name, changepoint or outliers.
    """
    if by == "name":
        scored = df.groupBy(series).agg(F.lit(None).cast("double").alias("sort_value"))
    elif by == "changepoint":
        scored = changepoint_count(df, series, ts, value).select(
            series, F.col("changepoints").cast("double").alias("sort_value")
        )
    elif by == "outliers":
        scored = outlier_series(df, series, ts, value).select(
            series, F.col("outlier_intervals").cast("double").alias("sort_value")
        )
    else:
        reducers = {
            "stddev": F.stddev_pop(value), "sum": F.sum(value), "max": F.max(value),
            "min": F.min(value), "count": F.count(value),
        }
        if re.fullmatch(r"p\d{1,2}", by):
            reducers[by] = F.percentile_approx(value, int(by[1:]) / 100, 10000)
        scored = df.groupBy(series).agg(reducers[by].cast("double").alias("sort_value"))
    key = F.col(series) if by == "name" else F.col("sort_value")
    first = key.desc_nulls_last() if descending else key.asc_nulls_last()
    return scored.orderBy(first, F.col(series))


def thin_points(df: DataFrame, series: str, ts: str, value: str, points: int = 150) -> DataFrame:
    """Each series reduced to at most ``points`` points: bins of equal count in time, the first point of each."""
    ranked = with_rank(df.select(series, ts, value), [series], [ts], "__rank")
    lengths = df.groupBy(series).agg(F.count(F.lit(1)).alias("__len"))
    bins = F.least(F.col("__len"), F.lit(points))
    placed = join_same(ranked, broadcast_small(lengths), [series], "inner").withColumn(
        "__bin", F.floor((F.col("__rank") - 1) * bins / F.col("__len"))
    )
    first = placed.groupBy(series, "__bin").agg(F.min(F.struct(ts, value)).alias("__p"))
    return first.select(series, f"__p.{ts}", f"__p.{value}")


def run_length_changes(x: np.ndarray, hazard: float = 1 / 100) -> int:
    """Change points of a short series by Bayesian online detection (Adams & MacKay 2007).

    Values are standardised; the observation model is normal with unknown mean and
    variance (prior mean 0, strength 1, shape 1, scale 0.1). A change is counted where
    the most likely run length drops.
    """
    if len(x) < 3 or not x.std() > 0:
        return 0
    x = (x - x.mean()) / x.std()
    mean, strength, shape, scale = np.zeros(1), np.ones(1), np.ones(1), np.full(1, 0.1)
    weight = np.ones(1)
    changes, last = 0, 0
    for value in x:
        # Student-t density of the value under each run length.
        spread = scale * (strength + 1) / (shape * strength)
        norm = np.array([math.lgamma(a + 0.5) - math.lgamma(a) for a in shape])
        likely = np.exp(
            norm
            - 0.5 * np.log(2 * np.pi * shape * spread)
            - (shape + 0.5) * np.log1p((value - mean) ** 2 / (2 * shape * spread))
        )
        joint = weight * likely
        weight = np.append(joint.sum() * hazard, joint * (1 - hazard))
        weight /= max(weight.sum(), 1e-300)
        moved = scale + strength * (value - mean) ** 2 / (2 * (strength + 1))
        mean = np.append(0.0, (strength * mean + value) / (strength + 1))
        scale = np.append(0.1, moved)
        strength = np.append(1.0, strength + 1)
        shape = np.append(1.0, shape + 0.5)
        run = int(np.argmax(weight))
        changes += run < last
        last = run
    return changes


def changepoint_count(
    df: DataFrame, series: str, ts: str, value: str, points: int = 150, hazard: float = 1 / 100
) -> DataFrame:
    """Change points per series, after reducing it to at most ``points`` points (so a group is small)."""
    kind = dict(df.dtypes)[series]

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values(ts)[value].dropna().to_numpy(dtype="float64")
        return pd.DataFrame({series: [pdf[series].iloc[0]], "changepoints": [run_length_changes(x, hazard)]})

    # Written once: the input, often an aggregate, is read for lengths and for ranks.
    thin = thin_points(write_scratch(df.select(series, ts, value), "points"), series, ts, value, points)
    return thin.groupBy(series).applyInPandas(count, f"`{series}` {kind}, changepoints int")


def outlier_series(
    df: DataFrame,
    series: str,
    ts: str,
    value: str,
    sensitivity: float = 0.4,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Runs of time steps in which a series lies outside the crowd, per series.

    At each step the values are clustered by density in one dimension: sorted values
    that lie within ``eps`` of each other belong together. A value is outlying unless
    its cluster holds at least half of the step's series. ``eps`` is the deviation of all
    values times (1 - sensitivity). Consecutive outlying steps of a series make one
    interval.
    """
    # Written once, as it is ordered by a number that a second evaluation might round otherwise.
    rows = write_scratch(df.select(series, ts, F.col(value).cast("double").alias("__v")).where("__v is not null"), "values")
    eps = rows.agg(F.stddev_pop("__v")).scalar() * F.lit(1 - sensitivity)
    order = ["__v", series]
    gaps = with_lookback(rows, [ts], order, 1, {"__prev": lambda w: F.lag("__v").over(w)}, chunk_rows)
    starts = F.when(F.col("__prev").isNull() | (F.col("__v") - F.col("__prev") > eps), 1).otherwise(0)
    tagged = with_running_sum(gaps, [ts], order, {"__cluster": starts}, chunk_rows)
    tagged = write_scratch(tagged.select(series, ts, "__cluster"), "clusters")
    sizes = tagged.groupBy(ts, "__cluster").agg(F.count(F.lit(1)).alias("__size"))
    steps = sizes.join(sizes.groupBy(ts).agg(F.sum("__size").alias("__all")), ts)
    marked = tagged.join(broadcast_small(steps), [ts, "__cluster"]).select(
        series, ts, F.when(F.col("__size") * 2 < F.col("__all"), 1).otherwise(0).alias("__out")
    )
    turns = with_lookback(marked, [series], [ts], 1, {"__was": lambda w: F.lag("__out").over(w)}, chunk_rows)
    opened = (F.col("__out") == 1) & (F.coalesce("__was", F.lit(0)) == 0)
    return turns.groupBy(series).agg(
        F.count_if(opened).alias("outlier_intervals"), F.sum("__out").alias("outlier_steps")
    )
