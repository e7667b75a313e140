"""Message text to typed columns, and tolerant casts."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FRACTIONAL = (T.DoubleType, T.FloatType)
_NUMERIC = (*_FRACTIONAL, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def is_fractional(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, _FRACTIONAL)


def no_nan(c: str | Column) -> Column:
    """NaN becomes NULL, so that both forms of a missing reading act alike."""
    return F.nanvl(as_col(c).cast("double"), F.lit(None).cast("double"))


def number(c: str | Column) -> Column:
    """Text to double; text that is no number becomes NULL instead of an error."""
    return as_col(c).try_cast("double")


def message_text(value: str | Column = "value") -> Column:
    """Message bytes as UTF-8 text."""
    return as_col(value).cast("string")


def parse_message(
    df: DataFrame, schema: T.StructType | str, value: str | Column = "value", corrupt: str | None = None
) -> DataFrame:
    """Parse a JSON message once into the typed columns of ``schema``.

    Text that does not parse gives NULL columns; with ``corrupt`` the text itself
    is kept under that name so the row can be quarantined.
    """
    # Without options Spark parses only the fields that are used.
    options = {}
    if corrupt:
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt
    parsed = F.from_json(message_text(value), schema, options)
    return df.select(parsed.alias("data")).select("data.*")


def expand_struct(df: DataFrame, column: str) -> DataFrame:
    """Replace a struct column by its fields."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, f"{column}.*")


def legacy_regex_extract(raw: str | Column, key: str, kind: str = "number") -> Column:
    """One key of a flat JSON text by pattern, as text; NULL when it is missing.

    ``kind`` is ``string`` (quoted text), ``number`` (unsigned, so signs and
    exponents are lost) or ``digits``. Prefer :func:`parse_message`.
    """
    tail = {"string": '"([^"]*)"', "number": "([0-9.]+)", "digits": "([0-9]+)"}[kind]
    pattern = f'"{re.escape(key)}"\\s*:\\s*{tail}'
    return F.nullif(F.regexp_extract(as_col(raw), pattern, 1), F.lit(""))


def flag(condition: Column) -> Column:
    """1 where the condition holds, otherwise 0 (also when it is unknown)."""
    return F.when(condition, 1).otherwise(0)


def map_label(c: str | Column, positive: object = -1) -> Column:
    """1 for the value that means anomaly, 0 for every other value."""
    return flag(as_col(c) == F.lit(positive))


def json_map(line: str | Column) -> Column:
    """A JSON object line as a text map; NULL if the line is no JSON object."""
    return F.from_json(as_col(line), T.MapType(T.StringType(), T.StringType()))


def logfmt_map(line: str | Column) -> Column:
    """``key=value key="quoted value"`` pairs as a text map; the last of equal keys wins."""
    line = as_col(line)
    pair = F.lit(r'([A-Za-z_][\w.\-]*)=(?:"((?:[^"\\]|\\.)*)"|([^\s"]*))')
    part = lambda i: F.regexp_extract_all(line, pair, F.lit(i))
    # Of the quoted and the bare form one is empty.
    values = F.zip_with(part(2), part(3), lambda quoted, bare: F.concat(quoted, bare))
    found = F.struct(part(1).alias("k"), values.alias("v"))

    def as_map(kv: Column) -> Column:
        keys, vals = kv["k"], kv["v"]
        last = F.map_from_entries(
            F.filter(
                F.arrays_zip(keys.alias("k"), vals.alias("v")),
                lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["k"]),
            )
        )
        distinct = F.size(F.array_distinct(keys)) == F.size(keys)
        return F.when(distinct, F.map_from_arrays(keys, vals)).otherwise(last)

    return let(found, as_map)


def line_fields(line: str | Column, fmt: str = "mixed") -> Column:
    """Fields of a log line as a map; an unparsable line keeps an empty map."""
    empty = F.create_map().cast("map<string,string>")
    if fmt == "json":
        return F.coalesce(json_map(line), empty)
    if fmt == "logfmt":
        return F.coalesce(logfmt_map(line), empty)
    if fmt == "mixed":
        parsed = json_map(line)
        looks_json = F.ltrim(as_col(line)).startswith("{")
        return F.coalesce(F.when(looks_json, parsed).otherwise(logfmt_map(line)), empty)
    raise ValueError(f"unknown line format {fmt!r}")
