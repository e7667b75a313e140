"""Log text: levels, units and message patterns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parsing import as_col, let

# Spellings of log levels and the level each stands for.
LEVELS = {
    "critical": "critical",
    "crit": "critical",
    "error": "error",
    "err": "error",
    "eror": "error",
    "warning": "warning",
    "warn": "warning",
    "info": "info",
    "debug": "debug",
    "trace": "trace",
}
LEVEL_ORDER = ["critical", "error", "warning", "info", "debug", "trace"]

# Factors of the units a field may carry.
BYTE_UNITS = {
    "b": 1, "kb": 10**3, "mb": 10**6, "gb": 10**9, "tb": 10**12,
    "kib": 2**10, "mib": 2**20, "gib": 2**30, "tib": 2**40,
}
SECOND_UNITS = {"ns": 1e-9, "us": 1e-6, "µs": 1e-6, "ms": 1e-3, "s": 1.0, "m": 60.0, "h": 3600.0}

HOLE = "<_>"

_BYTES = r"^([+-]?\d+(?:\.\d+)?)\s*((?i:[kmgt]?i?b))$"
_DURATION = r"^[+-]?(?:\d+(?:\.\d+)?(?:ns|us|µs|ms|s|m|h))+$"


def _lookup(table: dict[str, object], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def normalise_level(c: str | Column, default: str = "unknown") -> Column:
    """One spelling per log level."""
    return F.coalesce(_lookup(LEVELS, F.lower(F.trim(as_col(c)))), F.lit(default))


def level_rank(c: str | Column) -> Column:
    """0 for the most severe level; unknown levels come last."""
    ranks = {name: i for i, name in enumerate(LEVEL_ORDER)}
    return F.coalesce(_lookup(ranks, as_col(c)), F.lit(len(LEVEL_ORDER)))


def bytes_number(c: str | Column) -> Column:
    """``1.5KB`` or ``2 MiB`` as a number of bytes; NULL if it is no such text."""
    text = F.lower(F.trim(as_col(c)))
    amount = F.regexp_extract(text, _BYTES, 1).try_cast("double")
    return amount * _lookup({k: float(v) for k, v in BYTE_UNITS.items()}, F.regexp_extract(text, _BYTES, 2))


def duration_seconds(c: str | Column) -> Column:
    """``1h2m3.5s`` or ``250ms`` as seconds; NULL if it is no such text."""
    text = F.trim(as_col(c))
    part = r"(\d+(?:\.\d+)?)(ns|us|µs|ms|s|m|h)"
    whole = text.rlike(_DURATION)
    parts = F.regexp_extract_all(text, F.lit(part), F.lit(0))
    total = F.aggregate(
        parts,
        F.lit(0.0),
        lambda acc, p: acc
        + F.regexp_extract(p, part, 1).try_cast("double")
        * _lookup(SECOND_UNITS, F.regexp_extract(p, part, 2)),
    )
    return F.when(whole, F.when(text.startswith("-"), -total).otherwise(total))


def field_number(c: str | Column, unit: str = "float") -> Column:
    """A field's text as a number in its unit: float, bytes or duration."""
    if unit == "float":
        return F.trim(as_col(c)).try_cast("double")
    if unit == "bytes":
        return let(as_col(c), bytes_number)
    if unit == "duration":
        return let(as_col(c), duration_seconds)
    raise ValueError(f"unknown unit {unit!r}")


def field_type(c: str | Column) -> Column:
    """Type a field's text looks like: float, bytes, duration or string."""
    text = F.trim(as_col(c))
    return (
        F.when(text.try_cast("double").isNotNull(), "float")
        .when(text.rlike(_BYTES), "bytes")
        .when(text.rlike(_DURATION), "duration")
        .otherwise("string")
    )


def message_template(c: str | Column) -> Column:
    """The line with its variable parts (quoted values, hex, numbers) as ``<_>``."""
    masked = F.regexp_replace(as_col(c), r"(?<=[:=]\s?)\"[^\"]*\"", HOLE)
    masked = F.regexp_replace(masked, r"\b0[xX][0-9a-fA-F]+\b|\b(?=[a-fA-F]*\d)[0-9a-fA-F]{8,}\b", HOLE)
    masked = F.regexp_replace(masked, r"\d+(?:\.\d+)*", HOLE)
    return F.regexp_replace(masked, r"<_>(?:[.,:\-]?<_>)+", HOLE)


def template_regex(template: str, capture: bool = False) -> str:
    """A template as a regular expression that matches the whole line."""
    hole = "(.*?)" if capture else ".*?"
    return "(?s)^" + hole.join(re.escape(p) for p in template.split(HOLE)) + "$"
