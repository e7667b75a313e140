"""Quality rules with a verdict for each host, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import key_of, side
from sensorloom.session import write_scratch

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Space, tab and line breaks: what parts words.
BLANKS = " \t\n\x0b\x0c\r"


def _repeated_at() -> Column:
    """Where the runs of three words that occur twice or more begin, from the sorted runs ``__same``."""
    same = F.col("__same")
    hit = F.filter(
        same,
        lambda x, k: (x["h"] == F.get(same, k - 1)["h"]) | (x["h"] == F.get(same, k + 1)["h"]),
    )
    return F.sort_array(F.transform(hit, lambda x: x["i"]))


def text_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (all long).

    Null text has no words. Runs of three words are told apart by a 64-bit hash within one text;
    only texts that repeat a run are sorted. Everything is an expression on one row: no shuffle.
    The names of the five columns, and names that begin with ``__``, are overwritten.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    words = F.array_remove(F.split(F.translate(t, BLANKS[1:], " " * (len(BLANKS) - 1)), " "), "")
    df = docs.withColumns({"__words": words, "__lines": lines})
    w, n = F.col("__words"), F.size("__words")
    tri = F.when(
        n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    )
    df = df.withColumns({"__tri": tri})
    again = F.size(F.array_distinct("__tri")) < F.size("__tri")
    df = df.withColumns({
        "__same": F.when(again, F.sort_array(F.transform("__tri", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    })
    df = df.withColumns({"__hit": _repeated_at()})
    hit = F.col("__hit")
    covered = F.aggregate(
        F.transform(hit, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(hit, k + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x
    )
    solid = F.translate(t, BLANKS, "")
    df = df.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(solid).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
    })
    return df.drop("__words", "__lines", "__tri", "__same", "__hit")


def base_failed() -> Column:
    """Fewer than 50 words, or over half of them in repeated runs."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rule_failed() -> Column:
    """What counts against a host: the base rules, many symbols, or mostly repeated lines."""
    return (
        base_failed()
        | (10 * F.col("n_symbols") > F.col("word_chars"))
        | (F.col("word_chars") > 20 * F.col("n_words"))
    )


def host_verdicts(measured: DataFrame, host: str = "source", worst: float = 0.8) -> DataFrame:
    """One row per host: ``n``, ``failed``, the shrunken ``rate`` and ``host_failed``.

    The prior is a beta distribution fitted to the hosts' own rates by moments: a host of few
    documents is judged by the corpus, one of many by itself. A host fails above ``worst``.
    Null is a host of its own. Counts are summed before the shuffle; the prior is two numbers.
    """
    hosts = measured.groupBy(*key_of(host)).agg(F.count("*").alias("n"), F.sum(rule_failed().cast("long")).alias("failed"))
    hosts = write_scratch(hosts, "hosts")
    n, f, squares = hosts.agg(F.sum("n"), F.sum("failed"), F.sum(F.col("failed") * F.col("failed") / F.col("n"))).first()
    mean = f / n if n else 0.0
    spread = max(squares / n - mean * mean, 0.0) if n else 0.0
    strength = min(max(mean * (1 - mean) / spread - 1, 1.0), 1e6) if spread > 1e-12 else 1e6
    rate = (F.col("failed") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))
    return hosts.withColumn("rate", rate).withColumn("host_failed", F.col("rate") > worst)


def judged(docs: DataFrame, text: str = "text", host: str = "source", worst: float = 0.8, carry: list[str] | None = None) -> DataFrame:
    """Each row's measures, ``base_failed`` and ``kept``; ``carry`` names the columns to keep with them.

    ``kept`` is false for rows that fail the base rules and for all rows of a host that fails.
    Measures are written once, as both the hosts and the rows read them. Only failing hosts are
    joined back: by broadcast if they are few, else by a shuffle on the host, which adaptive
    execution splits where one host is large. An empty table gives an empty result; rows that
    repeat are judged each.
    """
    out = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    carry = list(carry or ["doc_id"])
    measured = text_measures(docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)], F.col(host).alias("__host"), F.col(text).alias("__text")), "__text")
    # A rejected row's long text is not needed again.
    held = [F.when(~base_failed(), F.col(f"c{i}")).alias(f"c{i}") if c == text else F.col(f"c{i}") for i, c in enumerate(carry)]
    measured = write_scratch(measured.select(*held, "__host", *out).withColumn("base_failed", base_failed()), "measures")
    bad = host_verdicts(measured, "__host", worst).where("host_failed").select("__host__null", "__host__text", F.lit(True).alias("__bad"))
    keyed = measured.select("*", *key_of("__host"))
    joined = keyed.join(side(write_scratch(bad, "bad_hosts"), 100_000), ["__host__null", "__host__text"], "left")
    kept = ~F.col("base_failed") & F.col("__bad").isNull()
    return joined.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], *out, "base_failed", kept.alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", worst: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that :func:`judged` keeps, with the columns of ``docs``.

    Measures that clash with a column's name take nothing from it: columns are carried under
    other names.
    """
    names = docs.columns
    inner = docs.toDF(*[f"k{i}" for i in range(len(names))])
    t, h = f"k{names.index(text)}", f"k{names.index(host)}"
    return judged(inner, t, h, worst, inner.columns).where("kept").select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(names)])
