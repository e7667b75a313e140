"""Lines that many sites share, found by sketches of the sites of each line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import side
from sensorloom.llm.host_rules import BLANKS
from sensorloom.session import write_scratch

#: Registers of a sketch, as a power of two: a standard error of 1.04 / 64.
SKETCH = 12
#: A sketch within this share of the threshold is not trusted: four standard errors and some.
NEAR = 0.08


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _solid(line: Column) -> Column:
    """The line without white space at its ends."""
    return F.trim(F.translate(line, BLANKS, " " * len(BLANKS)))


def line_table(docs: DataFrame, text: str = "text", site: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """Every line with a word: two 64-bit hashes of it, ``doc``, ``pos`` and ``site``; null is a site of its own."""
    named = docs.select(
        F.col(doc_id).alias("doc"),
        F.coalesce(F.concat(F.lit("s"), F.col(site)), F.lit("n")).alias("site"),
        F.posexplode(_lines(F.col(text))).alias("pos", "line"),
    )
    named = named.withColumn("line", _solid(F.col("line"))).where("line <> ''")
    return named.select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2"), "doc", "pos", "site")


def spread_lines(lines: DataFrame, sites: int) -> DataFrame:
    """The lines on ``sites`` sites or more: hashes, ``n_sites``, whether that is ``exact``, and the
    first place (``doc``, ``pos``).

    A sketch of its sites and the first place are kept for each line and merged before and after
    the shuffle, so that a line in every document is one row per task. Lines whose sketch lies
    near the threshold have their distinct sites counted.
    """
    keys = ["h1", "h2"]
    each = lines.groupBy(*keys).agg(
        F.hll_sketch_agg("site", F.lit(SKETCH)).alias("sketch"), F.min(F.struct("doc", "pos")).alias("first"), F.count("*").alias("n")
    )
    # A line has at least as many lines as sites: one below the threshold needs no estimate.
    found = each.where(F.col("n") >= sites).select(*keys, F.hll_sketch_estimate("sketch").alias("about"), "first")
    found = write_scratch(found.where(F.col("about") >= sites * (1 - NEAR) - 1), "line_sites")
    near = found.where(F.col("about") <= sites * (1 + NEAR) + 1)
    exact = (
        lines.join(side(write_scratch(near.select(*keys), "near_lines")), keys, "left_semi")
        .select(*keys, "site").distinct().groupBy(*keys).agg(F.count("*").alias("n_sites"))
    )
    sure = found.where(F.col("about") > sites * (1 + NEAR) + 1).select(*keys, F.col("about").alias("n_sites"), F.lit(False).alias("exact"), "first.*")
    counted = near.join(exact, keys).where(F.col("n_sites") >= sites).select(*keys, "n_sites", F.lit(True).alias("exact"), "first.*")
    return sure.union(counted)


def removals(docs: DataFrame, sites: int = 10, text: str = "text", site: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """``doc``, ``pos`` and ``first_doc`` of every line to remove: lines on ``sites`` sites or more, but for their first place.

    The first place is that of the smallest doc_id, so that no text is lost altogether.
    """
    lines = write_scratch(line_table(docs, text, site, doc_id), "lines")
    spread = write_scratch(spread_lines(lines, sites), "spread_lines")
    spread = side(spread.select("h1", "h2", F.col("doc").alias("first_doc"), F.col("pos").alias("first_pos")), 300_000)
    hit = lines.join(spread, ["h1", "h2"])
    return hit.where(~(F.col("doc").eqNullSafe(F.col("first_doc")) & (F.col("pos") == F.col("first_pos")))).select("doc", "pos", "first_doc")


def line_report(docs: DataFrame, sites: int = 10, text: str = "text", site: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """One row per document that loses lines: doc_id, n_removed and the documents that keep them.

    Rows of one doc_id are one document. Null and empty texts have no lines; an empty table
    gives no row; repeated lines of one document are removed with the others.
    """
    gone = removals(docs, sites, text, site, doc_id)
    return gone.groupBy("doc").agg(F.countDistinct("pos").alias("n_removed"), F.min("first_doc").alias("first_doc")).select(
        F.col("doc").alias("doc_id"), "n_removed", "first_doc"
    )


def without_spread_lines(docs: DataFrame, sites: int = 10, text: str = "text", site: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the lines that :func:`removals` names, with the same columns.

    Documents that lose nothing stay as they are; those that lose all their words go. Of several
    rows with one doc_id each loses the lines at the named places. Only places travel: a
    document's are gathered, at most one per line of its own.
    """
    names = docs.columns
    inner = docs.toDF(*[f"k{i}" for i in range(len(names))])
    t, s, d = (f"k{names.index(x)}" for x in (text, site, doc_id))
    gone = removals(inner, sites, t, s, d).groupBy("doc").agg(F.collect_set("pos").alias("__gone"))
    gone = write_scratch(gone.select(F.col("doc").alias("__doc"), "__gone"), "gone_lines")
    # Places grow with the documents: the same plan at every size.
    joined = inner.join(gone.hint("merge"), F.col(d).eqNullSafe(F.col("__doc")), "left")
    lines = _lines(F.col(t))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "__gone")
    left = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    text_left = F.when(F.col("__gone").isNull(), F.col(t)).otherwise(left)
    kept = joined.withColumn("__left", text_left)
    kept = kept.where(F.col("__gone").isNull() | (F.length(_solid(F.col("__left"))) > 0))
    return kept.select(*[(F.col("__left") if f"k{i}" == t else F.col(f"k{i}")).alias(c) for i, c in enumerate(names)])
