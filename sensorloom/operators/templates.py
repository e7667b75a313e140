"""Message templates mined from log lines: a token tree of fixed depth, built from counts.

Masks alone (numbers, hex, quoted values) split lines whose words vary. Here lines go down a tree: first by their
number of tokens, then token by token. A node with many different tokens keeps those that hold a good share of its lines and
calls the rest a hole. Behind the tree, each place of a leaf does the same. All decisions follow from counts, which are added up in every
partition before they are merged, so that neither the order of lines nor their partitions change a template.

Lines are masked and counted first; the tree sees each masked line once, with its number. Tables of decisions have at most
``max(max_children, 1 / min_share)`` rows for a node, and are broadcast only after a check of their size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.logtext import HOLE, message_template
from ..session import write_scratch
from .ordered import broadcast_small, join_same


def _kept(counts: DataFrame, node: list[str], max_children: int, min_share: float) -> DataFrame:
    """``node, token`` of the tokens that stay: all of a place with few, else those with a share of its lines."""
    totals = counts.groupBy(*node).agg(F.sum("n").alias("__all"), F.count(F.lit(1)).alias("__kinds"))
    crowded = totals.where(F.col("__kinds") > max_children)
    both = counts.join(broadcast_small(crowded), node, "left")
    stays = F.col("__all").isNull() | (F.col("n") >= F.lit(min_share) * F.col("__all"))
    return both.where(stays).select(*node, "token")


def line_templates(
    df: DataFrame, line: str = "line", depth: int = 3, max_children: int = 20, min_share: float = 0.05, masked: bool = True
) -> DataFrame:
    """``masked, template, n_lines`` for every different masked line.

    ``masked`` is the line with numbers, hex and quoted values as holes, or the line itself. Tokens lie between white space. The first
    ``depth`` tokens are levels of the tree; of a place with more than ``max_children`` different tokens those stay that
    hold ``min_share`` of its lines, the others become ``<_>``. Missing lines have no template; a blank one has the empty one.
    """
    text = F.trim(message_template(line) if masked else F.col(line))
    lines = df.where(F.col(line).isNotNull()).groupBy(text.alias("masked")).agg(F.count(F.lit(1)).alias("n_lines"))
    lines = lines.withColumn("__tokens", F.split("masked", r"\s+"))
    lines = write_scratch(lines.withColumn("__node", F.concat(F.size("__tokens").cast("string"), F.lit(" tokens"))), "masked_lines")
    for level in range(depth):
        # Shorter lines are leaves already.
        here = lines.where(F.size("__tokens") > level).select(F.col("__node").alias("node"), F.get("__tokens", F.lit(level)).alias("token"), "n_lines")
        counts = write_scratch(here.groupBy("node", "token").agg(F.sum("n_lines").alias("n")), "node_tokens")
        kept = broadcast_small(_kept(counts, ["node"], max_children, min_share).select(F.col("node").alias("__node"), F.col("token").alias("__token"), F.lit(True).alias("__stays")))
        token = F.get("__tokens", F.lit(level))
        lines = lines.withColumn("__token", token).join(kept, ["__node", "__token"], "left")
        child = F.concat("__node", F.lit("\n"), F.when(F.col("__stays"), F.col("__token")).otherwise(HOLE))
        lines = lines.withColumn("__node", F.when(F.col("__token").isNotNull(), child).otherwise(F.col("__node"))).drop("__token", "__stays")
        lines = write_scratch(lines, "tree_level")

    places = lines.select(F.col("__node").alias("node"), "n_lines", F.posexplode("__tokens").alias("place", "token")).where(F.col("place") >= depth)
    counts = write_scratch(places.groupBy("node", "place", "token").agg(F.sum("n_lines").alias("n")), "leaf_tokens")
    kept = _kept(counts, ["node", "place"], max_children, min_share)
    # One row per leaf: the texts "place token" that stay, as many as its places allow.
    stays = kept.groupBy(F.col("node").alias("__node")).agg(F.collect_set(F.concat_ws(" ", F.col("place").cast("string"), "token")).alias("__stay"))
    out = lines.join(broadcast_small(stays, 10_000), "__node", "left")
    return out.select("masked", _template(depth).alias("template"), "n_lines")


def _template(depth: int) -> Column:
    """The levels as the tree has them, then each token that stays at its place."""
    levels = F.slice(F.split("__node", "\n"), 2, depth)
    rest = F.transform(
        "__tokens",
        lambda t, i: F.when((i < depth) | F.array_contains("__stay", F.concat_ws(" ", i.cast("string"), t)), t).otherwise(HOLE),
    )
    behind = F.when(F.size("__tokens") > depth, F.slice(rest, depth + 1, F.size("__tokens"))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(levels, behind), " ")


def mined_templates(df: DataFrame, line: str = "line", **options) -> DataFrame:
    """``template, n_lines, n_forms, example``: how many lines and different masked lines a template has, and the least of these."""
    found = line_templates(df, line, **options)
    return found.groupBy("template").agg(
        F.sum("n_lines").alias("n_lines"), F.count(F.lit(1)).alias("n_forms"), F.min("masked").alias("example")
    )


def with_template(df: DataFrame, line: str = "line", name: str = "template", masked: bool = True, **options) -> DataFrame:
    """Every line with its template; NULL for missing lines."""
    found = broadcast_small(line_templates(df, line, masked=masked, **options).select(F.col("masked").alias("__masked"), F.col("template").alias(name)))
    text = F.trim(message_template(line) if masked else F.col(line))
    return join_same(df.withColumn("__masked", text), found, ["__masked"]).drop("__masked")
