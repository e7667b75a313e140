"""Mixing sources to target weights: whole passes, then documents whose lengths fill the rest."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorloom.llm.common import key_of, ranked, side
from sensorloom.llm.host_rules import BLANKS
from sensorloom.operators.ordered import join_same
from sensorloom.session import write_scratch

#: Budgets up to this many words are filled by dynamic programming alone; so many words of a larger one are
#: kept for it, and the rest is filled by taking the same share of every length, then the longest documents that fit.
EXACT_WORDS = 1 << 15


def fill(lengths: Sequence[int], counts: Sequence[int], budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come to ``budget`` or little less.

    Three steps: of what is over ``EXACT_WORDS`` the same share of every length, rounded down; the longest lengths
    that still fit, until ``EXACT_WORDS`` or less is open; a bounded knapsack over the rest, exact for what is open. So
    a budget of up to ``EXACT_WORDS`` is filled as well as can be. Work depends on the number of lengths, not of documents.
    """
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    take = np.zeros(len(lengths), np.int64)
    total = sum(int(a) * int(b) for a, b in zip(lengths, counts, strict=True))
    if budget >= total:
        return counts.copy()
    if budget <= 0:
        return take
    take[:] = [int(c) * max(0, budget - EXACT_WORDS) // total for c in counts]
    left = budget - sum(int(a) * int(b) for a, b in zip(lengths, take, strict=True))
    for at in np.argsort(-lengths, kind="stable"):
        if left <= EXACT_WORDS:
            break
        if lengths[at] > 0:
            more = min(int(counts[at] - take[at]), (left - EXACT_WORDS) // int(lengths[at]))
            take[at] += more
            left -= more * int(lengths[at])
    # Words that some choice of the rest comes to; for each, the item that reached it first and
    # how many of it, so that the choice can be read back.
    open_ = [(int(n), int(c - k), i) for i, (n, c, k) in enumerate(zip(lengths, counts, take, strict=True)) if 0 < n <= left and c > k]
    if not open_:
        return take
    left = int(min(left, sum(n * c for n, c, _ in open_)))
    reached = np.full(left + 1, -1, np.int64)  # -2: nothing taken; else the item
    reached[0] = -2
    used = np.zeros(left + 1, np.int64)
    for n, c, i in sorted(open_, reverse=True):
        if reached[left] != -1:
            break
        c = min(c, left // n)
        # Multiples 1, 2, 4, ... of one length, each at most once, give every number up to c.
        piece = 1
        while c > 0:
            piece = min(piece, c)
            step = piece * n
            if step <= left:
                new = (reached[: left + 1 - step] != -1) & (reached[step:] == -1)
                at = np.flatnonzero(new) + step
                reached[at], used[at] = i, piece
            c -= piece
            piece *= 2
    at = int(np.flatnonzero(reached != -1)[-1])
    while at:
        i, k = int(reached[at]), int(used[at])
        take[i] += k
        at -= k * int(lengths[i])
    return take


def target_words(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``sources`` (keys and ``source_size``) with each one's ``target`` in words.

    Sources in code point order, null last, have the weights in turn, and together ``share`` of
    all words. A target stops at ``most`` times its source's words; what is above goes to the
    others by weight, until no target is above. Each round is one sum over the sources.
    """
    keys = ["source__null", "source__text"]
    named = ranked(sources, keys, "__place", "sources")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("__place") % len(weights) + 1).cast("int"))
    rows = write_scratch(named.withColumn("__w", w).withColumn("__top", F.col("source_size") * F.lit(float(most))), "sources")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    budget, level, full = total * share, 0.0, -1
    while True:
        capped = F.col("__w") * F.lit(level) >= F.col("__top")
        n, held, open_ = rows.agg(
            F.sum(capped.cast("long")), F.sum(F.when(capped, F.col("__top"))), F.sum(F.when(~capped, F.col("__w")))
        ).first()
        if n == full or not open_ or n is None:
            break
        full, level = n, (budget - (held or 0.0)) / open_
    target = F.least(F.col("__w") * F.lit(level), F.col("__top")) if open_ else F.col("__top")
    return rows.select(*keys, "source_size", target.alias("target"))


def mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
    seed: int = 0, text: str = "text", source: str = "source", doc_id: str = "doc_id",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, copies and taken (words).

    A source's documents are taken whole as often as its target allows; what is left of the
    target is filled with one more copy of some: documents are counted by length, the counts
    fitted to the budget by :func:`fill`, and of each length those first in a seeded order taken.
    No source or length is gathered: a document's place within its length is its place in one
    global order less the place where the length begins. Rows that repeat an id, or have none, are documents of
    their own; null text has no words and is never taken.
    """
    found = _placed_copies(docs, weights, share, most, seed, text, source, doc_id)
    return found.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _size(text: str) -> Column:
    """Words of a text."""
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), BLANKS, " " * len(BLANKS))
    return F.size(F.array_remove(F.split(plain, " "), "")).cast("long")


def _placed_copies(
    docs: DataFrame, weights: Sequence[float], share: float, most: float, seed: int, text: str, source: str, doc_id: str
) -> DataFrame:
    """The rows of :func:`mix` with the keys of their source."""
    # Dealing rows by range reads them twice; words are counted once.
    slim = write_scratch(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), _size(text).alias("size")), "sizes")
    slim = slim.select("doc_id", "size", *key_of("source"), F.xxhash64(F.lit(seed), "doc_id").alias("__luck"))
    keys = ["source__null", "source__text"]
    placed = write_scratch(ranked(slim, [*keys, "size", "__luck", "doc_id"], "__place", "by_length"), "placed")
    lengths = write_scratch(placed.groupBy(*keys, "size").agg(F.count("*").alias("n"), F.min("__place").alias("first")), "lengths")
    sources = lengths.groupBy(*keys).agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = write_scratch(target_words(sources, weights, share, most), "targets")

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ignore_index=True)
        total, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        passes = int(target // total) if total else 0
        pdf["take"] = fill(pdf["size"].to_numpy(), pdf["n"].to_numpy(), round(target) - passes * total)
        pdf["passes"] = passes
        return pdf[[*keys, "size", "first", "source_size", "target", "passes", "take"]]

    plan = lengths.join(side(targets, 100_000), keys).groupBy(*keys).applyInPandas(
        choose, "source__null boolean, source__text string, size long, first long, source_size long, target double, passes long, take long"
    )
    plan = write_scratch(plan, "plan")
    copies = F.when(F.col("size") > 0, F.col("passes") + (F.col("__place") - F.col("first") < F.col("take")).cast("long")).otherwise(0)
    found = placed.join(side(plan, 200_000), [*keys, "size"]).withColumn("copies", copies.cast("long"))
    return found.select("doc_id", "size", "source_size", "target", "copies", *keys)


def mixed(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
    seed: int = 0, text: str = "text", source: str = "source", doc_id: str = "doc_id",
) -> DataFrame:
    """The rows of ``docs`` as often as :func:`mix` takes them, with the columns of ``docs``.

    Rows meet their copies by id. Only rows whose id repeats with other copies, or is missing, meet them by
    source, size and their number among equals.
    """
    names = docs.columns
    inner = docs.toDF(*[f"k{i}" for i in range(len(names))])
    id, of, words = (f"k{names.index(c)}" for c in (doc_id, source, text))
    found = _placed_copies(inner, weights, share, most, seed, words, of, id)
    found = write_scratch(found.withColumnRenamed("doc_id", "__id").drop("target", "source_size"), "copies")
    by_id = found.groupBy("__id").agg(F.min("copies").alias("copies"), F.max("copies").alias("__most"))
    taken = by_id.where("copies = __most AND copies > 0").drop("__most")
    # The same shuffle at every size.
    rows = inner.join(taken.hint("merge"), F.col(id).eqNullSafe(F.col("__id"))).drop("__id")
    odd = write_scratch(by_id.where("copies <> __most").select("__id"), "odd_ids")
    if odd.limit(1).count():
        same = ["__id", "source__null", "source__text", "size"]
        nth = lambda by: F.row_number().over(Window.partitionBy(*same).orderBy(*by)).alias("__nth")
        some = inner.join(odd, F.col(id).eqNullSafe(F.col("__id"))).withColumn("source", F.col(of))
        some = some.select(*inner.columns, "__id", *key_of("source"), _size(words).alias("size"))
        some = some.select("*", nth([F.xxhash64(words), words]))
        copies = join_same(found, odd, ["__id"], "left_semi").select("*", nth([F.desc("copies")])).where("copies > 0")
        rows = rows.unionByName(join_same(some, copies, [*same, "__nth"], "inner").select(*inner.columns, "copies"))
    rows = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(names)])
