"""Hard negatives by slots: the rows of another label that score close under an anchor's positives.

Each anchor has positives, its best rows of the same label, and each positive asks for the best rows
of another label whose score lies between two shares of its own. The windows of an anchor overlap. Their
upper limits cut the scores into disjoint slots: a row belongs to the slot of the least limit that
it does not exceed. Every task keeps the best ``k`` rows of each slot (a combiner), Spark merges these, and
the window of a positive is answered by the slots from its own limit downwards: the best ``k`` rows at or
under a limit are among the best ``k`` of each of those slots, and those over the lower limit
come first among them. So a row is looked at once, however many windows it lies in.

Anchors are the stated query set and meet all rows, in blocks: a block of anchors of bounded size is
sent to all tasks, which multiply it with their rows, some thousand at a time. Nothing is dealt by label, so a
frequent label needs no care.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorloom.session import write_scratch

#: Bytes of a block of anchors as 64-bit numbers, which is sent to every task.
BLOCK_BYTES = 32 << 20
#: Anchors and products of a step inside a task.
TILE, STEP = 1024, 1 << 21

_FOUND = "anchor long, slot int, score long, id long, row long"


def quantised(df: DataFrame, id: str, vector: str, label: str, scale: int) -> DataFrame:
    """``(id, label, v, row)`` of the rows that take part, ``v`` being ``floor(scale * x)`` of each component.

    Rows whose id, label or vector is null, or that have a null or non-finite component, take no part, nor do those
    with a component so large (2.7e8 of 64) that scores would not fit 64 bits. ``row`` is a number of its own.
    """
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("v")
            sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            with np.errstate(invalid="ignore"):
                x = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False))  # null as NaN
                most = np.floor(np.sqrt(2.0**62 / np.maximum(sizes, 1)))
                odd = ~(np.abs(x) <= np.repeat(most, sizes))
            begin = np.cumsum(sizes) - sizes
            good = np.diff(np.r_[0, np.cumsum(odd)][np.r_[begin, begin[-1:] + sizes[-1:]]]) == 0
            x = x[np.repeat(good, sizes)].astype(np.int64)
            ends = np.r_[0, np.cumsum(sizes[good])].astype(np.int32)
            kept = batch.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([kept.column("id"), kept.column("label"), pa.ListArray.from_arrays(ends, x)], ["id", "label", "v"])

    kind = rows.schema["label"].dataType.simpleString()
    whole = rows.mapInArrow(floors, f"id long, label {kind}, v array<long>")
    return write_scratch(whole.withColumn("row", F.monotonically_increasing_id()), "quantised")


def _matrix(column: pa.Array, rows: np.ndarray) -> np.ndarray:
    """The vectors of ``rows``, which all have one length."""
    part = column.take(pa.array(rows))
    return part.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(rows), -1)


def _products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``x @ y.T`` of integers, exact: in double precision while every sum stays under 2**53."""
    if not x.shape[1]:
        return np.zeros((len(x), len(y)), np.int64)
    if float(np.abs(x).max()) * float(np.abs(y).max()) * x.shape[1] < 2.0**53:
        return (x.astype(np.float64) @ y.T.astype(np.float64)).astype(np.int64)
    return x @ y.T


class _Best:
    """The best ``k`` of each anchor and slot so far: by score, then smaller id, then row."""

    def __init__(self, anchors: int, slots: int, k: int):
        self.k, self.slots = k, slots
        self.least = np.full((anchors, slots), np.iinfo(np.int64).min)
        self.rows = [np.zeros(0, np.int64)] * 4

    def add(self, group: np.ndarray, score: np.ndarray, id: np.ndarray, row: np.ndarray) -> None:
        """Rows of ``group = anchor * slots + slot``; they may be any that reach ``least``."""
        if not len(group):
            return
        g, s, i, r = (np.concatenate(x) for x in zip(self.rows, (group, score, id, row)))
        order = np.lexsort((r, i, -s, g))
        g = g[order]
        first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        place = np.arange(len(g)) - np.repeat(first, np.diff(np.r_[first, len(g)]))
        keep = order[place < self.k]
        self.rows = [g[place < self.k], s[keep], i[keep], r[keep]]
        full = place == self.k - 1
        self.least.reshape(-1)[g[full]] = s[order[full]]


def _scored(rows: DataFrame, anchors: list[dict], k: int, limits: str) -> DataFrame:
    """The best ``k`` rows of each anchor and slot in every task, as ``_FOUND``.

    ``anchors`` holds one dict of arrays per vector length. With ``limits`` the rows of other labels are sought in the slots
    below each of the anchor's ``upper`` limits (descending, filled up with the last) and over its ``lower``; without, rows of the
    same label but the anchor's own, all in one slot.
    """
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = {b["v"].shape[1]: b for b in shared.value}
        best = {
            (d, at): _Best(min(TILE, len(b["v"]) - at), b["upper"].shape[1] if limits else 1, k)
            for d, b in blocks.items() for at in range(0, len(b["v"]), TILE)
        }
        for batch in batches:
            sizes = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
            ids, labels, numbers = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label", "row"))
            for d, block in blocks.items():
                have = np.flatnonzero(sizes == d)
                if not len(have):
                    continue
                vectors, step = _matrix(batch.column("v"), have), 256
                begin = 0
                while begin < len(have):  # Small steps first, which raise the least scores that count.
                    part = have[begin : begin + step]
                    x = vectors[begin : begin + step]
                    begin, step = begin + step, min(step * 2, max(1, STEP // TILE))
                    for at in range(0, len(block["v"]), TILE):
                        tile = slice(at, at + TILE)
                        found = best[d, at]
                        scores = _products(x, block["v"][tile])
                        same = labels[part][:, None] == block["label"][tile][None, :]
                        if not limits:
                            hit = same & (scores >= found.least[:, 0])
                            hit &= numbers[part][:, None] != block["row"][tile][None, :]
                            r, a = np.nonzero(hit)
                            found.add(a, scores[r, a], ids[part][r], numbers[part][r])
                            continue
                        upper, lower = block["upper"][tile], block["lower"][tile]
                        open_ = ~same & (scores >= lower)
                        for slot in range(upper.shape[1]):
                            hit = open_ & (scores <= upper[:, slot]) & (scores >= found.least[:, slot])
                            if slot + 1 < upper.shape[1]:
                                hit &= scores > upper[:, slot + 1]
                            r, a = np.nonzero(hit)
                            found.add(a * found.slots + slot, scores[r, a], ids[part][r], numbers[part][r])
        for (d, at), found in best.items():
            group, score, id, row = found.rows
            if len(group):
                anchor = blocks[d]["row"][at + group // found.slots]
                slot = (group % found.slots).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (anchor, slot, score, id, row)], ["anchor", "slot", "score", "id", "row"])

    return rows.mapInArrow(task, _FOUND)


def _blocks(anchors: DataFrame) -> Iterator[list[dict]]:
    """The anchors, a bounded block at a time, as arrays by vector length."""
    stored = write_scratch(anchors, "anchors")
    size = stored.agg(F.sum(F.size("v") * 8 + 32)).first()[0] or 0
    parts = -(-size // BLOCK_BYTES)
    for part in range(parts):
        block = stored.where(F.pmod(F.xxhash64("row"), F.lit(parts)) == part).orderBy("row").toArrow().combine_chunks()
        column = block.column("v").combine_chunks() if block.num_rows else None
        if column is None:
            continue
        sizes = column.value_lengths().to_numpy(zero_copy_only=False)
        yield [
            {
                "v": _matrix(column, have),
                **{c: block.column(c).to_numpy()[have] for c in ("row", "id", "label")},
            }
            for d in np.unique(sizes).tolist()
            for have in [np.flatnonzero(sizes == d)]
        ]


def hard_negatives(
    df: DataFrame,
    id: str,
    vector: str,
    label: str,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
) -> DataFrame:
    """The best ``negatives`` rows of another label for every anchor and positive.

    ``anchors`` is a condition on the id, in a column ``id``. Scores are inner products of the quantised vectors (:func:`quantised` says which rows
    take part); higher ones come first, ties by smaller id. An anchor's positives are its first ``positives`` other
    rows of its label. A negative's score is ``low`` to ``high`` percent of the positive's, ends included: of a
    positive score under zero that is nothing. Vectors of different lengths do not meet. Rows that repeat an id count as rows of
    their own (ties among them by their place in the table), also as anchors. An empty table gives no rows.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` (long, ``rank`` int from 1).
    """
    rows = quantised(df, id, vector, label, scale)
    done = None
    for block in _blocks(rows.where(anchors)):
        near = _answered(rows, block, positives, negatives, low, high)
        done = near if done is None else done.unionByName(near)
    if done is None:
        kinds = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return df.sparkSession.createDataFrame([], kinds)
    return done


def _top(found: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "id", "row"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def _answered(rows: DataFrame, block: list[dict], positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """The negatives of one block of anchors."""
    spark = rows.sparkSession
    best = write_scratch(_top(_scored(rows, block, positives, ""), ["anchor"], positives), "positives")
    p = F.col("score")
    # Whole scores s with low * p <= 100 * s <= high * p.
    best = best.select(
        "anchor", F.col("id").alias("positive_id"), F.col("row").alias("positive_row"), p.alias("positive_score"),
        F.expr(f"CAST(ceil({low} * CAST(score AS DECIMAL(38, 0)) / 100) AS LONG)").alias("lower"),
        F.expr(f"CAST(floor({high} * CAST(score AS DECIMAL(38, 0)) / 100) AS LONG)").alias("upper"),
    ).where("lower <= upper")
    # At most as many limits as positives for each anchor of the block.
    windows = best.groupBy("anchor").agg(
        F.sort_array(F.collect_set("upper"), asc=False).alias("uppers"), F.min("lower").alias("lower")
    )
    windows = write_scratch(windows, "windows")
    limits = {a: (u, x) for a, u, x in windows.toArrow().to_pandas().itertuples(index=False)}
    asked = []
    for b in block:
        have = np.array([i for i, r in enumerate(b["row"].tolist()) if r in limits], dtype=np.int64)
        if not len(have):
            continue
        upper = np.full((len(have), positives), np.iinfo(np.int64).min)
        for i, r in enumerate(b["row"][have].tolist()):
            upper[i, : len(limits[r][0])] = limits[r][0]
        lower = np.array([limits[r][1] for r in b["row"][have].tolist()])
        asked.append({c: b[c][have] for c in ("v", "row", "label")} | {"upper": upper, "lower": lower})
    slots = _top(_scored(rows, asked, negatives, "limits"), ["anchor", "slot"], negatives).drop("rank")
    # A slot's limit is the one at its place; a positive's answer is merged from its own slot downwards.
    slots = slots.join(windows.select("anchor", F.posexplode("uppers").alias("slot", "limit")), ["anchor", "slot"])
    merged = best.join(slots, "anchor").where("limit <= upper")
    answer = _top(merged, ["anchor", "positive_row"], negatives).where("score >= lower")
    ids = [(int(r), int(i)) for b in block for r, i in zip(b["row"], b["id"])]
    names = spark.createDataFrame(ids, "anchor long, anchor_id long")
    return answer.join(F.broadcast(names), "anchor").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
