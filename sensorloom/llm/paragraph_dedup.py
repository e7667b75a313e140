"""Repeated paragraphs: MinHash bands, exact Jaccard, and components of what is to be removed.

Lines are the paragraphs that a text shows. A passage may also lie inside other lines, where it is
no paragraph of its own; :func:`repeated_passages` finds those by pieces that the words themselves
cut, so that a passage is cut alike wherever it stands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorloom.llm.common import by_size, side
from sensorloom.llm.near_dedup import SMALL, linked_components
from sensorloom.llm.words import mix, shingle_hashes, utf8, word_hashes
from sensorloom.session import write_scratch

#: Bands and rows of each: at similarity 0.8 a pair shares none once in 90 000. Sketches of so few
#: bytes may agree this much less than asked for: over four standard deviations.
BANDS, ROWS, SLACK = 16, 3, 0.27
#: Words of a shingle, and of the shortest paragraph that is looked at.
SHINGLE, LEAST_WORDS = 5, 16

#: A text is cut before a word whose hash is the least of so many words to either side; a run of
#: repeated pieces is a passage from so many words on. A passage of 50 words has its ends, about
#: eight words each, in pieces that differ from place to place.
REACH, LEAST_RUN = 4, 20
#: Places that may be broadcast with their documents: 10 MB.
PLACES = 300_000

_STEPS = mix(np.arange(BANDS * ROWS, dtype=np.uint64), 101) | np.uint64(1)


def _paragraph_sets(column: pa.Array, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Row, line number, words and shingle set of each line of at least ``least`` words."""
    data, offsets = utf8(column)
    breaks = np.flatnonzero(data == 10) + 1
    edges = np.unique(np.concatenate([offsets, breaks]))
    words, before = word_hashes(data, edges)
    shingles, first = shingle_hashes(words, before, SHINGLE)
    counts = np.diff(before)
    at = np.flatnonzero(counts >= least)
    row = np.searchsorted(offsets, edges[at], side="right") - 1
    line = np.searchsorted(breaks, edges[at], side="right") - np.searchsorted(breaks, offsets[row], side="right")
    return row, line, counts[at], [np.unique(shingles[first[k] : first[k + 1]]) for k in at.tolist()]


def paragraphs(docs: DataFrame, least: int = LEAST_WORDS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc``, ``line``, ``words``, ``n`` (set size), ``s1``, ``s2`` (128-bit hash of the set), band keys and sketch."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches):
            row, line, words, sets = _paragraph_sets(batch.column(1), least)
            if not len(row):
                continue
            n = np.array([len(x) for x in sets])
            tokens, begins = np.concatenate(sets), np.cumsum(n) - n
            s1, s2 = (np.add.reduceat(mix(tokens, k), begins).view(np.int64) for k in (7, 11))
            marks = np.empty((len(row), BANDS * ROWS), np.uint8)
            keys = np.zeros((len(row), BANDS), np.uint64)
            for k, step in enumerate(_STEPS):
                token = mix(np.minimum.reduceat(tokens * step, begins), k)
                marks[:, k] = token.astype(np.uint8)
                band = k // ROWS
                keys[:, band] = mix((keys[:, band] if k % ROWS else np.uint64(band)) + token)
            bands = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel().view(np.int64)), BANDS).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)), pa.array(line), pa.array(words), pa.array(n), pa.array(s1), pa.array(s2),
                    bands, pa.array([x.tobytes() for x in marks], pa.binary()),
                ],
                names=["doc", "line", "words", "n", "s1", "s2", "bands", "sketch"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    return rows.mapInArrow(sketch, "doc long, line long, words long, n long, s1 long, s2 long, bands array<long>, sketch binary")


def _class_sets(docs: DataFrame, wanted: DataFrame, least: int, text: str, doc_id: str) -> DataFrame:
    """``doc`` (the class) and its shingle set as bytes, for ``wanted`` (``cls`` and a place ``doc``, ``line``)."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches):
            row, line, _, sets = _paragraph_sets(batch.column("text"), least)
            found = dict(zip(zip(row.tolist(), line.tolist(), strict=True), sets, strict=True))
            out = [
                (place["cls"], found[r, place["line"]].tobytes())
                for r, places in enumerate(batch.column("places").to_pylist()) for place in places if (r, place["line"]) in found
            ]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())], names=["doc", "tokens"])

    places = write_scratch(wanted.groupBy("doc").agg(F.collect_list(F.struct("line", "cls")).alias("places")), "places")
    # A document may list thousands of lines: places count, not documents alone.
    listed = places.agg(F.sum(F.size("places"))).first()[0] or 0
    places = side(places, 100_000) if listed <= PLACES else places.hint("merge")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    found = rows.join(places, "doc").select("text", "places")
    return found.mapInArrow(pick, "doc long, tokens binary").dropDuplicates(["doc"])


def repeated_paragraphs(
    docs: DataFrame, percent: int = 80, least: int = LEAST_WORDS, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per paragraph to remove: doc_id, line, n_words, kept_doc_id, kept_line, exact.

    A paragraph is a line of at least ``least`` words. Paragraphs of equal sets of five-word
    shingles are one class; classes that share a band and are confirmed on their full sets at
    ``percent`` are linked, and of each component of links the first paragraph (smallest doc_id,
    then line) stays. ``exact`` says that the paragraph has the kept one's set. A bucket is
    compared as in :mod:`sensorloom.llm.near_dedup`: a large one first with its most usual member,
    then block by block, leaving out what is already connected. Documents without repeats, null and empty texts give no row.
    """
    # Bands are wide and wanted once for each class only: they are made again rather than stored.
    whole = paragraphs(docs, least, text, doc_id)
    all_ = write_scratch(whole.drop("bands", "sketch"), "paragraphs")
    classes = whole.groupBy("s1", "s2").agg(
        F.count("*").alias("copies"), F.min(F.struct("doc", "line")).alias("first"), F.min_by(F.struct("n", "bands", "sketch"), F.struct("doc", "line")).alias("x")
    )
    # The number is fixed by being written.
    classes = classes.select(F.monotonically_increasing_id().alias("cls"), "s1", "s2", "copies", "first", "x.*")
    classes = write_scratch(classes, "paragraph_classes")
    # Buckets are found on keys alone; sketches join what has company in one. Spark takes the exploded
    # keys for a fiftieth of what a broadcast of them needs: joins of classes shuffle at every size.
    rows = classes.select(F.explode("bands").alias("node"), F.col("cls").alias("rep"))
    sizes = rows.groupBy("node").agg(F.count("*").alias("members")).where("members > 1")
    nodes = rows.join(sizes.hint("merge"), "node").join(classes.select(F.col("cls").alias("rep"), "n", "sketch").hint("merge"), "rep")
    small = F.col("members") <= SMALL
    nodes = nodes.select("node", "rep", "n", "sketch", small.alias("small"), (~small).alias("last"), "members")
    nodes = write_scratch(nodes, "band_nodes")

    def sets(reps: DataFrame) -> DataFrame:
        wanted = reps.withColumnRenamed("doc", "cls").join(classes.hint("merge"), "cls").select("cls", "first.doc", "first.line")
        return _class_sets(docs, wanted, least, text, doc_id)

    found = linked_components(nodes, sets, percent, SLACK)
    named = classes.join(found.withColumnRenamed("node", "cls").hint("merge"), "cls", "left")
    named = named.where("copies > 1 OR component IS NOT NULL").withColumn("component", F.coalesce("component", "cls"))
    named = write_scratch(named.select("s1", "s2", "first", "component"), "named")
    kept = named.groupBy("component").agg(F.min("first").alias("kept"))
    named = write_scratch(named.join(kept.hint("merge"), "component").select("s1", "s2", "kept", (F.col("first") == F.col("kept")).alias("exact")), "removals")
    hit = all_.select("doc", "line", "words", "s1", "s2").join(side(named, 300_000), ["s1", "s2"])
    gone = hit.where(~(F.col("doc").eqNullSafe(F.col("kept.doc")) & (F.col("line") == F.col("kept.line"))))
    return gone.select(
        F.col("doc").alias("doc_id"), "line", F.col("words").alias("n_words"), F.col("kept.doc").alias("kept_doc_id"), F.col("kept.line").alias("kept_line"), "exact"
    )


def _pieces(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word (from 0 in its row), words and hash of each piece of each text."""
    words, before = word_hashes(*utf8(column))
    n = len(words)
    if not n:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    row = np.repeat(np.arange(len(before) - 1), np.diff(before))
    # Rows lie apart by more words than a comparison reaches, all larger than any hash.
    chance = mix(words, 55)
    apart = np.full(n + REACH * (len(before) + 1), np.uint64(2**64 - 1))
    at = np.arange(n) + REACH * (row + 1)
    apart[at] = chance
    cut = np.ones(n, bool)
    for k in range(1, REACH + 1):
        cut &= (chance < apart[at - k]) & (chance <= apart[at + k])
    cut[before[:-1][np.diff(before) > 0]] = True  # the first word of a text
    begins = np.flatnonzero(cut)
    sizes = np.diff(np.append(begins, n))
    place = np.arange(n) - np.repeat(begins, sizes)
    powers = np.full(int(sizes.max()) + 1, 0x9E3779B97F4A7C15, np.uint64).cumprod()
    h = mix(np.add.reduceat(words * powers[place], begins) + sizes.astype(np.uint64), 56)
    return row[begins], begins - before[row[begins]], sizes, h


def repeated_passages(docs: DataFrame, least: int = LEAST_RUN, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per passage of at least ``least`` words that an earlier document (by doc_id) has too:
    doc_id, first_word, n_words, kept_doc_id (the first document with its longest piece).

    Pieces are equal if their words are; neighbouring pieces that earlier documents have make a
    passage. Only the least and greatest doc_id of a piece are kept for it, before and after the
    shuffle. Repeats inside one document, and rows of one doc_id, are not repeats across documents.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches):
            row, first, sizes, h = _pieces(batch.column(1))
            # The number of a piece in its text.
            nth = np.arange(len(row)) - np.searchsorted(row, row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(nth.astype(np.int32)), pa.array(first.astype(np.int32)), pa.array(sizes.astype(np.int32)), pa.array(h.view(np.int64))],
                names=["doc", "nth", "first", "words", "h"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    pieces = write_scratch(rows.mapInArrow(cut, "doc long, nth int, first int, words int, h long"), "pieces")
    # Cuts lie more than REACH words apart; a shorter piece is the begin or end of a text.
    pieces = pieces.where(F.col("words") > REACH)
    shared = pieces.groupBy("h").agg(F.min("doc").alias("kept"), F.max("doc").alias("last")).where("kept <> last").select("h", "kept")
    hit = pieces.join(shared, "h").where("doc <> kept").select("doc", "nth", "first", "words", "kept")
    # Neighbours have the same difference of their number and their rank.
    run = F.col("nth") - F.row_number().over(Window.partitionBy("doc").orderBy("nth"))
    runs = hit.withColumn("run", run).groupBy("doc", "run").agg(
        F.min("first").alias("first_word"), F.sum("words").alias("n_words"), F.max_by("kept", F.struct("words", -F.col("nth"))).alias("kept_doc_id")
    )
    found = runs.where(F.col("n_words") >= least)
    return found.select(F.col("doc").alias("doc_id"), F.col("first_word").cast("long").alias("first_word"), "n_words", "kept_doc_id")


def repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """:func:`repeated_paragraphs` and :func:`repeated_passages` in one table; ``kind`` tells them
    apart, and columns that one of them lacks are null."""
    lines = repeated_paragraphs(docs, text=text, doc_id=doc_id).withColumn("kind", F.lit("line"))
    passages = repeated_passages(docs, text=text, doc_id=doc_id).withColumn("kind", F.lit("passage"))
    return lines.unionByName(passages, allowMissingColumns=True)


def without_repeats(docs: DataFrame, percent: int = 80, least: int = LEAST_WORDS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the lines that :func:`repeated_paragraphs` names, with the same columns; other lines stay as they are."""
    names = docs.columns
    inner = docs.toDF(*[f"k{i}" for i in range(len(names))])
    t, d = f"k{names.index(text)}", f"k{names.index(doc_id)}"
    gone = repeated_paragraphs(inner, percent, least, t, d).groupBy("doc_id").agg(F.collect_set(F.col("line").cast("int")).alias("__gone"))
    joined = inner.join(write_scratch(gone.withColumnRenamed("doc_id", "__doc"), "gone_paragraphs"), F.col(d) == F.col("__doc"), "left")
    lines = F.split(F.col(t), "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "__gone")
    left = F.when(F.col("__gone").isNull(), F.col(t)).otherwise(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
    return joined.select(*[(left if f"k{i}" == t else F.col(f"k{i}")).alias(c) for i, c in enumerate(names)])
