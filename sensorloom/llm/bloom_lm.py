"""Language-model scores from a log-frequency Bloom filter of n-gram counts."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import by_size
from sensorloom.llm.words import mix, utf8, word_hashes
from sensorloom.session import write_scratch

#: Bits of the filter at most (32 MB), and for each entry; probes of a membership test.
FILTER_BITS, ENTRY_BITS, PROBES = 1 << 28, 10, 5
#: The filter is built and sent in so many parts; an n-gram's probes stay in one.
PARTS_LOG = 7
#: Words whose exact counts are sent to the tasks at most (8 MB): the most frequent.
HEAD_WORDS = 1 << 19
#: Pseudo-counts of the word's own probability in that of a word after another.
MU = 300.0
#: Hashes of the end and of the place before the first word.
END, START = np.uint64(0x0E1D0E1D0E1D0E1D), np.uint64(0x57A2757A2757A275)
#: Tokens of a task that are counted together.
CHUNK = 3_000_000

_WORD, _PAIR = 1, 2


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of all rows with an end after each row's, and where each row begins."""
    words, before = word_hashes(*utf8(column))
    return np.insert(words, before[1:], END), before + np.arange(len(before))


def _pairs(tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token the one before it in its row, and the hash of both."""
    previous = np.empty_like(tokens)
    previous[1:] = tokens[:-1]
    previous[first[:-1]] = START
    return previous, mix(previous * np.uint64(0xD6E8FEB86659FD93) + tokens, 3)


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that are not learnt from: crc32 of the id as text, mod 7, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _counted(parts: list[np.ndarray], each: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The distinct numbers of all ``parts``, in order, and how often each is there, ``each`` at a time.

    Takes the parts out of their list and sorts in one copy, so that a task holds what it counts twice at most.
    """
    size, at = sum(map(len, parts)), 0
    every = np.empty(size, np.uint64)
    while parts:
        part = parts.pop()
        every[at : at + len(part)] = part
        at += len(part)
    every.sort()
    new = np.ones(size + 1, bool)
    np.not_equal(every[1:], every[:-1], out=new[1:-1])
    begin = 0
    while begin < size:
        # More tokens than wanted distinct numbers are looked at only where some are equal.
        places = np.flatnonzero(new[begin : begin + each + 1])
        if len(places) < 2:  # One number fills all of it.
            places = np.array([0, int(np.argmax(new[begin + 1 :])) + 1])
        yield every[begin + places[:-1]], np.diff(places)
        begin += int(places[-1])


def ngram_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``kind`` (1 a word or an end, 2 a pair), ``h`` and ``n`` over all ``docs``; counted in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {_WORD: [], _PAIR: []}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for kind, parts in held.items():
                for h, n in _counted(parts):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), kind, np.int8)), pa.array(h.view(np.int64)), pa.array(n)], names=["kind", "h", "n"])

        for batch in by_size(batches, limit=1 << 20):
            tokens, first = _tokens(batch.column(0))
            held[_WORD].append(tokens)
            held[_PAIR].append(_pairs(tokens, first)[1])
            size += len(tokens)
            if size >= CHUNK:
                yield from out()
                size = 0
        yield from out()

    rows = docs.select(F.col(text).alias("text")).mapInArrow(count, "kind byte, h long, n long")
    return rows.groupBy("kind", "h").agg(F.sum("n").alias("n"))


def _level(n: Column) -> Column:
    """Quantised count: the number of doublings and 1, so that what was seen once has level 1."""
    return (F.floor(F.log2(n.cast("double")) + 1e-9) + 1).cast("int")


@dataclass
class Filter:
    """A log-frequency Bloom filter: an n-gram is entered once for each level up to its own, from
    ``lowest`` on, and its level is how many tests in a row succeed."""

    bits: np.ndarray  # bytes of all parts, one after the other
    part_bits: int
    lowest: int

    @staticmethod
    def places(h: np.ndarray, level: int, part_bits: int) -> Iterator[np.ndarray]:
        """Bit of each probe within the n-gram's part."""
        a = mix(h, level)
        b = mix(a, 1) | np.uint64(1)
        for k in range(PROBES):
            yield ((a + np.uint64(k) * b) >> np.uint64(8)) & np.uint64(part_bits - 1)

    def levels(self, h: np.ndarray) -> np.ndarray:
        """The level of each n-gram, 0 if its lowest is not in the filter."""
        out = np.zeros(len(h), np.int8)
        alive, level = np.arange(len(h)), self.lowest
        while len(alive) and level < 64:
            mine = h[alive]
            base = (mine >> np.uint64(64 - PARTS_LOG)) * np.uint64(self.part_bits)
            a = mix(mine, level)
            b = mix(a, 1) | np.uint64(1)
            for k in range(PROBES):  # only what passed so far goes on to the next probe
                at = (((a + np.uint64(k) * b) >> np.uint64(8)) & np.uint64(self.part_bits - 1)) + base
                hit = (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                alive, a, b, base = alive[hit], a[hit], b[hit], base[hit]
            out[alive] = level
            level += 1
        return out


def build_filter(counts: DataFrame) -> Filter:
    """The filter of a written table of n-gram counts.

    The lowest level that is entered is the first from which all entries fit into FILTER_BITS at
    ENTRY_BITS each, so that the filter's size is bounded and its error the same for any corpus;
    what lies below is looked up by a join of :func:`score`. Parts are built where their n-grams meet by
    hash; at most FILTER_BITS / ENTRY_BITS entries do in all.
    """
    leveled = counts.select("h", _level(F.col("n")).alias("level"))
    by_level = dict(leveled.groupBy("level").count().collect())  # at most 64 rows
    top = max(by_level, default=1)
    reach = {i: sum(n * (k - i + 1) for k, n in by_level.items() if k >= i) for i in range(1, top + 1)}
    lowest = next((i for i in range(1, top + 1) if reach[i] * ENTRY_BITS <= FILTER_BITS), top + 1)
    wanted = max(1, reach.get(lowest, 0) * ENTRY_BITS) >> PARTS_LOG
    part_bits = max(1 << 10, min(1 << max(wanted - 1, 1).bit_length(), FILTER_BITS >> PARTS_LOG))

    def part(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(part_bits, bool)
        h, level = pdf["h"].to_numpy().view(np.uint64), pdf["level"].to_numpy()
        for i in range(lowest, int(level.max()) + 1):
            for place in Filter.places(h[level >= i], i, part_bits):
                bits[place.astype(np.int64)] = True
        return pd.DataFrame({"part": [key[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    entries = leveled.where(F.col("level") >= lowest).withColumn("part", F.shiftrightunsigned("h", 64 - PARTS_LOG))
    whole = np.zeros(part_bits << PARTS_LOG >> 3, np.uint8)
    for at, bits in entries.groupBy("part").applyInPandas(part, "part long, bits binary").collect():  # FILTER_BITS at most
        whole[at * (part_bits >> 3) : (at + 1) * (part_bits >> 3)] = np.frombuffer(bits, np.uint8)
    return Filter(whole, part_bits, lowest)


def _about(levels: np.ndarray) -> np.ndarray:
    """The count a level stands for: the middle of its range."""
    doublings = levels.astype(np.float64) - 1
    return np.where(levels > 0, np.where(doublings > 0, 1.4 * 2.0**doublings, 1.0), 0.0)


def _about_column(level: Column) -> Column:
    """:func:`_about` of a column."""
    return F.when(level > 1, 1.4 * F.pow(F.lit(2.0), level - 1)).when(level == 1, 1.0).otherwise(0.0)


def _looked_up(scored: DataFrame, counts: DataFrame, lowest: int, total: int) -> DataFrame:
    """``row`` and ``more_score``: what the n-grams below the filter's lowest level add to a score.

    ``open`` of ``scored`` has a token each: the pair's hash ``h``, the levels ``own`` and ``before``
    of its word and the word before, and the hash ``w`` or ``v`` of either that is to be looked up.
    The pair's share was scored as unseen if both words were known, and the token not at all if not.
    """
    few = counts.select("kind", "h", _level(F.col("n")).cast("byte").alias("level")).where(F.col("level") < lowest)
    words, pairs = (few.where(F.col("kind") == k).select("h", "level") for k in (_WORD, _PAIR))
    tokens = scored.select("row", F.explode("open").alias("t")).select("row", "t.*")
    rare = tokens.where("w IS NOT NULL OR v IS NOT NULL")
    for key, level in (("w", "own"), ("v", "before")):
        # A word that needs no look-up gets a key of its own, lest all of them meet.
        sought = rare.withColumn("key", F.coalesce(key, F.xxhash64("row", "h")))
        met = sought.join(words.select(F.col("h").alias("key"), F.col("level").alias("found")), "key", "left")
        rare = met.withColumn(level, F.when(F.col(key).isNull(), F.col(level)).otherwise(F.coalesce("found", F.lit(0).cast("byte")))).drop("key", "found")
    rare = write_scratch(rare.select("row", "h", "own", "before"), "rare_tokens")
    own = (_about_column(F.col("own")) + 1) * (MU / (total + 1))
    before = _about_column(F.col("before"))
    alone = rare.select("row", F.log10(own / (before + MU)).alias("x"))
    every = tokens.where("w IS NULL AND v IS NULL").select("row", "h", "own", "before").union(rare).where("before > 0")
    paired = every.join(pairs, "h").select("row", F.log10((F.least(_about_column(F.col("level")), before) + own) / own).alias("x"))
    return alone.union(paired).groupBy("row").agg(F.sum("x").alias("more_score"))


def score(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the documents that :func:`held_out` leaves. ``score`` is the sum over the tokens of
    log10 of ``(c(v, w) + MU * p(w)) / (c(v) + MU)`` with ``p(w) = (c(w) + 1) / (N + V + 1)``, v the
    token before w, and all counts read from the filter, by tests of one level after the other, or
    below its lowest level from the table of counts by a join, in the same steps. If that level is 2, only the held-out
    documents need the join: what a learnt one holds and the filter does not was seen once. As counts are quantised, the probabilities sum to one only about.

    ``base_score`` is exact: the counts of the HEAD_WORDS most frequent words go to the tasks;
    other words are joined with their counts by hash, each document's rare words alone, and
    summed up by document. Null text is empty: it has an end. With nothing to learn from, all
    counts are 0. Repeated rows are scored each.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    counts = write_scratch(ngram_counts(rows.where("NOT held_out")), "ngrams")
    # The counts' shuffle is as large as the tokens and stays on disk until its frame is collected.
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    words = counts.where(F.col("kind") == _WORD)
    learnt, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # The count from which on words are few enough to be sent.
    by_count = words.groupBy(_level(F.col("n")).alias("level")).count().collect()  # at most 64 rows
    sent, rare = 0, 1
    for level, n in sorted(by_count, reverse=True):
        if sent + n > HEAD_WORDS:
            rare = 1 << level
            break
        sent += n
    head = words.where(F.col("n") >= rare).select("h", "n").toPandas()  # HEAD_WORDS rows at most
    h = head["h"].to_numpy().view(np.uint64)
    order = np.argsort(h)
    bloom = build_filter(counts)
    starts = spark.sparkContext.broadcast((h[order], head["n"].to_numpy()[order], bloom))
    lowest = bloom.lowest

    open_type = pa.list_(pa.struct([("h", pa.int64()), ("own", pa.int8()), ("before", pa.int8()), ("w", pa.int64()), ("v", pa.int64())]))

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_n, grams = starts.value
        row = TaskContext.get().partitionId() << 33
        for batch in by_size(batches, limit=1 << 20):
            tokens, first = _tokens(batch.column("text"))
            n, begins = np.diff(first), first[:-1]
            distinct_, inverse = np.unique(tokens, return_inverse=True)
            at = np.searchsorted(known, distinct_)
            at[at == len(known)] = 0
            exact = np.where(known[at] == distinct_, known_n[at], 0)[inverse] if len(known) else np.zeros(len(tokens), np.int64)
            level = grams.levels(distinct_)[inverse]
            # What a learnt document holds was seen: if no more than one sighting is left open, it was seen once.
            seen = np.repeat(~batch.column("held_out").to_numpy(zero_copy_only=False), n)
            settled = seen if lowest == 2 else np.zeros(len(tokens), bool)
            level[settled & (level == 0)] = 1
            if rare == 2:
                exact[seen & (exact == 0)] = 1
            level_before = np.empty_like(level)
            level_before[1:] = level[:-1]
            level_before[begins] = 0
            own = (_about(level) + 1) / (learnt + distinct + 1)
            before = _about(level_before)
            previous, pairs = _pairs(tokens, first)
            starting = previous == START
            level_both = grams.levels(pairs)
            # Words below the filter's lowest level, which may have been seen, and pairs, which are if a word is.
            no_own, no_before = (level < lowest) & ~settled, (level_before < lowest) & ~starting & ~settled
            level_both[settled & (level_both == 0)] = 1
            level_both[starting | no_own | no_before] = 0
            both = np.minimum(_about(level_both), before)
            p = np.log10((both + MU * own) / (before + MU))
            open_ = pa.nulls(len(n), open_type)
            if lowest > 1:
                p[no_own | no_before] = 0.0
                open_at = np.flatnonzero(no_own | ((level_both == 0) & ~starting))
                fields = [
                    pa.array(pairs[open_at].view(np.int64)), pa.array(level[open_at]), pa.array(level_before[open_at]),
                    pa.array(tokens[open_at].view(np.int64), mask=~no_own[open_at]), pa.array(previous[open_at].view(np.int64), mask=~no_before[open_at]),
                ]
                owner = np.searchsorted(first, open_at, side="right") - 1
                open_ = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(n) + 1)), pa.int32()), pa.StructArray.from_arrays(fields, fields=list(open_type.value_type)))
            # Words whose count is not here are looked up by a join.
            rare_at = np.flatnonzero(exact == 0)
            owner = np.searchsorted(first, rare_at, side="right") - 1
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(n) + 1)), pa.int32()), pa.array(tokens[rare_at].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(n)) + row), batch.column("doc_id"), batch.column("held_out"), pa.array(n),
                    pa.array(np.add.reduceat((exact > 0).astype(np.int64), begins)),
                    pa.array(np.add.reduceat(np.log10(exact + 1.0), begins)), pa.array(np.add.reduceat(p, begins)), lists, open_,
                ],
                names=["row", "doc_id", "held_out", "n_tokens", "n_known", "known_log", "score", "rare", "open"],
            )
            row += len(n)

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(scores, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, known_log double, score double, rare array<long>, open array<struct<h:long,own:byte,before:byte,w:long,v:long>>")
    scored = write_scratch(scored, "scores")
    others = scored.select("row", F.explode("rare").alias("h"))
    met = others.join(words.where(F.col("n") < rare).select("h", "n"), "h")
    rest = met.groupBy("row").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1.0)).alias("more_log"))
    done = scored.drop("rare", "open").join(rest, "row", "left")
    if lowest > 1:
        looked_up = _looked_up(scored, counts, lowest, int(learnt + distinct))
        done = done.join(looked_up, "row", "left").withColumn("score", F.col("score") + F.coalesce("more_score", F.lit(0.0)))
    total = np.log10(float(learnt + distinct + 1))
    return done.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(int(learnt)).cast("long").alias("train_tokens"),
        (F.col("known_log") + F.coalesce("more_log", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(total))).alias("base_score"), "score",
    )
