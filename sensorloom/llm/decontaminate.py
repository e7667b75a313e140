"""Benchmark passages in training documents, by suffix arrays of the training text.

Documents are read in shards of some megabytes; a shard never cuts a document. The words of a shard become
numbers: those of the benchmark 1, 2, ..., all others 0, as does the end of each document, since a match ends there.
The suffixes that begin with a benchmark word are sorted (:func:`suffix_array`), and every suffix of every benchmark
item is searched in them: its range is halved word by word until it is empty, which gives the longest
verbatim match and, as the range of the last step, all its places. The places of the ranges at the depth of a
window are the window's occurrences in the shard.

The benchmark is the stated query set and meets all shards, in blocks of bounded size; a block is sent to all tasks and
takes a pass over the documents. Nothing is shuffled, so that no document or passage can be hot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.session import write_scratch

from .common import by_size
from .words import hash_spans, utf8, word_spans

#: Bytes of benchmark text that are sent to every task at a time.
BLOCK_BYTES = 16 << 20
#: Bytes of text in a shard, one document at least.
SHARD_BYTES = 8 << 20
#: Places of matches that are looked at together.
STEP = 1 << 20

#: Bytes between words: ASCII but for digits and letters. A-Z are letters, as text is in lower case first.
_GAP = np.ones(256, dtype=bool)
_GAP[ord("0") : ord("9") + 1] = _GAP[ord("a") : ord("z") + 1] = _GAP[ord("A") : ord("Z") + 1] = _GAP[128:] = False


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of a text column, A-Z in lower case, and how many words lie before each row."""
    data, offsets = utf8(column)
    starts, ends, before = word_spans(data, offsets, _GAP)
    return hash_spans(data, starts, ends), before


class Block:
    """Items of a benchmark: their words as numbers, and the items' ids. Items of equal words are one.

    ``codes`` holds the words of all items, ``end`` of each word's item; ``owner`` is the item of each word. ``names[owner]``
    are the ids of the rows that have this item's words.
    """

    def __init__(self, ids: list[str], column: pa.Array):
        hashes, before = words_of(column)
        same: dict[bytes, int] = {}
        self.names: list[list[str]] = []
        parts = []
        for k, name in enumerate(ids):
            part = hashes[before[k] : before[k + 1]]
            if not len(part):
                continue
            at = same.setdefault(part.tobytes(), len(self.names))
            if at == len(self.names):
                self.names.append([])
                parts.append(part)
            self.names[at].append(name)
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        self.vocabulary = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
        self.codes = self.numbers(np.concatenate(parts)) if parts else np.zeros(0, np.int32)
        self.owner = np.repeat(np.arange(len(parts)), sizes)
        self.end = np.repeat(np.cumsum(sizes), sizes)
        self.start = np.repeat(np.cumsum(sizes) - sizes, sizes)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """1, 2, ... for the words of the benchmark in the order of their hashes, 0 for others."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int32)
        at = np.searchsorted(self.vocabulary, hashes).astype(np.int32)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(np.int32)


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """The places of all ``codes`` but 0 in the order of what follows them, up to ``depth`` codes or the next 0.

    ``codes`` ends with 0. The first codes of a suffix, as many as fit into 63 bits, sort it; what ties is sorted
    by the rank of the suffix that begins behind them, which doubles the length each time.
    """
    n = len(codes)
    sa = np.flatnonzero(codes)
    if not len(sa):
        return sa
    bits = max(int(codes.max()).bit_length(), 1)
    width = max(1, min(63 // bits, n))
    # A place's first codes as one number; behind a 0 nothing counts any more.
    key, alive = codes.astype(np.int64), codes != 0
    for k in range(1, width):
        alive[: n - k] &= codes[k:] != 0
        alive[max(n - k, 0) :] = False
        key <<= bits
        key[: n - k] |= np.where(alive[: n - k], codes[k:], 0)
    key = key[sa]
    order = np.argsort(key)
    sa, key = sa[order], key[order]
    first = np.r_[True, key[1:] != key[:-1]]
    rank = np.zeros(n + 1, np.int32)
    # The rank of a group of ties is the place of its first member, from 1.
    rank[sa] = np.maximum.accumulate(np.where(first, np.arange(1, len(sa) + 1), 0))
    tied = np.flatnonzero(~first | ~np.r_[first[1:], True])
    while len(tied) and width < depth:
        places = sa[tied]
        own = rank[places]
        behind = np.minimum(places + width, n)
        after = np.where(behind < n, rank[behind], 0)
        # A suffix that ended before has no rank behind it; its ties are equal for good.
        both = (own.astype(np.int64) << 32) | after
        order = np.argsort(both, kind="stable")
        places, both = places[order], both[order]
        sa[tied] = places
        fresh = np.r_[True, both[1:] != both[:-1]]
        new = np.maximum.accumulate(np.where(fresh, tied + 1, 0))
        # The first member of an old group keeps its rank, since it keeps its place.
        rank[places] = new
        still = ~fresh | ~np.r_[fresh[1:], True]
        tied = tied[still]
        width *= 2
    return sa


def longest_matches(codes: np.ndarray, sa: np.ndarray, block: Block, window: int) -> tuple[np.ndarray, ...]:
    """Every suffix of every item of the block against a shard.

    Returns ``(length, low, high, window_low, window_high)`` by word of the block: the longest match of the suffix
    that begins there and its range of ``sa``, and the range of all suffixes that share its window; both
    are empty where there is none. A window is ``window`` words, or a whole shorter item.
    """
    n = len(block.codes)
    low, high = np.zeros(n, np.int64), np.full(n, len(sa), np.int64)
    length = np.zeros(n, np.int64)
    window_low, window_high = np.zeros(n, np.int64), np.zeros(n, np.int64)
    size = block.end - block.start
    need = np.minimum(window, size)
    open_ = np.arange(n)
    depth = 0
    while len(open_):
        want = block.codes[open_ + depth]
        bounds = []
        for over in (0, 1):  # The first suffix whose next code is at least, or over, the wanted one.
            a, b = low[open_].copy(), high[open_].copy()
            goal = want + over
            while True:
                busy = np.flatnonzero(a < b)
                if not len(busy):
                    break
                middle = (a[busy] + b[busy]) >> 1
                less = codes[sa[middle] + depth] < goal[busy]
                a[busy] = np.where(less, middle + 1, a[busy])
                b[busy] = np.where(less, b[busy], middle)
            bounds.append(a)
        found = bounds[0] < bounds[1]
        open_ = open_[found]
        depth += 1
        low[open_], high[open_], length[open_] = bounds[0][found], bounds[1][found], depth
        full = open_[need[open_] == depth]
        window_low[full], window_high[full] = low[full], high[full]
        open_ = open_[open_ + depth < block.end[open_]]
    nothing = length == 0
    low[nothing] = high[nothing] = 0
    return length, low, high, window_low, window_high


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, one after the other, and the range each belongs to."""
    sizes = high - low
    which = np.repeat(np.arange(len(low)), sizes)
    return np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[which], which


class Shard:
    """The documents of a batch as numbers, searched for the suffixes of a block."""

    def __init__(self, column: pa.Array, block: Block, window: int):
        hashes, before = words_of(column)
        self.counts = np.diff(before)
        rows = len(self.counts)
        # Each document's words, then a 0.
        self.codes = np.zeros(len(hashes) + rows + 1, np.int32)
        self.doc = np.repeat(np.arange(rows, dtype=np.int32), self.counts + 1)
        at = np.arange(len(hashes)) + np.repeat(np.arange(rows), self.counts)
        self.codes[at] = block.numbers(hashes)
        self.first = before[:-1] + np.arange(rows)
        self.block = block
        size = block.end - block.start
        self.sa = suffix_array(self.codes, int(size.max(initial=0)))
        self.length, self.low, self.high, low, high = longest_matches(self.codes, self.sa, block, window)
        # Windows of equal words share a range; each range counts once. Its words: its depth.
        have = np.flatnonzero(low < high)
        need = np.minimum(window, size[have])
        self.windows, inverse = np.unique(np.stack([low[have], high[have], need]), axis=1, return_inverse=True)
        order = np.argsort(inverse, kind="stable")
        self.owners = block.owner[have][order]
        self.owners_end = np.searchsorted(inverse[order], np.arange(self.windows.shape[1]), side="right")

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(document, start, end)`` of the stretches of words that lie in any occurrence of a window."""
        change = np.zeros(len(self.codes) + 1, np.int32)
        low, high, need = self.windows
        for at, which in _parts(low, high):
            places = self.sa[at]
            np.add.at(change, places, 1)
            np.add.at(change, places + need[which], -1)
        hit = np.cumsum(change[:-1]) > 0
        edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
        start, end = edge[::2], edge[1::2]
        doc = self.doc[start] if len(start) else np.zeros(0, np.int32)
        return doc, start - self.first[doc], end - self.first[doc]

    def items(self) -> Iterator[tuple[int, np.ndarray]]:
        """``(document, items)`` for every document that has windows, in order of documents."""
        low, high, _ = self.windows
        pairs = []
        for at, which in _parts(low, high):
            pairs.append(np.unique(self.doc[self.sa[at]].astype(np.int64) << 32 | which))
        if not pairs:
            return
        pairs = np.unique(np.concatenate(pairs))
        docs, windows = pairs >> 32, pairs & 0xFFFFFFFF
        cuts = np.r_[np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]]), len(docs)]
        begin = np.r_[0, self.owners_end[:-1]]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            at, _ = _ranges(begin[windows[a:b]], self.owners_end[windows[a:b]])
            yield int(docs[a]), np.unique(self.owners[at])


def _parts(low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The numbers of the ranges and their range, about ``STEP`` at a time (one range at least)."""
    total = np.cumsum(high - low)
    a = 0
    while a < len(low):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + STEP, side="right")))
        at, which = _ranges(low[a:b], high[a:b])
        yield at, which + a
        a = b


def _blocks(items: DataFrame, id: str, text: str) -> Iterator[Block]:
    """The benchmark, a bounded block at a time. Rows without words match nothing; a null id reads as empty."""
    stored = items.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))
    stored = write_scratch(stored.where("text IS NOT NULL").withColumn("row", F.monotonically_increasing_id()), "benchmark")
    parts = max(1, -(-(stored.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0) // BLOCK_BYTES))
    for part in range(parts):
        block = stored.where(F.pmod(F.xxhash64("row"), F.lit(parts)) == part).orderBy("row").toArrow().combine_chunks()
        column = block.column("text").combine_chunks() if block.num_rows else pa.array([], pa.string())
        yield Block(block.column("id").to_pylist(), column)


def _each_block(
    docs: DataFrame, items: DataFrame, id: str, item_text: str, step: Callable[[DataFrame, object], DataFrame]
) -> DataFrame:
    """``step(docs, broadcast block)`` for one block after the other; between two blocks the rows are written."""
    done = None
    for block in _blocks(items, id, item_text):
        done = step(docs if done is None else write_scratch(done, "searched"), docs.sparkSession.sparkContext.broadcast(block))
    return done


def contamination(
    docs: DataFrame, items: DataFrame, window: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``docs`` without ``text``, with what the benchmark's windows hit in it.

    A word is ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case. A window is ``window`` consecutive words
    of an item; an item of fewer words, but not none, is one window. Added columns (which replace columns of their names):

    * ``n_words long``, ``n_hit long``: words of the document, and those in any occurrence of a window;
    * ``spans array<struct<start: int, end: int>>``: the stretches of hit words, word numbers from 0, ends excluded;
    * ``items array<string>``: the ids, each once and sorted, of the items with occurring windows; a null id is an empty text.

    Null and empty texts have no words. Rows that repeat an id are rows of their own; items that repeat an id count as one.
    Empty tables give no rows, or rows without hits.
    """
    kept = [c for c in docs.columns if c not in {text, "n_words", "n_hit", "spans", "items"}]
    none = F.array().cast("array<struct<start: int, end: int>>")
    rows = docs.select(
        F.struct(*kept).alias("kept") if kept else F.lit(None).cast("string").alias("kept"), F.col(text).alias("text"),
        F.lit(0).cast("long").alias("n_words"), none.alias("spans"), F.array().cast("array<string>").alias("items"),
    )

    def search(df: DataFrame, shared) -> DataFrame:
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in by_size(batches, limit=SHARD_BYTES):
                yield _searched(batch, shared.value, window)

        return df.mapInArrow(task, df.schema)

    found = _each_block(rows, items, item_id, item_text, search)
    # Blocks may add touching or overlapping stretches and the same ids.
    joined = F.aggregate(
        F.array_sort("spans"), none,
        lambda out, s: F.when(
            (F.size(out) > 0) & (F.element_at(out, -1).getField("end") >= s.getField("start")),
            F.concat(
                F.slice(out, 1, F.size(out) - 1),
                F.array(F.struct(F.element_at(out, -1).getField("start").alias("start"), F.greatest(F.element_at(out, -1).getField("end"), s.getField("end")).alias("end"))),
            ),
        ).otherwise(F.concat(out, F.array(s))),
    )
    # One block's stretches lie apart already.
    apart = F.forall(F.sequence(F.lit(2), F.size("spans")), lambda k: F.get("spans", k - 2).getField("end") < F.get("spans", k - 1).getField("start"))
    joined = F.when((F.size("spans") < 2) | apart, F.col("spans")).otherwise(joined)
    found = found.withColumn("spans", joined).withColumn("items", F.array_sort(F.array_distinct("items")))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.getField("end") - s.getField("start"))
    return found.select(*(["kept.*"] if kept else []), "n_words", hit.alias("n_hit"), "spans", "items")


def _searched(batch: pa.RecordBatch, block: Block, window: int) -> pa.RecordBatch:
    """The batch with what the block adds to it."""
    shard = Shard(batch.column("text"), block, window)
    rows = batch.num_rows
    doc, start, end = shard.spans()
    names: list[list[str]] = [[]] * rows
    known: dict[bytes, list[str]] = {}
    for d, owners in shard.items():
        if (found := known.get(owners.tobytes())) is None:
            found = sorted({x for o in owners.tolist() for x in block.names[o]})
            if len(known) < 1000:
                known[owners.tobytes()] = found
        names[d] = found
    kind = batch.schema.field("spans").type
    spans = pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(end, pa.int32())], fields=list(kind.value_type))
    cuts = np.searchsorted(doc, np.arange(rows + 1)).astype(np.int32)
    made = {
        "n_words": pa.array(shard.counts, pa.int64()),
        "spans": _appended(batch.column("spans"), pa.ListArray.from_arrays(cuts, spans), kind),
        "items": _appended(batch.column("items"), pa.array(names, pa.list_(pa.string())), batch.schema.field("items").type),
    }
    return pa.RecordBatch.from_arrays([made.get(c, batch.column(c)) for c in batch.schema.names], schema=batch.schema)


def _appended(before: pa.ListArray, more: pa.ListArray, kind: pa.DataType) -> pa.Array:
    """Row by row one list after the other."""
    if not len(before.flatten()):
        return more.cast(kind)
    return pa.array([(a or []) + b for a, b in zip(before.to_pylist(), more.to_pylist())], kind)


def without_contaminated(
    docs: DataFrame, items: DataFrame, window: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The documents, all their columns, in which no window of any item occurs. Null and empty texts stay."""

    def search(df: DataFrame, shared) -> DataFrame:
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in by_size(batches, text, SHARD_BYTES):
                doc, _, _ = Shard(batch.column(text), shared.value, window).spans()
                clean = np.ones(batch.num_rows, bool)
                clean[doc] = False
                yield batch.filter(pa.array(clean))

        return df.mapInArrow(task, df.schema)

    return _each_block(docs, items, item_id, item_text, search)


def longest_in_corpus(
    docs: DataFrame, items: DataFrame, least: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """For every item and word of it the longest verbatim match that begins there, if of ``least`` words or more.

    Returns ``item_id string, start int, length int, n_docs long, first_doc`` (of the type of ``doc_id``): how many documents hold a match of
    that length, and the smallest id of one. Items that lie inside longer matches appear, too: a match of 12 words has
    one of 11 behind its first word. A null item id is an empty text; rows that repeat an id count each as an item's text, the
    longest match winning.
    """
    kind = dict(docs.dtypes)[doc_id]
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    schema = f"item string, start int, length int, n_docs long, doc {kind}"
    out = None
    for block in _blocks(items, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def task(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in by_size(batches, limit=SHARD_BYTES):
                block = shared.value
                shard = Shard(batch.column("text"), block, least)
                have = np.flatnonzero(shard.length >= least)
                pairs = [np.zeros(0, np.int64)]
                for at, which in _parts(shard.low[have], shard.high[have]):
                    pairs.append(np.unique(have[which] << 32 | shard.doc[shard.sa[at]]))
                pairs = np.unique(np.concatenate(pairs))
                ids = batch.column("doc").take(pa.array(pairs & 0xFFFFFFFF)).to_pylist()
                best: dict[int, list] = {}
                for word, doc in zip((pairs >> 32).tolist(), ids):
                    seen = best.setdefault(word, [0, None])
                    seen[0] += 1
                    seen[1] = doc if seen[1] is None else seen[1] if doc is None else min(seen[1], doc)
                made = [
                    (name, int(w - block.start[w]), int(shard.length[w]), n, first)
                    for w, (n, first) in best.items() for name in block.names[block.owner[w]]
                ]
                columns = list(zip(*made)) or [()] * 5
                types = [pa.string(), pa.int32(), pa.int32(), pa.int64(), batch.schema.field("doc").type]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["item", "start", "length", "n_docs", "doc"])

        part = rows.mapInArrow(task, schema)
        out = part if out is None else out.unionByName(part)
    # Shards add up at the greatest length.
    by_length = out.groupBy("item", "start", "length").agg(F.sum("n_docs").alias("n_docs"), F.min("doc").alias("doc"))
    top = by_length.groupBy("item", "start").agg(F.max(F.struct("length", "n_docs", "doc")).alias("m"))
    return top.select(F.col("item").alias("item_id"), "start", "m.length", "m.n_docs", F.col("m.doc").alias("first_doc"))


def digest(ids: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the comma-joined ids."""
    return F.sha2(F.concat_ws(",", ids), 256)
