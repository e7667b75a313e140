"""Periodic runs of words: stretches that repeat a shorter stretch several times, and texts without the repeats.

A run with period q and ``times * q`` words or more matches itself q words later at ``(times - 1) * q`` places in a row, so one
of them is a multiple of ``(times - 1) * q``. These places, for every q, are a grid whose sizes are the harmonic
series: about ``n * ln(n)`` divided by ``times - 1`` for a text of n words. From each place of the grid whose word equals the one q
later, the longest common extension to the right and to the left gives the run, if it is long enough.

Extensions are found with a difference cover: of every 31 places only 6 are sampled, so chosen that any two places have some
distance under 31 at which both are samples. Words are compared one by one up to that distance, and from there
the answer is the least common prefix between the two samples in the sorted order of all sampled suffixes, a
minimum over a range that a sparse table answers. Only texts whose grid finds a match that outlasts the
word-by-word part have their samples sorted.

All steps work on the words of an Arrow batch at once; texts are independent of each other and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_size
from .words import hash_spans, utf8, word_spans

#: A perfect difference set: every distance under 31 is the difference of two of its members, modulo 31.
COVER = (1, 5, 11, 24, 25, 27)
PERIOD = 31
#: Bytes of text worked on at a time, one text at least; grid places at a time.
TEXT_BYTES = 4 << 20
STEP = 1 << 20

_SAMPLED = np.isin(np.arange(PERIOD), COVER)
#: The least distance at which two places, modulo 31, are both sampled.
_SYNC = np.array([[next(d for d in range(PERIOD) if _SAMPLED[(a + d) % PERIOD] and _SAMPLED[(b + d) % PERIOD]) for b in range(PERIOD)] for a in range(PERIOD)])


def _dense(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted order of the keys (first one first) and each element's rank, equal for equal keys."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    rank = np.empty(len(order), np.int32)
    rank[order] = np.cumsum(new) - 1
    return order, rank


class Suffixes:
    """Sampled suffixes of some texts in sorted order, with their common prefixes.

    ``codes`` holds the words of all texts as numbers from 1; text t is ``codes[first[t]:first[t + 1]]`` and only the texts ``chosen``
    are sampled, at the places of :data:`COVER` counted from their beginnings.
    """

    def __init__(self, codes: np.ndarray, text: np.ndarray, first: np.ndarray, chosen: np.ndarray):
        self.codes, self.first, self.text = codes, first, text
        picked = np.zeros(len(first) - 1, bool)
        picked[chosen] = True
        places = np.flatnonzero(picked[text])
        places = places[_SAMPLED[(places - first[text[places]]) % PERIOD]]
        self.places = places
        self.sample = np.full(len(codes) + 1, -1, np.int32)
        self.sample[places] = np.arange(len(places))
        end = first[text[places] + 1]
        # Ranks by text and the first 31 words, as many words at a time as fit into 63 bits.
        order, rank = _dense(text[places])
        bits = max(int(codes.max(initial=1)).bit_length(), 1)
        each = 63 // bits
        for k in range(0, PERIOD, each):
            packed = np.zeros(len(places), np.int64)
            for j in range(k, min(k + each, PERIOD)):
                at = places + j
                packed = packed << bits | np.where(at < end, codes[np.minimum(at, len(codes) - 1)], 0)
            order, rank = _dense(rank, packed)
        # By twice as many words each time, until no two suffixes tie.
        self.levels = [rank]
        width = PERIOD
        while len(places) and rank.max() + 1 < len(places):
            at = places + width
            behind = np.where(at < end, self.sample[np.minimum(at, len(codes))], -1)
            after = np.where(behind >= 0, rank[behind], -1)
            order, rank = _dense(rank, after)
            self.levels.append(rank)
            width *= 2
        self.rank = rank
        self.table = self._sparse(order)

    def _sparse(self, order: np.ndarray) -> list[np.ndarray]:
        """Minima of 1, 2, 4, ... neighbouring common prefixes, as far as one text's samples reach."""
        a, b = self.places[order[:-1]], self.places[order[1:]]
        common = np.zeros(len(order), np.int64)
        own = np.flatnonzero(self.text[a] == self.text[b]) if len(order) else np.zeros(0, np.int64)
        a, b = a[own], b[own]
        end = self.first[self.text[a] + 1]
        length = np.zeros(len(own), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            x, y = a + length, b + length
            inside = (x < end) & (y < end)
            equal = inside.copy()
            rank = self.levels[level]
            equal[inside] = rank[self.sample[x[inside]]] == rank[self.sample[y[inside]]]
            length[equal] += PERIOD << level
        x, y = np.minimum(a, b) + length, np.maximum(a, b) + length
        length += _compare(self.codes, x, y, end, np.full(len(own), PERIOD))[0]
        common[own] = length  # common[i]: of the suffixes i and i + 1 of the order
        table = [common]
        counts = np.bincount(self.text[self.places]) if len(self.places) else np.zeros(1, np.int64)
        span = 1
        while span < counts.max():
            last = table[-1]
            table.append(np.minimum(last[: max(0, len(last) - span)], last[span:]))
            span *= 2
        return table

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Words that the sampled suffixes at the places ``x`` and ``y`` of the same text have in common; ``x < y``."""
        p, q = self.rank[self.sample[x]].astype(np.int64), self.rank[self.sample[y]].astype(np.int64)
        low, high = np.minimum(p, q), np.maximum(p, q)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(x), np.int64)
        for k in np.unique(level).tolist():
            at = level == k
            t = self.table[k]
            out[at] = np.minimum(t[low[at]], t[high[at] - (1 << k)])
        return out


def _compare(codes: np.ndarray, x: np.ndarray, y: np.ndarray, end: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal words from ``x`` and ``y > x`` on, at most ``most`` and up to ``end``; and whether only ``most`` stopped them."""
    length = np.zeros(len(x), np.int64)
    room = np.minimum(most, end - y)
    busy = np.flatnonzero(room > 0)
    k = 0
    while len(busy):
        busy = busy[codes[x[busy] + k] == codes[y[busy] + k]]
        k += 1
        length[busy] = k
        busy = busy[room[busy] > k]
    return length, (length == most) & (y + most < end)


class Extensions:
    """Longest common extensions to the right of two places of the same text."""

    def __init__(self, codes: np.ndarray, text: np.ndarray, first: np.ndarray):
        self.codes, self.text, self.first = codes, text, first

    def ahead(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Equal words up to the next place where both are sampled; whether they go on from there."""
        begin = self.first[self.text[x]]
        sync = _SYNC[(x - begin) % PERIOD, (y - begin) % PERIOD]
        return _compare(self.codes, x, y, self.first[self.text[x] + 1], sync)

    def sort(self, places: np.ndarray) -> None:
        """Make the sampled suffixes of the texts that hold ``places``."""
        self.suffixes = Suffixes(self.codes, self.text, self.first, np.unique(self.text[places]))


def _grid(sizes: np.ndarray, first: np.ndarray, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(place, period)`` of the grid of every text, about :data:`STEP` pairs at a time."""
    most = sizes // times
    text = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = (times - 1) * period
    counts = (sizes[text] - period - 1) // step + 1
    total = np.cumsum(counts)
    a = 0
    while a < len(text):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + STEP, side="right")))
        n = counts[a:b]
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(first[text[a:b]], n) + k * np.repeat(step[a:b], n), np.repeat(period[a:b], n)
        a = b


def find_runs(hashes: np.ndarray, before: np.ndarray, least: int = 6, times: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, period)`` of the maximal runs in texts of words, by start and period; places count through all texts.

    Text t has the words ``hashes[before[t]:before[t + 1]]``. A run has ``max(least, times * period)`` words or more.
    """
    n = len(hashes)
    sizes = np.diff(before)
    text = np.repeat(np.arange(len(sizes)), sizes)
    empty = np.zeros(0, np.int64)
    found = [(empty, empty, empty)]
    for x, q in _grid(sizes, before, times):
        same = hashes[x] == hashes[x + q]
        if same.any():
            found.append((x[same], q[same], empty))
    x, q = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    if not len(x):
        return empty, empty, empty
    # Only the texts with matches go on, their words as numbers from 1.
    live = np.unique(text[x])
    chosen = np.zeros(len(sizes), bool)
    chosen[live] = True
    keep = np.flatnonzero(chosen[text])
    at = np.full(n, -1, np.int64)
    at[keep] = np.arange(len(keep))
    x = at[x]
    codes = np.unique(hashes[keep], return_inverse=True)[1].astype(np.int64) + 1
    first = np.r_[0, np.cumsum(sizes[live])]
    owner = np.repeat(np.arange(len(live)), sizes[live])
    start, end = _spread(codes, owner, first, x, q, least, times)
    long = end - start >= np.maximum(least, times * q)
    start, end, q = start[long], end[long], q[long]
    # A stretch is found from several places and by the multiples of its period: the least one is its own.
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    own = np.ones(len(start), bool)
    own[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, q = start[own], end[own], q[own]
    order = np.lexsort((q, start))
    start, end, q = keep[start[order]], keep[end[order] - 1] + 1, q[order]
    return start, end, q


def _spread(
    codes: np.ndarray, owner: np.ndarray, first: np.ndarray, x: np.ndarray, q: np.ndarray, least: int, times: int
) -> tuple[np.ndarray, np.ndarray]:
    """The widest stretch around each place ``x`` that has period ``q``; too short ones may come out shorter still."""
    n = len(codes)
    # Leftwards is rightwards in the mirrored words.
    back = Extensions(codes[::-1], len(first) - 2 - owner[::-1], n - first[::-1])
    right = Extensions(codes, owner, first)
    forth, left = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    more, deeper = np.zeros(len(x), bool), np.zeros(len(x), bool)
    for a in range(0, len(x), STEP):
        u, p = x[a : a + STEP], q[a : a + STEP]
        forth[a : a + STEP], more[a : a + STEP] = right.ahead(u, u + p)
        inner = np.flatnonzero(u > first[owner[u]])
        v = u[inner] - 1
        left[a + inner], deeper[a + inner] = back.ahead(n - 1 - (v + p[inner]), n - 1 - v)
    # What outlasts the words up to the next samples needs the samples sorted.
    if more.any():
        right.sort(x[more])
        at = x[more] + forth[more]
        forth[more] += right.suffixes.common(at, at + q[more])
    if deeper.any():
        at = n - 1 - (x[deeper] - 1 + q[deeper])
        back.sort(at)
        at += left[deeper]
        left[deeper] += back.suffixes.common(at, at + q[deeper])
    return x - left, x + forth + q


def kept_words(n: int, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Of ``n`` words those that lie in no run behind the run's first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    return np.cumsum(change[:-1]) == 0


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray, rows: int) -> pa.Array:
    """For each row its words, one space between two."""
    last = np.r_[text[1:] != text[:-1], np.ones(min(1, len(text)), bool)]
    sizes = ends - starts + ~last  # with the space behind
    out = np.empty(int(sizes.sum()), np.uint8)
    begin = np.cumsum(sizes) - sizes
    step = 1 << 20  # words at a time, so that places of bytes stay few
    for a in range(0, len(sizes), step):
        n = sizes[a : a + step]
        low, high = int(begin[a]), int(begin[a] + n.sum())
        at = np.arange(low, high) + np.repeat(starts[a : a + step] - begin[a : a + step], n)
        out[low:high] = data[np.minimum(at, len(data) - 1)]
    out[(begin + sizes - 1)[~last]] = 0x20
    offsets = np.r_[0, np.cumsum(np.bincount(text, weights=sizes, minlength=rows))].astype(np.int64)
    return pa.LargeStringArray.from_buffers(rows, pa.py_buffer(offsets), pa.py_buffer(out)).cast(pa.string())


def with_runs(docs: DataFrame, text: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """``docs`` without ``text``, with its runs and the text without their repeats.

    A word is ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch of words whose words one period apart are equal, of
    ``max(least, times * period)`` words or more, for its smallest period, that no neighbouring word extends. Added columns (which
    replace columns of their names):

    * ``n_words long``;
    * ``runs array<struct<start: long, length: long, period: long>>`` by start, then period;
    * ``collapsed string``: the words but those in any run behind its first period, with one space between two.

    Null and empty texts have no words, no runs and an empty ``collapsed``. Rows are independent: repeated ids and rows
    come out as they came in. A text's words must fit into a worker's memory, about 200 bytes each. An empty table gives no rows.
    """
    if times < 2:
        raise ValueError("a run repeats its period at least twice")
    kept = [c for c in docs.columns if c not in {text, "n_words", "runs", "collapsed"}]
    rows = docs.select(F.struct(*kept).alias("kept") if kept else F.lit(None).cast("string").alias("kept"), F.col(text).alias("text"))
    kind = rows.schema["kept"].dataType.simpleString()
    schema = f"kept {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, limit=TEXT_BYTES):
            data, offsets = utf8(batch.column("text"))
            starts, ends, before = word_spans(data, offsets)
            start, end, period = find_runs(hash_spans(data, starts, ends, lower=False), before, least, times)
            row = np.repeat(np.arange(batch.num_rows), np.diff(before))
            keep = kept_words(len(starts), start, end, period)
            whole = row[start] if len(start) else np.zeros(0, np.int64)
            numbers = [pa.array(x, pa.int64()) for x in (start - before[whole], end - start, period)]
            runs = pa.StructArray.from_arrays(numbers, ["start", "length", "period"])
            cuts = np.searchsorted(whole, np.arange(batch.num_rows + 1)).astype(np.int32)
            text_of = _joined(data, starts[keep], ends[keep], row[keep], batch.num_rows)
            made = [batch.column("kept"), pa.array(np.diff(before), pa.int64()), pa.ListArray.from_arrays(cuts, runs), text_of]
            yield pa.RecordBatch.from_arrays(made, ["kept", "n_words", "runs", "collapsed"])

    out = rows.mapInArrow(task, schema)
    return out.select(*(["kept.*"] if kept else []), "n_words", "runs", "collapsed")


def longest_run() -> Column:
    """Of ``runs`` the one with the greatest length, then smallest start, then period; null if there is none."""
    order = F.transform("runs", lambda r: F.struct((-r.getField("length")).alias("under"), r.getField("start").alias("start"), r.getField("period").alias("period")))
    return F.array_min(order)


def runs_text() -> Column:
    """``start,length,period`` and a line feed for each of ``runs``."""
    line = lambda r: F.concat_ws(",", r.getField("start").cast("string"), r.getField("length").cast("string"), r.getField("period").cast("string"))
    return F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
