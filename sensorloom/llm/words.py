"""Words, shingles and their 64-bit hashes, for whole Arrow batches at once.

A word is ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 text: a run of bytes other than space, tab and the
line breaks. No other byte of UTF-8 falls in that range, so bytes can be cut without decoding.

A word's hash is a sum over its bytes of a random 64-bit number for the byte times a power for
its place, mixed at the end. Equal words have equal hashes everywhere; two different words of a
corpus share one with a chance of about 2**-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE = np.random.RandomState(20).randint(1, 2**63 - 1, size=256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = np.full(64, 0x9E3779B97F4A7C15, dtype=np.uint64).cumprod()
_POWERS[0] = 1


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        size = 1 << int(n).bit_length()
        # The same numbers as before for the places there were: a hash may not hang on the words seen earlier.
        _POWERS = np.full(size, 0x9E3779B97F4A7C15, dtype=np.uint64).cumprod()
        _POWERS[0] = 1
    return _POWERS


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A full-avalanche permutation of 64-bit numbers, another one for each seed."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the place where each row begins; null is empty.

    Returns ``(bytes, offsets)`` with ``len(column) + 1`` offsets from 0.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word begins and ends, and how many words lie before each row (rows + 1 numbers).

    ``gap`` tells of each byte whether it stands between words.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~gap[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    rows = offsets[:-1][offsets[:-1] < len(data)]
    first[rows] = inside[rows]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word in order, and how many words lie before each row (rows + 1 numbers)."""
    starts, ends, before = word_spans(data, offsets)
    return hash_spans(data, starts, ends, lower), before


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """The hash of each span; spans are in order, do not overlap and are not empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    table = _BYTE[_LOWER] if lower else _BYTE
    out = np.empty(len(starts), np.uint64)
    # Some hundred thousand bytes at a time: the 64-bit numbers beside them take fifty times as much.
    step = 1 << 18
    cut = 0
    total = np.cumsum(lengths)
    while cut < len(starts):
        upto = max(cut + 1, int(np.searchsorted(total, (total[cut - 1] if cut else 0) + step, side="right")))
        n = lengths[cut:upto]
        begin = np.cumsum(n) - n
        place = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(begin, n)
        at = place + np.repeat(starts[cut:upto], n)
        out[cut:upto] = np.add.reduceat(table[data[at]] * _powers(int(n.max()))[place], begin)
        cut = upto
    return mix(out + lengths.astype(np.uint64))


def shingle_hashes(words: np.ndarray, before: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of ``size`` words, in order, and how many lie before each row.

    A row with fewer words has the run of all its words as its one shingle; one without words
    has none.
    """
    counts = np.diff(before)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(n)])
    row = np.repeat(np.arange(len(counts)), n)
    at = np.arange(first[-1]) - first[row] + before[row]
    have = np.minimum(counts[row], size)
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        with_k = have > k
        nxt = np.zeros(len(at), np.uint64)
        nxt[with_k] = words[at[with_k] + k]
        out = np.where(with_k, mix(out * np.uint64(0xD6E8FEB86659FD93) + nxt), out)
    return out, first
