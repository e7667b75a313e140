"""Simple-8b: unsigned ids packed into 64-bit words, a selector of four bits and 60 bits of ids.

A word holds as many of the next ids as fit in equal widths. Blocks of ``BLOCK`` ids are packed on
their own, so that all blocks of a stream are packed and unpacked at once, and the place of each
block's first word is kept: a reader can begin at any block. An id of more than 60 bits is an
escape: selector 0 and the id itself in the word after it.
"""

from __future__ import annotations

import numpy as np

#: Ids in a word, and the bits of each, by selector; selector 0 is the escape.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], dtype=np.int64)
#: Ids in a block.
BLOCK = 256


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bits of each id; 0 has none."""
    if not len(ids) or int(ids.max()) < 1 << 53:  # such numbers are exact as doubles
        return np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    high = ids >> np.uint64(32)
    return np.where(high > 0, 32 + np.frexp(high.astype(np.float64))[1], np.frexp((ids & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]).astype(np.uint8)


def _choices(bits: np.ndarray) -> np.ndarray:
    """For each place the selector that packs the most ids from there within the block."""
    n = len(bits)
    choice = np.where(bits > 60, 0, 14).astype(np.uint8)
    left = (BLOCK - np.arange(BLOCK)).astype(np.int16)
    left = np.resize(left, n)
    left[n - n % BLOCK :] -= BLOCK - n % BLOCK if n % BLOCK else 0
    # The largest width from a place on, over longer and longer runs.
    run, most, least = 1, bits.copy(), int(bits.min())
    for selector in range(13, 0, -1):
        want = int(COUNTS[selector])
        if WIDTHS[selector] < least:
            break
        while run < want:
            step = min(run, want - run)
            if step < n:
                np.maximum(most[: n - step], most[step:], out=most[: n - step])
            run += step
        choice[(most <= WIDTHS[selector]) & (left >= want)] = selector
    return choice


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(words, first word of each block)`` of a stream of unsigned ids."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    choice = _choices(_bits(ids))
    blocks = -(-n // BLOCK)
    at = np.arange(blocks) * BLOCK
    ends = np.minimum(at + BLOCK, n)
    # All blocks step from word to word together; a word takes its selector's count of ids.
    begins = []
    while len(at):
        begins.append(at)
        at = at + COUNTS[choice[at]]
        more = at < ends
        at, ends = at[more], ends[more]
    begins = np.sort(np.concatenate(begins))
    selectors = choice[begins].astype(np.int64)
    size = 1 + (selectors == 0)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for selector in np.unique(selectors):
        here = selectors == selector
        if selector == 0:
            words[place[here] + 1] = ids[begins[here]]
            continue
        word = np.full(int(here.sum()), np.uint64(selector) << np.uint64(60), np.uint64)
        for k in range(COUNTS[selector]):
            word |= ids[begins[here] + k] << np.uint64(k * WIDTHS[selector])
        words[place[here]] = word
    firsts = np.searchsorted(begins, np.arange(blocks) * BLOCK)
    return words, place[firsts]


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of packed words, each selector's words at once."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    words = np.ascontiguousarray(words, dtype=np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for at in np.flatnonzero(selectors == 0):  # an escape's own word may look like any selector
        if not raw[at]:
            raw[at + 1] = True
    selectors[raw] = -1
    count = np.where(raw, 0, COUNTS[np.maximum(selectors, 0)])
    begin = np.cumsum(count) - count
    for selector in np.unique(selectors[~raw]):
        here = np.flatnonzero(selectors == selector)
        if selector == 0:
            out[begin[here]] = words[here + 1]
            continue
        mask = np.uint64((1 << int(WIDTHS[selector])) - 1)
        for k in range(COUNTS[selector]):
            out[begin[here] + k] = (words[here] >> np.uint64(k * WIDTHS[selector])) & mask
    return out
