import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from sensorloom.llm import bloom_lm
from sensorloom.llm.words import utf8, word_hashes


def peak_of(work):
    """Megabytes that arrays take at most while ``work`` runs."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


class Taken:
    """Stands for a frame and keeps the function that its rows would go through."""

    def select(self, *_):
        return self

    groupBy = agg = select

    def mapInArrow(self, task, _):
        self.task = task
        return self


def test_hashing_takes_little_beside_the_text():
    column = pa.array(["seven letter words here " * 90] * 2000)
    data, offsets = utf8(column)
    assert len(data) > 4_000_000
    assert peak_of(lambda: word_hashes(data, offsets)) < 65


def test_counting_holds_its_tokens_twice_at_most(spark):
    taken = Taken()
    bloom_lm.ngram_counts(taken)
    n = 500_000
    text = " ".join(f"{x:x}" for x in np.random.default_rng(3).integers(0, n, n).tolist())
    batch = pa.RecordBatch.from_arrays([pa.array([text] * 4)], names=["text"])
    rows = []
    # A word and a pair for each token take 16 bytes.
    assert peak_of(lambda: rows.extend(b.num_rows for b in taken.task(iter([batch])))) < 4 * n * 16 * 2 / 1e6
    # Every text is the same: pairs are counted once, whichever of the texts they are in.
    words = Counter(text.split())
    assert sum(rows) == len(words) + 1 + len(set(zip(["", *text.split()], [*text.split(), None])))


def test_distinct_numbers_and_how_often():
    rng = np.random.default_rng(1)
    for k in range(300):
        x = rng.integers(0, int(rng.integers(1, 40)), int(rng.integers(0, 60))).astype(np.uint64) + np.uint64((k % 2) * (2**64 - 50))
        got = list(bloom_lm._counted(np.array_split(x, int(rng.integers(1, 5))), int(rng.integers(1, 12))))
        want, often = np.unique(x, return_counts=True)
        assert [v for h, _ in got for v in h.tolist()] == want.tolist()
        assert [v for _, n in got for v in n.tolist()] == often.tolist()
