import math
import zlib
from collections import Counter

import pytest
from helpers import words_of

from sensorloom.llm.bloom_lm import MU, score


def plain_scores(rows):
    """The scores from quantised counts of all words and pairs."""
    tokens = {d: [*words_of(t), None] for d, t, *_ in rows}
    learnt = [t for d, t in tokens.items() if zlib.crc32(str(d).encode()) % 7 != 2]
    words, pairs = Counter(x for t in learnt for x in t), Counter(x for t in learnt for x in zip(t, t[1:], strict=False))
    total = sum(words.values()) + len(words) + 1

    def about(n):
        doublings = n.bit_length() - 1
        return 0.0 if n == 0 else 1.0 if n == 1 else 1.4 * 2**doublings

    out = {}
    for d, t in tokens.items():
        out[d] = 0.0
        for k, w in enumerate(t):
            before = about(words[t[k - 1]]) if k else 0.0
            both = min(about(pairs[t[k - 1], w]), before) if k else 0.0
            out[d] += math.log10((both + MU * (about(words[w]) + 1) / total) / (before + MU))
    return out


@pytest.mark.parametrize("bits", [1 << 28, 1 << 16])
def test_pairs_seen_once_and_below_the_filter(docs, rows, monkeypatch, bits):
    """No word or pair counts as unseen because it is rare, whether it fits into the filter or not."""
    monkeypatch.setattr("sensorloom.llm.bloom_lm.FILTER_BITS", bits)
    want = plain_scores(rows)
    got = {r.doc_id: r.score for r in score(docs).collect()}
    assert got.keys() == want.keys()
    assert all(got[d] == pytest.approx(want[d], rel=0.02, abs=0.5) for d in want)


def test_only_held_out_documents_are_looked_up_above_level_one(docs, rows, monkeypatch):
    """What a learnt document holds and a filter from level 2 on does not was seen once, without a join."""
    from sensorloom.llm import bloom_lm

    learnt = [[*words_of(t), None] for d, t, *_ in rows if zlib.crc32(str(d).encode()) % 7 != 2]
    counts = Counter(x for t in learnt for x in t) + Counter(x for t in learnt for x in zip(["", *t], t, strict=False))
    entries = sum(n.bit_length() - 1 for n in counts.values())
    monkeypatch.setattr(bloom_lm, "FILTER_BITS", 1 << math.ceil(math.log2(entries * bloom_lm.ENTRY_BITS)))
    assert bloom_lm.FILTER_BITS < bloom_lm.ENTRY_BITS * (entries + len(counts))
    asked = []
    plain = bloom_lm._looked_up
    monkeypatch.setattr(bloom_lm, "_looked_up", lambda s, c, lowest, n: asked.extend([lowest, s.where("size(open) > 0")]) or plain(s, c, lowest, n))
    got = {r.doc_id: r.score for r in score(docs).collect()}
    assert asked[0] == 2 and {r.held_out for r in asked[1].select("held_out").distinct().collect()} == {True}
    want = plain_scores(rows)
    assert all(got[d] == pytest.approx(want[d], rel=0.02, abs=0.5) for d in want)
