import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import SCHEMA, components_of, shingles, words_of

from sensorloom.llm.bloom_lm import Filter, score
from sensorloom.llm.common import components
from sensorloom.llm.cross_polytope import codes, hadamard, near_vectors
from sensorloom.llm.near_dedup import near_classes, one_of_each
from sensorloom.llm.paragraph_dedup import repeated_paragraphs, repeated_passages, repeats, without_repeats
from sensorloom.llm.words import hash_spans, word_spans


def plain_classes(rows, size, percent=80):
    sets = {r[0]: shingles(r[1], size) for r in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    top = components_of(links, sets)
    return {d: (d, len(s), top[d], top[d] == d) for d, s in sets.items()}


def test_words():
    data = np.frombuffer("Ab  c\né\x0bAB".encode(), np.uint8)
    starts, ends, before = word_spans(data, np.array([0, 2, 2, 6, len(data)]))
    assert [bytes(data[a:b]).decode() for a, b in zip(starts, ends, strict=True)] == ["Ab", "c", "é", "AB"] and before.tolist() == [0, 1, 1, 2, 4]
    h = hash_spans(data, starts, ends)
    assert h[0] == h[3] and len(set(h.tolist())) == 3


@pytest.mark.parametrize("size", [2, 5])
def test_near_classes(docs, rows, size):
    got = {r.doc_id: tuple(r) for r in near_classes(docs, size).collect()}
    assert got == plain_classes(rows, size)


def test_near_classes_on_odd_tables(spark, docs, empty):
    assert near_classes(empty).count() == 0 and one_of_each(empty).columns == empty.columns
    clash = docs.withColumnsRenamed({"lang": "rep", "n_chars": "component"})
    kept = {r.doc_id for r in near_classes(docs).where("kept").collect()}
    got = one_of_each(clash)
    assert got.columns == clash.columns and {r.doc_id for r in got.collect()} == kept
    blank = spark.createDataFrame([(1, None, "", "", 0), (2, "", "", "", 0), (3, " \n", "", "", 0), (4, "Word", "", "", 0), (5, "word", "", "", 0), (5, "word", "", "", 0)], SCHEMA)
    assert sorted(map(tuple, near_classes(blank).collect())) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (5, 1, 4, False)]


def test_a_large_group_of_near_copies(spark):
    """More near copies of one text than nodes hold, each with its own changes."""
    rnd = np.random.RandomState(5)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for k in range(400):
        w = list(base)
        for at in rnd.choice(150, rnd.randint(0, 10), replace=False):
            w[at] = f"x{rnd.randint(10**9)}"
        rows.append((k, " ".join(w), "", "", 0))
    rows += [(1000 + k, " ".join(f"y{rnd.randint(10**9)}" for _ in range(100)), "", "", 0) for k in range(100)]
    got = {r.doc_id: tuple(r) for r in near_classes(spark.createDataFrame(rows, SCHEMA), 2).collect()}
    assert got == plain_classes(rows, 2)


def test_components_of_a_long_chain(spark):
    links = [(k, k + 1) for k in range(300)] + [(1000, 1001), (1001, 1002), (7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {**{k: 0 for k in range(301)}, 1000: 1000, 1001: 1000, 1002: 1000}
    assert components(df.limit(0)).count() == 0


def plain_repeats(rows, least, percent=80):
    found = [(d, k, shingles(x, 5)) for d, t, *_ in rows for k, x in enumerate((t or "").split("\n")) if len(words_of(x)) >= least]
    links = [(i, j) for (i, a), (j, b) in itertools.combinations(enumerate(found), 2) if 100 * len(a[2] & b[2]) >= percent * len(a[2] | b[2])]
    top = components_of(links, range(len(found)))
    groups = {}
    for i, (d, k, s) in enumerate(found):
        groups.setdefault(top[i], []).append((d, k, s))
    out = set()
    for g in groups.values():
        first = min(g, key=lambda x: x[:2])
        out |= {(d, k, *first[:2], s == first[2]) for d, k, s in g if (d, k) != first[:2]}
    return out


def test_paragraphs(spark, docs, rows, empty):
    assert {(r.doc_id, r.line, r.kept_doc_id, r.kept_line, r.exact) for r in repeated_paragraphs(docs).collect()} == plain_repeats(rows, 16)
    assert repeated_paragraphs(empty).count() == 0
    passage = " ".join(f"p{k}" for k in range(55))
    inside = [(k, f"own {k} start\n{passage if k % 2 else passage.replace('p20 ', f'q{k} ')}\r\nown {k} end", "", "", 0) for k in range(60)]
    inside += [(100, f"{passage}\n{passage}", "", "", 0), (101, None, "", "", 0), (102, "only own words here", "", "", 0)]
    df = spark.createDataFrame(inside, SCHEMA)
    assert {(r.doc_id, r.line, r.kept_doc_id, r.kept_line, r.exact) for r in repeated_paragraphs(df).collect()} == plain_repeats(inside, 16)
    got = {r.doc_id: r.text for r in without_repeats(df.withColumnRenamed("lang", "line")).collect()}
    assert got[0] == inside[0][1] and got[1] == "own 1 start\nown 1 end" and got[100] == "" and got[101] is None and got[102] == "only own words here"


def test_passages_inside_lines(spark, empty):
    """A passage of 51 words in the middle of other text, in many documents, with and without line breaks."""
    rnd = np.random.RandomState(11)
    some = lambda n: [f"v{k}" for k in rnd.randint(0, 50_000, n)]
    passages = [some(51) for _ in range(20)]
    rows, first = [], {}
    for d in range(300):
        w = some(rnd.randint(30, 120))
        if d % 3 == 0:
            p = d // 3 % 20
            at = rnd.randint(0, len(w) + 1)
            w[at:at] = passages[p]
            first.setdefault(p, d)
        rows.append((d, "".join(x + ("\n" if rnd.rand() < 0.03 else " ") for x in w), "", "", 0))
    rows += [(900, None, "", "", 0), (901, "", "", "", 0), (902, " ".join(passages[0] * 2), "", "", 0), (903, "short text", "", "", 0), (904, "short text", "", "", 0)]
    got = {}
    for r in repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect():
        w = words_of(dict((x[0], x[1]) for x in rows)[r.doc_id])[r.first_word : r.first_word + r.n_words]
        kept = set(words_of(dict((x[0], x[1]) for x in rows)[r.kept_doc_id]))
        assert r.n_words >= 20 and len(kept & set(w)) >= 20
        got[r.doc_id] = r.kept_doc_id
    want = {d: first[d // 3 % 20] for d in range(300) if d % 3 == 0 and d not in first.values()} | {902: 0}
    assert set(got) <= set(want) and len(got) >= 0.97 * len(want)
    assert all(got[d] < d and got[d] % 3 == 0 and first[got[d] // 3 % 20] == want[d] for d in got)
    assert repeated_passages(empty).count() == 0 and repeats(empty).count() == 0


def plain_scores(rows):
    tokens = {r[0]: [*words_of(r[1]), None] for r in rows}
    out_ = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in tokens}
    c = Counter(x for d, t in tokens.items() if not out_[d] for x in t)
    n, v = sum(c.values()), len(c)
    return {d: (out_[d], len(t), sum(c[x] > 0 for x in t), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in t)) for d, t in tokens.items()}


def test_scores(docs, rows, empty, monkeypatch):
    want = plain_scores(rows)
    for head in (None, 64):  # all words sent, and most of them joined
        if head:
            monkeypatch.setattr("sensorloom.llm.bloom_lm.HEAD_WORDS", head)
        got = {r.doc_id: r for r in score(docs.withColumnRenamed("lang", "h")).collect()}
        for d, w in want.items():
            assert tuple(got[d])[1:5] == w[:4] and got[d].base_score == pytest.approx(w[4], rel=1e-9)
            assert got[d].score < 0
    assert score(empty).count() == 0
    nothing = score(docs.where("doc_id = 0 AND doc_id = 1").union(docs.where(f"doc_id = {next(d for d, w in want.items() if w[0])}"))).first()
    assert nothing.train_tokens == 0 and nothing.n_known == 0


def test_scores_prefer_what_was_learnt(spark):
    """Held-out text that follows the corpus' pairs of words scores above the same words shuffled."""
    rnd = np.random.RandomState(2)
    follow = {k: rnd.randint(0, 200, 3) for k in range(200)}

    def text(n=80):
        w = [int(rnd.randint(200))]
        while len(w) < n:
            w.append(int(rnd.choice(follow[w[-1]])))
        return w

    rows, shuffled = [], {}
    for d in range(400):
        w = text()
        rows.append((d, " ".join(f"w{k}" for k in w)))
        if zlib.crc32(str(d).encode()) % 7 == 2:
            twin = next(x for x in itertools.count(10_000 + 50 * d) if zlib.crc32(str(x).encode()) % 7 == 2 and x not in shuffled)
            shuffled[twin] = d
            rows.append((twin, " ".join(f"w{k}" for k in rnd.permutation(w))))
    got = {r.doc_id: r for r in score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    better = [got[d].score > got[t].score + 10 for t, d in shuffled.items()]
    assert sum(better) >= 0.95 * len(better)
    assert all(got[d].score > got[d].base_score for d in shuffled.values())


def test_filter_levels():
    h = np.random.RandomState(1).randint(0, 2**62, 3000).astype(np.uint64) * np.uint64(4)
    level = np.arange(3000) % 7
    bits = np.zeros(1 << 15 << 7, bool)
    for i in range(1, 7):
        mine = h[level >= i]
        for place in Filter.places(mine, i, 1 << 15):
            bits[((mine >> np.uint64(57)) * np.uint64(1 << 15) + place).astype(np.int64)] = True
    got = Filter(np.packbits(bits, bitorder="little"), 1 << 15, 1).levels(h)
    assert (got >= level).all() and (got == level).mean() > 0.97


def test_hadamard():
    x = np.random.RandomState(0).randn(5, 16)
    h = np.array([[1.0]])
    for _ in range(4):
        h = np.block([[h, h], [h, -h]])
    assert np.allclose(hadamard(x), x @ h)
    k = codes(x, 3, 2)
    assert (codes(x * 7, 3, 2) == k).all() and k.shape == (5, 3, 3)


def plain_links(vectors, least=0.95):
    good = {i: np.array(x, float) for i, x in vectors if x and all(c is not None and math.isfinite(c) for c in x) and any(x)}
    links = [
        (a, b) for a, b in itertools.combinations(good, 2)
        if len(good[a]) == len(good[b]) and good[a] @ good[b] / (np.sqrt(good[a] @ good[a]) * np.sqrt(good[b] @ good[b])) >= least
    ]
    n = Counter(x for link in links for x in link)
    top = components_of(links, [i for i, _ in vectors])
    return {i: (i, n[i], top[i], top[i] == i) for i, _ in vectors}


def test_vectors(spark):
    rnd = np.random.RandomState(4)
    vectors = []
    for _ in range(30):
        c = rnd.randn(64)
        for _ in range(rnd.randint(1, 12)):
            vectors.append((len(vectors), (c + rnd.randn(64) * rnd.choice([0.05, 0.15, 0.25, 0.5])).astype(np.float32).tolist()))
    hot = rnd.randn(64).astype(np.float32).tolist()
    vectors += [(len(vectors) + k, hot) for k in range(50)]
    n = len(vectors)
    odd = [None, [], [0.0] * 64, [None] + hot[1:], [math.nan] + hot[1:], [math.inf] + hot[1:], hot[:32], hot[:32], [2 * x for x in hot], [1.0], [2.0], [-1.0]]
    vectors += [(n + k, x) for k, x in enumerate(odd)]
    df = spark.createDataFrame([(i, x, 0) for i, x in vectors], "vec_id long, embedding array<float>, rep int")
    want = plain_links([(i, None if x is None else [None if c is None else float(np.float32(c)) for c in x]) for i, x in vectors])
    got = {r.vec_id: tuple(r) for r in near_vectors(df).collect()}
    assert got == want
    assert near_vectors(df.limit(0)).count() == 0


def test_a_large_bucket(spark):
    """More vectors around one than a block holds: every link once."""
    rnd = np.random.RandomState(8)
    c = rnd.randn(64)
    x = (c + rnd.randn(1300, 64) * 0.2).astype(np.float32)
    got = {r.vec_id: r for r in near_vectors(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")).collect()}
    y = x.astype(float)
    norm = np.sqrt((y * y).sum(1))
    want = ((y @ y.T) / norm[:, None] / norm[None] >= 0.95).sum(1) - 1
    found = np.array([got[k].n_links for k in range(1300)])
    assert (found <= want).all() and found.sum() >= 0.995 * want.sum()
