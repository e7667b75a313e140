import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from helpers import LOWER, SCHEMA

import sensorloom.llm.decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    """Per row (n_words, n_hit, items) by looking at every place of every document."""
    out = []
    for text in docs:
        w, hit, found = words(text), set(), set()
        for item, passage in items:
            p = words(passage)
            m = min(window, len(p))
            grams = {tuple(p[i : i + m]) for i in range(len(p) - m + 1)} if m else set()
            for i in range(len(w) - m + 1) if m else ():
                if tuple(w[i : i + m]) in grams:
                    hit.update(range(i, i + m))
                    found.add("" if item is None else str(item))
        out.append((len(w), len(hit), sorted(found)))
    return out


def corpus(seed=2):
    """Few words, so that short matches abound; planted passages, whole and cut; short, empty, repeated and null items."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcé9") for _ in range(rnd.randint(1, 4))) for _ in range(30)]
    gaps = [" ", ", ", "\n", "--", "\x7f", " \x00"]
    say = lambda n: "".join(rnd.choice(vocabulary) + rnd.choice(gaps) for _ in range(n))
    items = [(k, say(rnd.choice([12, 15, 30, 60]))) for k in range(30)]
    items += [(100, "short one"), (101, "Q7"), (102, None), (103, ""), (104, " .,; "), (None, say(14)), (105, items[3][1]), (106, items[3][1]), (3, say(12))]
    texts = [say(rnd.choice([0, 3, 40, 150])) for _ in range(60)]
    for k in range(20):
        p = words(items[k][1])
        texts[k] += " " + " ".join(p[k % 3 : k % 3 + rnd.choice([8, 9, 10, 11, 25])]).upper() + "; " + say(5)
    texts[20] = items[4][1] + "." + items[4][1] + items[5][1]
    texts[21] = None
    texts[22] = "a SHORT One, and q7"
    texts[23] = say(9) + " " + items[-4][1]
    texts[24] = items[35][1]
    texts += [texts[20]] * 5
    texts.append(say(20_000) + items[7][1] + say(3000))
    return texts, items


@pytest.fixture(scope="module")
def planted():
    return corpus()


def frames(spark, texts, items):
    docs = spark.createDataFrame([(k % 63, t, "hot" if k % 3 else None, "x", k) for k, t in enumerate(texts)], "doc_id long, text string, items string, kept string, n_chars long")
    return docs.repartition(3), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("sizes", [(dc.BLOCK_BYTES, dc.SHARD_BYTES, dc.STEP), (700, 900, 7)])
@pytest.mark.parametrize("window", [10, 3])
def test_equal_to_brute_force(spark, planted, monkeypatch, sizes, window):
    """One block and shard, or many: hits, stretches and items are those of looking everywhere."""
    for name, size in zip(("BLOCK_BYTES", "SHARD_BYTES", "STEP"), sizes):
        monkeypatch.setattr(dc, name, size)
    texts, items = planted
    docs, bench = frames(spark, texts, items)
    out = dc.contamination(docs, bench, window)
    assert out.columns == ["doc_id", "kept", "n_chars", "n_words", "n_hit", "spans", "items"]
    got = {r.n_chars: r for r in out.collect()}
    want = brute(texts, items, window)
    assert len(got) == len(texts) and sum(n > 0 for _, n, _ in want) >= 10
    for k, (n, hit, found) in enumerate(want):
        r = got[k]
        assert (r.doc_id, r.kept, r.n_words, r.n_hit, r["items"]) == (k % 63, "x", n, hit, found)
        assert sum(s.end - s.start for s in r.spans) == hit
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_digest(spark):
    rows = spark.createDataFrame([([],), (["10", "9"],)], "ids array<string>").select(dc.digest("ids")).collect()
    assert [r[0] for r in rows] == [hashlib.sha256(x).hexdigest() for x in (b"", b"10,9")]


def test_affected_documents_go(spark, planted):
    texts, items = planted
    docs, bench = frames(spark, texts, items)
    left = dc.without_contaminated(docs, bench)
    assert left.columns == docs.columns
    want = brute(texts, items)
    assert sorted(r.n_chars for r in left.collect()) == [k for k, (_, n, _) in enumerate(want) if not n]


def test_longest_matches_and_places(spark, monkeypatch):
    """The longest match from every word of every item, how many documents hold it and the first of them."""
    monkeypatch.setattr(dc, "SHARD_BYTES", 2000)
    texts, items = corpus(5)
    items = [i for i in items if i[0] is not None][:12]
    docs, bench = frames(spark, texts, items)
    got = {(r.item_id, r.start): (r.length, r.n_docs, r.first_doc) for r in dc.longest_in_corpus(docs, bench, 6).collect()}
    want = {}
    rows = [(k % 63, " " + " ".join(words(t)) + " ") for k, t in enumerate(texts)]
    for item, passage in items:
        p = words(passage)
        for i in range(len(p)):
            best = None
            for m in range(6, len(p) - i + 1):
                gram = " " + " ".join(p[i : i + m]) + " "
                holders = [d for d, t in rows if gram in t]
                if not holders:
                    break
                best = (m, len(holders), min(holders))
            if best:
                want[str(item), i] = best
    assert got == want and len(want) > 40


def test_empty_tables(spark, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x a b c", "en", "s", 7), (2, None, None, None, None)], SCHEMA)
    assert dc.contamination(empty, some).count() == 0
    assert dc.contamination(empty, none).count() == 0
    assert [(r.n_words, r.n_hit, r["items"]) for r in dc.contamination(docs, none).orderBy("doc_id").collect()] == [(4, 0, []), (0, 0, [])]
    assert dc.without_contaminated(docs, none).count() == 2
    assert dc.without_contaminated(docs, some).count() == 1
    assert dc.longest_in_corpus(docs, none).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_suffix_array(seed):
    """The order of all suffixes up to the next 0, for many copies and for wide alphabets."""
    rnd = random.Random(seed)
    kinds = [1, 2, 5, 1000, 2**20][seed % 5]
    codes = [rnd.randint(0, kinds) for _ in range(300)] + [1, 2, 3] * 40 + [0] + ([1, 2, 3] * 40 + [0]) * 3
    codes = np.array(codes, np.int32)
    sa = dc.suffix_array(codes, 500)
    tail = lambda p: codes[p : p + int(np.argmin(codes[p:]))].tolist()
    assert sorted(sa.tolist()) == np.flatnonzero(codes).tolist()
    tails = [tail(p) for p in sa.tolist()]
    assert tails == sorted(tails)
    short = dc.suffix_array(codes, 4)
    assert [tail(p)[:4] for p in short.tolist()] == sorted(t[:4] for t in tails)


def test_items_of_equal_words_are_one():
    block = dc.Block(["a", "b", "c"], pa.array(["One two", "one, TWO!", "two"]))
    assert block.names == [["a", "b"], ["c"]] and len(block.codes) == 3
