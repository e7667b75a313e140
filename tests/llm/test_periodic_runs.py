import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from helpers import WORD

import sensorloom.llm.periodic_runs as pr


def brute(w, least=6, times=4):
    """Every maximal stretch for every period; of equal stretches the least period."""
    found = {}
    for q in range(1, len(w) // times + 1):
        x = 0
        while x < len(w) - q:
            start = x
            while x < len(w) - q and w[x] == w[x + q]:
                x += 1
            if x > start and x + q - start >= max(least, times * q):
                found.setdefault((start, x + q), q)
            x += 1
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def random_texts(rnd):
    texts = []
    for _ in range(rnd.randint(1, 6)):
        w = [rnd.randint(0, rnd.choice([1, 2, 5, 50])) for _ in range(rnd.choice([0, 1, 5, 6, 40, 200]))]
        for _ in range(rnd.randint(0, 3)):
            p = [rnd.randint(0, 3) for _ in range(rnd.choice([1, 2, 3, 7, 31, 40, 62]))]
            w += (p * rnd.randint(2, 9))[: rnd.randint(1, 400)]
            w += [rnd.randint(0, 3) for _ in range(rnd.randint(0, 9))]
        texts.append(w)
    return texts


@pytest.mark.parametrize("seed", range(60))
def test_equal_to_brute_force(seed, monkeypatch):
    """Nested, overlapping and touching runs, periods up to and over the cover's, several texts at once."""
    rnd = random.Random(seed)
    monkeypatch.setattr(pr, "STEP", [3, 50, 1 << 20][seed % 3])
    least, times = rnd.choice([(6, 4), (6, 4), (2, 2), (5, 3), (40, 2)])
    texts = random_texts(rnd)
    before = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    hashes = np.array([x for t in texts for x in t], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    got = list(zip(*[x.tolist() for x in pr.find_runs(hashes, before, least, times)]))
    want = [(s + b, e + b, q) for b, t in zip(before.tolist(), texts) for s, e, q in brute(t, least, times)]
    assert got == want


def test_cover_and_common_prefixes():
    """Any two places have a synchronised distance, and the range minima are the common prefixes."""
    assert {(a - b) % pr.PERIOD for a in pr.COVER for b in pr.COVER} == set(range(pr.PERIOD))
    rnd = random.Random(1)
    w = [rnd.randint(1, 2) for _ in range(50)] * 9 + [rnd.randint(1, 3) for _ in range(200)]
    codes = np.array(w + w, np.int64)
    first, text = np.array([0, len(w), 2 * len(w)]), np.repeat([0, 1], len(w))
    s = pr.Suffixes(codes, text, first, np.array([0, 1]))
    assert len(s.places) == 2 * sum(i % pr.PERIOD in pr.COVER for i in range(len(w)))
    x, y = [], []
    for own in (0, 1):
        places = s.places[text[s.places] == own].tolist()
        for _ in range(300):
            a, b = sorted(rnd.sample(places, 2))
            x.append(a)
            y.append(b)
    for a, b, n in zip(x, y, s.common(np.array(x), np.array(y)).tolist()):
        end = first[text[a] + 1]
        k = 0
        while b + k < end and codes[a + k] == codes[b + k]:
            k += 1
        assert n == k


def test_long_texts():
    for w, want in (([1] * 300_000, [(0, 300_000, 1)]), (list(range(5000)) * 40, [(0, 200_000, 5000)])):
        got = pr.find_runs(np.array(w, np.uint64), np.array([0, len(w)]))
        assert list(zip(*[x.tolist() for x in got])) == want


def test_odd_documents(spark, docs, rows, monkeypatch):
    """Null, empty and blank texts, odd white space, repeated rows and columns of clashing names; texts cut into many batches."""
    monkeypatch.setattr(pr, "TEXT_BYTES", 3000)
    more = [(1000 + k, t, "runs", "kept", k) for k, t in enumerate(["a b " * 9, "x " + "a a b " * 5 + "a c", "A a " * 8 + "\n\n" + "A a " * 3, "same\tsame\n" * 300, "é ü ñ " * 4, "é ü ñ " * 3])]
    every = [*rows, *more, more[0], more[0]]
    df = spark.createDataFrame(every, "doc_id long, text string, runs string, collapsed string, n_words long").repartition(3)
    df = df.selectExpr("*", "runs AS kept")
    out = pr.with_runs(df)
    assert out.columns == ["doc_id", "kept", "n_words", "runs", "collapsed"]
    got = sorted((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in out.collect())
    want = []
    for i, t, *_ in every:
        w = WORD.findall(t or "")
        runs = brute(w)
        want.append((i, len(w), tuple((s, e - s, q) for s, e, q in runs), collapsed(w, runs)))
    assert got == sorted(want) and sum(bool(r[2]) for r in want) > 6


def test_other_limits(spark, docs, rows):
    got = {r.doc_id: len(r.runs) for r in pr.with_runs(docs, least=2, times=2).collect()}
    assert got == {i: len(brute(WORD.findall(t or ""), 2, 2)) for i, t, *_ in rows} and sum(got.values()) > 60
    with pytest.raises(ValueError):
        pr.with_runs(docs, times=1)


def test_digests(spark):
    df = spark.createDataFrame([("q " * 7 + "r s " * 6 + "r",), ("one",), (None,)], "text string")
    got = pr.with_runs(df).select("n_words", pr.longest_run().alias("m"), pr.runs_text().alias("t")).collect()
    by = {r.n_words: r for r in got}
    assert by[20].t == "0,7,1\n7,13,2\n" and tuple(by[20].m) == (-13, 7, 2)
    assert (by[1].m, by[1].t, by[0].t) == (None, "", "")


def test_empty_table(spark, empty):
    assert pr.with_runs(empty).count() == 0


def test_query(spark, rows, tmp_path):
    """The registered query on odd documents: one in ten, by its id's checksum, repeats a stretch to its end."""
    from sensorloom.llm.queries import QUERIES

    many = [(i + 1000 * k, t, a, b, c) for k in range(8) for i, t, a, b, c in rows] + [(None, "a a a a a a", None, None, None)]
    spark.createDataFrame(many, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.asDict() for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()}
    planted = 0
    for i, t, *_ in many:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        if i is not None and w and (h := zlib.crc32(str(i).encode())) % 10 == 0:
            a, g = h // 10 % len(w), h // 10
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[j] if j < a else w[a + (j - a) % p] for j in range(len(w))]
            planted += 1
        runs = brute(w)
        best = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
        s, n, q = (best[0], best[1] - best[0], best[2]) if best else (None, None, None)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        text = "".join(f"{a},{b - a},{c}\n" for a, b, c in runs)
        assert got[i] == {
            "doc_id": i, "n_runs": len(runs), "start": s, "length": n, "period": q, "exponent_milli": n and 1000 * n // q,
            "runs_sha256": sha(text), "collapsed_sha256": sha(collapsed(w, runs)),
        }
    assert planted > 40
