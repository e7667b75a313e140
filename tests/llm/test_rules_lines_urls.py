from collections import Counter

from helpers import SCHEMA, WORD

from sensorloom.llm.host_rules import host_verdicts, judged, keep_good, text_measures
from sensorloom.llm.line_dedup import line_report, removals, without_spread_lines
from sensorloom.llm.url_lists import domains_of, host_of, listed_captures, validity


def measures(text):
    t = text or ""
    w = WORD.findall(t)
    runs = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {p for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)


def test_measures(docs, rows):
    got = {r.doc_id: tuple(r)[5:] for r in text_measures(docs).collect()}
    assert got == {r[0]: measures(r[1]) for r in rows}


def test_symbols_and_repeats(spark):
    text = "a#b $$ <x>\n\na#b $$ <x>\n a b c a b c\nx\nx"
    row = text_measures(spark.createDataFrame([(1, text, "", "", 0)], SCHEMA)).first()
    assert tuple(row)[5:] == measures(text)


def test_host_prior(spark):
    """A host of few documents is drawn to the mean, one of many is not."""
    bad, good = "x y", " ".join(f"w{i}" for i in range(60))
    rows = [(i, bad, "", "bad", 0) for i in range(300)] + [(1000 + i, good, "", f"h{i % 5}", 0) for i in range(300)]
    rows += [(5000, bad, "", "small", 0), (5001, good, "", None, 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    rate = {r["source__text"]: r for r in host_verdicts(text_measures(docs)).collect()}
    assert rate["bad"].host_failed and not rate["small"].host_failed
    assert rate["small"].rate < 0.8 < rate["bad"].rate
    kept = {r.doc_id: r.kept for r in judged(docs).collect()}
    assert not any(kept[i] for i in range(300)) and all(kept[1000 + i] for i in range(300)) and kept[5001]


def test_clean_documents_of_a_failed_host_go(spark):
    bad, good = "x y", " ".join(f"w{i}" for i in range(60))
    rows = [(i, bad, "", "bad", 0) for i in range(400)] + [(999, good, "", "bad", 0), (1000, good, "", "ok", 0)]
    got = {r.doc_id: (r.base_failed, r.kept) for r in judged(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[999] == (False, False) and got[1000] == (False, True)


def test_rules_on_odd_tables(docs, empty, rows):
    assert judged(empty).count() == 0 and keep_good(empty).columns == empty.columns
    clash = docs.withColumnsRenamed({"lang": "n_words", "n_chars": "kept"})
    assert keep_good(clash).columns == clash.columns
    twice = docs.union(docs)
    assert keep_good(twice).count() == 2 * keep_good(docs).count()
    assert {r.doc_id for r in keep_good(docs).collect()} == {r.doc_id for r in judged(docs).where("kept").collect()}


def plain_removals(rows, sites):
    at = {}
    for d, t, _, s, _ in rows:
        for k, line in enumerate((t or "").split("\n")):
            if line := line.strip(" \t\n\x0b\x0c\r"):
                at.setdefault(line, []).append((d, k, s))
    return {(d, k, min(x)[0]) for x in at.values() if len({s for _, _, s in x}) >= sites for d, k, _ in x if (d, k) != min(x)[:2]}


def test_lines(docs, rows, empty):
    for sites in (2, 10, 14):
        assert {tuple(r) for r in removals(docs, sites).collect()} == plain_removals(rows, sites)
    assert not plain_removals(rows, 15) and removals(docs, 15).count() == 0
    assert line_report(empty).count() == 0 and without_spread_lines(empty).count() == 0


def test_near_threshold_lines_are_counted(spark):
    """Sketches of some hundred sites are estimates; the result is exact."""
    rows = [(1000 * n + k, f"line on {n} sites", "", f"s{k}", 0) for n in (395, 399, 400, 401, 405) for k in range(n)]
    gone = removals(spark.createDataFrame(rows, SCHEMA), 400)
    assert {r["first_doc"]: r["count"] for r in gone.groupBy("first_doc").count().collect()} == {400_000: 399, 401_000: 400, 405_000: 404}


def test_texts_without_lines(docs, rows):
    gone = {}
    for d, k, _ in plain_removals(rows, 10):
        gone.setdefault(d, set()).add(k)
    want = {}
    for d, t, *_ in rows:
        left = t if d not in gone else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d])
        if d not in gone or left.strip():
            want[d] = left
    clash = docs.withColumnsRenamed({"lang": "pos", "n_chars": "h1"})
    got = without_spread_lines(clash)
    assert got.columns == clash.columns and {r.doc_id: r.text for r in got.collect()} == want


def test_a_copy_keeps_its_lines_once(spark):
    """Copies on many sites: the first stays whole, the others lose all and go."""
    rows = [(k, "first line\nsecond line", "", f"s{k}", 0) for k in range(12)] + [(50, None, "", "z", 0), (51, "", "", None, 0)]
    got = {r.doc_id: r.text for r in without_spread_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {0: "first line\nsecond line", 50: None, 51: ""}


def test_hosts(spark):
    urls = {
        "http://A.Example.com/x": "a.example.com", "https://u:p@b.org:8080?q": "b.org", "ftp://c.net.": "c.net", "nonsense": None, "": None,
        None: None, "http:///x": None, "https://d.com#top": "d.com",
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r.u: r.h for r in df.select("u", host_of(df.u).alias("h")).collect()} == urls
    x = spark.createDataFrame([("a.b.c.d",), ("one",), (None,)], "h string")
    assert [r.d for r in x.select(domains_of(x.h).alias("d")).collect()] == [["a.b.c.d", "b.c.d", "c.d"], ["one"], None]


def test_validity_and_as_of(spark):
    entries = [
        ("Ex.com", "l", 10, True), ("ex.com", "l", 10, True), ("ex.com", "l", 12, True), ("ex.com", "l", 20, False), ("ex.com", "l", 30, True),
        ("ex.com", "l", 40, False), ("ex.com", "l", 40, True), ("a.ex.com", "m", 5, True), ("x.org", "l", 5, False), (None, "l", 1, True), ("y.org", "l", None, True),
    ]
    e = spark.createDataFrame(entries, "domain string, listing string, at long, listed boolean")
    assert {tuple(r) for r in validity(e).collect()} == {("ex.com", "l", 10, 20), ("ex.com", "l", 30, None), ("a.ex.com", "m", 5, None)}
    at = [9, 10, 19, 20, 29, 30, 99, None]
    caps = [(k, "http://a.ex.com/p", t) for k, t in enumerate(at)] + [(50, None, 30), (51, "http://other.com", 30), (52, "http://ex.com", 15)]
    c = spark.createDataFrame(caps + caps[:1], "domain long, url string, fetched long")  # a clashing name, a repeated row
    got = listed_captures(c, e)
    assert got.count() == len(caps) + 1
    found = {r[0]: (r.n_active, r.matched_domain, r.listed_since) for r in got.collect()}
    assert [found[k][0] for k in range(8)] == [1, 2, 2, 1, 1, 2, 2, 0]
    assert found[1][1:] == ("a.ex.com", 5) and found[50] == found[51] == (0, None, None) and found[52] == (1, "ex.com", 10)
    none = e.limit(0)
    assert listed_captures(c, none).where("n_active > 0").count() == 0 and listed_captures(c.limit(0), e).count() == 0
