"""The queries of this subpackage, and the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with its SQL."""

    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


HOST_RULES_SQL = r"""
WITH words AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
tri AS (
  SELECT doc_id, i, list_slice(w, i, i + 2) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)),
hits AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM hits) GROUP BY doc_id),
measured AS (
  SELECT doc_id, source, len(w) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
           - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words
  FROM words LEFT JOIN covered USING (doc_id)),
ruled AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         10 * n_symbols > word_chars OR word_chars > 20 * n_words AS more_failed
  FROM measured),
hosts AS (SELECT source, count(*) AS n, sum((base_failed OR more_failed)::BIGINT) AS f FROM ruled GROUP BY source),
prior AS (
  SELECT m, CASE WHEN v > 1e-12 THEN least(greatest(m * (1 - m) / v - 1, 1.0), 1e6) ELSE 1e6 END AS k
  FROM (SELECT sum(f) / sum(n) AS m, greatest(sum(f * f / n) / sum(n) - (sum(f) / sum(n)) * (sum(f) / sum(n)), 0) AS v FROM hosts))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ((hosts.f + m * k) / (hosts.n + k) > 0.8) AS kept
FROM ruled JOIN hosts ON ruled.source IS NOT DISTINCT FROM hosts.source, prior
"""


@query("op5_host_rules", HOST_RULES_SQL)
def host_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's measures, base verdict and final verdict with its host's."""
    from sensorloom.llm.host_rules import judged

    return judged(table(spark, folder, "documents"))


@query("op3_token_files")
def token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids as read back from a token file of all documents."""
    import public_tokenizers

    from sensorloom.llm.token_files import read_tokens, write_tokens
    from sensorloom.session import scratch_path

    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, path)


@query("op4_mix_sources")
def mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of every document the mix takes."""
    from sensorloom.llm.mixing import mix

    return mix(table(spark, folder, "documents"))


@query("op10_pack_sequences")
def pack_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces and their places in sequences of at most 1024 tokens."""
    import public_tokenizers

    from sensorloom.llm.packing import pack

    return pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


LINE_SPREAD_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS site, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
lines AS (
  SELECT doc_id, site, pos, regexp_replace(raw, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line
  FROM cut WHERE regexp_matches(raw, '[^\x20\x09-\x0D]')),
firsts AS (
  SELECT line, doc_id AS first_doc, pos AS first_pos
  FROM (SELECT line, doc_id, pos, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS r FROM lines) WHERE r = 1),
spread AS (SELECT line FROM lines GROUP BY line HAVING count(DISTINCT site) >= 10)
SELECT lines.doc_id, count(DISTINCT pos) AS n_removed, min(first_doc) AS first_doc
FROM lines JOIN spread USING (line) JOIN firsts USING (line)
WHERE NOT (lines.doc_id = first_doc AND pos = first_pos)
GROUP BY lines.doc_id
"""


@query("op8_line_spread", LINE_SPREAD_SQL)
def line_spread(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that lose lines found on ten sites or more, and the first document that keeps one."""
    from sensorloom.llm.line_dedup import line_report

    return line_report(table(spark, folder, "documents"))


#: The words of a text, with A-Z in lower case.
_WORDS = r"""list_filter(regexp_split_to_array(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '')"""

#: All pairs that share a shingle: for small tables.
NEAR_DEDUP_SQL = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS.format(t="coalesce(text, '')")} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) > 1 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) ELSE w END AS s
  FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id, doc_id AS top FROM sets UNION SELECT y, top FROM reach JOIN links ON reach.doc_id = x),
tops AS (SELECT doc_id, min(top) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN tops USING (doc_id)
"""


@query("op1_near_dedup", NEAR_DEDUP_SQL)
def near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's component of near copies: sets of two-word shingles, similarity 0.8."""
    from sensorloom.llm.near_dedup import near_classes

    return near_classes(table(spark, folder, "documents"), size=2, percent=80)


@query("op6_bloom_lm")
def bloom_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's exact add-one word score and its score by the pair model."""
    from sensorloom.llm.bloom_lm import score

    return score(table(spark, folder, "documents"))


VECTORS_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id, vec_id AS top FROM embeddings UNION SELECT y, top FROM reach JOIN links ON reach.vec_id = x),
tops AS (SELECT vec_id, min(top) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN tops USING (vec_id) LEFT JOIN n USING (vec_id)
"""


@query("op7_cross_polytope", VECTORS_SQL)
def cross_polytope(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector's links at cosine 0.95 and its component."""
    from sensorloom.llm.cross_polytope import near_vectors

    return near_vectors(table(spark, folder, "embeddings"))


PARAGRAPHS_SQL = f"""
WITH RECURSIVE cut AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS t, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS line
  FROM documents),
words AS (SELECT doc_id, line, {_WORDS.format(t="t")} AS w FROM cut),
sets AS (
  SELECT row_number() OVER (ORDER BY doc_id, line) AS k, doc_id, line, len(w) AS n_words,
         list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) AS s
  FROM words WHERE len(w) >= 16),
items AS (SELECT k, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.k AS x, b.k AS y FROM items a JOIN items b ON a.g = b.g AND a.k <> b.k
  GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT k, k AS top FROM sets UNION SELECT y, top FROM reach JOIN links ON reach.k = x),
tops AS (SELECT k, min(top) AS top FROM reach GROUP BY k HAVING min(top) < k)
SELECT a.doc_id, a.line, a.n_words, b.doc_id AS kept_doc_id, b.line AS kept_line, a.s = b.s AS exact
FROM tops JOIN sets a ON tops.k = a.k JOIN sets b ON tops.top = b.k
"""


@query("op2_paragraph_dedup")
def paragraph_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every repeated paragraph but the first of its group, and every passage that an earlier document has."""
    from sensorloom.llm.paragraph_dedup import repeats

    return repeats(table(spark, folder, "documents"))


@query("repeated_lines", PARAGRAPHS_SQL)
def repeated_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The paragraphs of ``op2_paragraph_dedup`` that are lines: the part that SQL can express."""
    from sensorloom.llm.paragraph_dedup import repeated_paragraphs

    return repeated_paragraphs(table(spark, folder, "documents"))


#: Pages have no fetch time and come with no lists: both follow from the page's number. The first
#: page of a domain dates its entries; a domain may be listed, taken off and listed again.
URL_LISTS_SQL = r"""
WITH captures AS (
  SELECT page_id, url, page_id % 730 AS fetched,
         nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '\.+$', ''), '') AS host
  FROM pages),
domains AS (
  SELECT domain, min(page_id) AS m
  FROM (SELECT page_id, regexp_replace(host, '^(www|m|blog)\.', '') AS domain FROM captures WHERE host IS NOT NULL) GROUP BY domain),
spans AS (
  SELECT domain, 'spam' AS listing, m % 365 AS valid_from, m % 365 + 30 + m % 90 AS valid_to FROM domains WHERE m % 3 = 0
  UNION ALL SELECT domain, 'spam', m % 365 + 200, NULL FROM domains WHERE m % 6 = 0
  UNION ALL SELECT domain, 'adult', m % 500, NULL FROM domains WHERE m % 7 = 0),
labels AS (SELECT page_id, fetched, string_split(host, '.') AS l FROM captures WHERE host IS NOT NULL),
keyed AS (
  SELECT page_id, fetched, array_to_string(list_slice(l, i, len(l)), '.') AS domain
  FROM (SELECT page_id, fetched, l, unnest(range(1, greatest(len(l) - 1, 1) + 1)) AS i FROM labels)),
met AS (
  SELECT page_id, domain, listing, valid_from,
         row_number() OVER (PARTITION BY page_id ORDER BY length(domain) DESC, domain DESC, valid_from DESC, listing DESC) AS r,
         count(*) OVER (PARTITION BY page_id) AS n
  FROM keyed JOIN spans USING (domain) WHERE valid_from <= fetched AND (valid_to IS NULL OR fetched < valid_to))
SELECT captures.page_id, fetched, host, coalesce(n, 0) AS n_active, domain AS matched_domain, listing AS matched_listing, valid_from AS listed_since
FROM captures LEFT JOIN met ON captures.page_id = met.page_id AND r = 1
"""


@query("op9_url_lists", URL_LISTS_SQL)
def url_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Every page against the listings that were active on the day of its fetch."""
    from pyspark.sql import functions as F

    from sensorloom.llm.url_lists import host_of, listed_captures
    from sensorloom.session import write_scratch

    captures = table(spark, folder, "pages").select("page_id", "url", (F.col("page_id") % 730).alias("fetched"))
    domains = captures.withColumn("domain", F.regexp_replace(host_of(F.col("url")), r"^(www|m|blog)\.", "")).where("domain IS NOT NULL")
    m = F.col("m")
    domains = write_scratch(domains.groupBy("domain").agg(F.min("page_id").alias("m")), "listed_domains")

    def dated(listing: str, when, at, listed: bool) -> DataFrame:
        return domains.where(when).select("domain", F.lit(listing).alias("listing"), at.alias("at"), F.lit(listed).alias("listed"))

    spam = m % 365
    entries = (
        dated("spam", m % 3 == 0, spam, True)
        .union(dated("spam", m % 3 == 0, spam + 30 + m % 90, False))
        .union(dated("spam", m % 6 == 0, spam + 200, True))
        .union(dated("adult", m % 7 == 0, m % 500, True))
    )
    return listed_captures(captures, entries).drop("url")


HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS r FROM scored WHERE same) WHERE r <= 5),
windows AS (
  SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS r
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM windows WHERE r <= 3
"""


@query("op13_hard_negatives", HARD_NEGATIVES_SQL)
def mined_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Three rows of other labels that score 50 to 95 percent of each of an anchor's five positives."""
    from pyspark.sql import functions as F

    from sensorloom.llm.hard_negatives import hard_negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings").withColumn("label", label)
    return hard_negatives(rows, "vec_id", "embedding", "label", anchors=F.col("id") % 50 == 0)


#: A word is a run of ASCII digits and letters and of all other signs beyond ASCII.
_ITEM_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

DECONTAMINATE_SQL = f"""
WITH docs AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
items AS (SELECT item_id, w, least(10, len(w)) AS m FROM (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM items)),
grams AS (
  SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM docs, (SELECT DISTINCT m FROM items) WHERE len(w) >= m)),
hits AS (SELECT doc_id, i, m, item_id FROM grams JOIN windows USING (m, g)),
words AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(found.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query("op12_decontaminate", DECONTAMINATE_SQL)
def decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's words in passages of ten benchmark words, and the items they come from."""
    from pyspark.sql import functions as F

    from sensorloom.llm.decontaminate import contamination, digest

    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest(F.col("items")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: A stretch that matches itself q words later at 3q places in a row does so at three multiples of q in a row.
PERIODIC_RUNS_SQL = r"""
WITH texts AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         xor(4294967295, list_reduce(flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1])),
           lambda crc, step: CASE WHEN step >= 0 THEN xor(crc, step) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END, 4294967295)) AS h
  FROM (SELECT doc_id, text FROM documents)),
sized AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, h // 10 AS g FROM texts),
placed AS (
  SELECT doc_id, w, n, planted, a, 1 + (n - a) // (3 + g % 8) AS p FROM (SELECT *, CASE WHEN n > 0 THEN g % n ELSE 0 END AS a FROM sized)),
words AS (
  SELECT doc_id, i, w[1 + CASE WHEN planted AND i >= a THEN a + (i - a) % p ELSE i END] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM placed)),
grid AS (SELECT doc_id, q, unnest(range(0, n - q, q)) AS x FROM (SELECT doc_id, n, unnest(range(1, n // 4 + 1)) AS q FROM placed)),
same AS (
  SELECT doc_id, q, x // q AS k FROM grid JOIN words a USING (doc_id) JOIN words b USING (doc_id)
  WHERE a.i = x AND b.i = x + q AND a.word = b.word),
open AS (SELECT DISTINCT doc_id, q FROM same s1 JOIN same s2 USING (doc_id, q) JOIN same s3 USING (doc_id, q) WHERE s2.k = s1.k + 1 AND s3.k = s1.k + 2),
matches AS (
  SELECT doc_id, q, a.i AS x FROM open JOIN words a USING (doc_id) JOIN words b USING (doc_id) WHERE b.i = a.i + q AND a.word = b.word),
stretches AS (
  SELECT doc_id, q, min(x) AS s, max(x) + 1 + q - min(x) AS l
  FROM (SELECT doc_id, q, x, x - row_number() OVER (PARTITION BY doc_id, q ORDER BY x) AS part FROM matches) GROUP BY doc_id, q, part),
runs AS (SELECT doc_id, s, l, min(q) AS q FROM stretches WHERE l >= greatest(6, 4 * q) GROUP BY doc_id, s, l),
dropped AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM words WHERE NOT EXISTS (FROM dropped d WHERE d.doc_id = words.doc_id AND d.i = words.i)
  GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS t,
         arg_min({'s': s, 'l': l, 'q': q}, {'under': -l, 's': s, 'q': q}) AS best
  FROM runs GROUP BY doc_id)
SELECT doc_id, coalesce(listed.n, 0) AS n_runs, best.s AS start, best.l AS length, CAST(best.q AS BIGINT) AS period,
       CAST(1000 * best.l // best.q AS BIGINT) AS exponent_milli,
       sha256(coalesce(listed.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM placed LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query("op11_periodic_runs", PERIODIC_RUNS_SQL)
def periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's runs of at least four periods, and its text without their repeats.

    One document in ten, by the checksum of its id, first repeats a stretch of its own words to the end.
    """
    from pyspark.sql import functions as F

    from sensorloom.llm.periodic_runs import longest_run, runs_text, with_runs

    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    # Each step is bound as an element of an array, so that it is computed once for a text and not for each word.
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    bound = F.transform(F.array(F.struct(words.alias("w"), g.alias("g"))), lambda s: F.struct(s.getField("w").alias("w"), (s.getField("g") % F.size(s.getField("w"))).cast("int").alias("a"), s.getField("g").alias("g")))
    bound = F.transform(bound, lambda s: F.struct(s.getField("w").alias("w"), s.getField("a").alias("a"), (1 + F.floor((F.size(s.getField("w")) - s.getField("a")) / (3 + s.getField("g") % 8))).cast("int").alias("p")))

    def repeated(s):
        w, a, p = (s.getField(c) for c in "wap")
        places = F.sequence(F.lit(0), F.size(w) - 1)
        return F.when(F.size(w) == 0, "").otherwise(F.array_join(F.transform(places, lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p))), " "))

    planted = (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    docs = table(spark, folder, "documents")
    text = F.when(planted, F.get(F.transform(bound, repeated), F.lit(0))).otherwise(F.col("text"))
    found = with_runs(docs.select("doc_id", text.alias("text"))).withColumn("best", longest_run())
    length, period = -F.col("best.under"), F.col("best.period")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), F.sha2(runs_text(), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
