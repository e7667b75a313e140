import random

import pytest

from sensorloom.llm import common, near_dedup, paragraph_dedup
from sensorloom.llm.paragraph_dedup import repeated_paragraphs


@pytest.fixture
def written(monkeypatch):
    """Name and plan of each table that is written on the way."""
    plans = []
    original = common.write_scratch

    def noting(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return original(df, name)

    for module in (common, near_dedup, paragraph_dedup):
        monkeypatch.setattr(module, "write_scratch", noting)
    return plans


def _papers(spark):
    """Documents of many lines: 30 edited copies of one paragraph, whose buckets are large, pairs of copies, and unique ones."""
    rnd = random.Random(31)
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(600)]
    fresh = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    base, lines = fresh(200), []
    for _ in range(30):
        w = list(base)
        w[rnd.randrange(200)] = rnd.choice(vocabulary)
        lines.append(w)
    for _ in range(20):
        w = fresh(100)
        lines += [w, [*w[:-1], "other"], fresh(40)]
    lines = [" ".join(w) for w in lines]
    texts = ["\n".join(lines[k::9]) for k in range(9)] + [lines[0], None, ""]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).cache()


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_what_grows_with_the_documents_is_not_broadcast(spark, written, monkeypatch):
    """Tables of classes, pairs and links would go through the driver if Spark took them for small, and
    so would many places of few documents, which are looked at again."""
    docs = _papers(spark)
    want = _rows(repeated_paragraphs(docs))
    assert len(want) == 29 + 20 + 1
    grow = {"band_nodes", "active", "links", "open_pairs", "components", "named", "removals"}
    assert grow <= {name for name, _ in written}
    assert not {name for name, plan in written if name in grow and "BroadcastHashJoin" in plan}
    sent = lambda: ["BroadcastHashJoin" in plan for name, plan in written if name == "sets"][0]
    assert sent()
    written.clear()
    monkeypatch.setattr(paragraph_dedup, "PLACES", 20)
    assert _rows(repeated_paragraphs(docs)) == want
    assert not sent()


def test_units_of_blocks_are_not_broadcast(spark):
    """Where a bucket's members are not linked, each goes to every block: more rows than Spark takes them for."""
    nodes = spark.range(40).selectExpr("1L AS node", "id AS rep", "50L AS n", "binary('') AS sketch", "false AS small", "true AS last", "40L AS members")
    known = spark.createDataFrame([], "node long, component long")
    links = near_dedup.block_links(nodes, known, lambda reps: reps.selectExpr("doc", "binary(repeat('x', 400)) AS tokens"), 80)
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "BroadcastHashJoin" not in plan
