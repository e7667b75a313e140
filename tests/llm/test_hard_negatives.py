import math
import random

import pytest
from pyspark.sql import functions as F

import sensorloom.llm.hard_negatives as h

KINDS = "vec_id long, embedding array<float>, label int, id string, row string, score int, v int, slot int"


def brute(rows, positives=5, negatives=3, low=50, high=95, scale=256, each=5):
    """All pairs, rows as rows."""
    part = []
    for place, (i, v, label, *_) in enumerate(rows):
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        part.append((i, [math.floor(scale * x) for x in v], label, place))
    out = []
    for a in part:
        if a[0] % each:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[1], b[1])), b[0], b[3], b[2]) for b in part if b is not a and len(a[1]) == len(b[1]))
        same = [s for s in scored if s[3] == a[2]][:positives]
        for p in same:
            fit = [s for s in scored if s[3] != a[2] and low * -p[0] <= 100 * -s[0] <= high * -p[0]][:negatives]
            out += [(a[0], p[1], r, n[1], -p[0], -n[0]) for r, n in enumerate(fit, 1)]
    return sorted(out)


def table_of(spark, rows):
    # One partition, so that the order of repeated rows is known.
    return spark.createDataFrame(rows, KINDS).coalesce(1)


def mined(spark, rows, **options):
    df = h.hard_negatives(table_of(spark, rows), "vec_id", "embedding", "label", F.col("id") % 5 == 0, **options)
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in df.collect())


def odd_vectors(n=400, seed=4):
    """Few values, so that scores tie; a hot label; nulls, NaN and infinite components; other lengths; repeated ids and rows."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        v = [rnd.choice([-0.5, 0.25, 0.5, 1.0, 0.1]) for _ in range(4)]
        rows.append([i, v, 0 if rnd.random() < 0.35 else rnd.randrange(1, 5)])
    for i, v in enumerate([None, [], [1.0, None, 0.0, 0.0], [math.nan] * 4, [math.inf, 0.0, 0.0, 0.0], [0.0] * 4, [-1.0] * 4]):
        rows[10 + i][1] = v
    rows[30][2] = None
    for i in range(40, 52):
        rows[i][1] = rows[i][1][:3]
    rows[60][0] = rows[55][0]
    rows[61] = list(rows[65])
    rows[70][0] = None
    for i in range(80, 95):
        rows[i][1] = rows[80][1]
    return [(*r, "x", None, 1, 2, 3) for r in rows]


@pytest.mark.parametrize("block", [h.BLOCK_BYTES, 600])
def test_equal_to_all_pairs(spark, monkeypatch, block):
    """In one block of anchors or in many, with ties, hot labels, odd vectors and repeated rows."""
    monkeypatch.setattr(h, "BLOCK_BYTES", block)
    monkeypatch.setattr(h, "TILE", 32)
    rows = odd_vectors()
    want = brute(rows)
    assert len(want) > 300
    assert mined(spark, rows) == want


def test_windows_and_counts(spark):
    rows = odd_vectors(seed=9)
    assert mined(spark, rows, positives=3, negatives=7, low=20, high=100) == brute(rows, 3, 7, 20, 100)
    assert mined(spark, rows, positives=1, negatives=1, low=90, high=90, scale=7) == brute(rows, 1, 1, 90, 90, 7)


def test_large_components(spark):
    """Sums beyond 2**53 are exact; components whose scores would not fit 64 bits take no part."""
    rows = [(5, [9.0e5, 1.0], 1), (6, [9.0e5, 3.0], 1), (7, [8.0e5, 1.0], 2), (8, [8.0e5, 2.0], 2), (9, [1e30, 1.0], 2)]
    rows = [(*r, None, None, 0, 0, 0) for r in rows]
    got = mined(spark, rows, scale=1000)
    assert got == brute(rows[:4], scale=1000) and got


def test_nothing_to_mine(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1, None, None, 0, 0, 0)]) == []
    alone = [(5, [1.0], 1, None, None, 0, 0, 0), (6, [1.0], 2, None, None, 0, 0, 0)]
    assert mined(spark, alone) == []


def test_one_task_or_many(spark):
    """Combiners in many tasks give what one task gives."""
    rows = [r for r in odd_vectors(seed=5) if r[0] is not None and r[0] not in (55, 61, 65)]
    df = spark.createDataFrame(rows, KINDS)
    got = [
        sorted(map(tuple, h.hard_negatives(df.repartition(n), "vec_id", "embedding", "label", F.col("id") % 5 == 0).collect()))
        for n in (1, 13)
    ]
    assert got[0] == got[1] == brute(rows)
