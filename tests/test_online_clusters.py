import numpy as np
import pytest

import sensorloom.operators.detect.online_clusters as oc
from sensorloom.session import scratch_path
from sensorloom.streaming.clusters import OnlineKMeans


def plain(points, centres, step):
    """One row after the other."""
    now, labels = [list(c) for c in centres], []
    for x in points:
        best = min(range(len(now)), key=lambda j: (sum((a - b) ** 2 for a, b in zip(x, now[j])), j))
        now[best] = [c + step * (a - c) for a, c in zip(x, now[best])]
        labels.append(best)
    return labels, now


@pytest.fixture(scope="module")
def drifting():
    """Three groups that wander; from the middle on one of them is never met."""
    rng = np.random.default_rng(3)
    n = 4000
    kind = rng.integers(0, 3, n)
    kind[n // 2 :] = rng.integers(0, 2, n // 2)
    x = np.stack([kind * 40.0, kind * -15.0], axis=1) + rng.normal(0, 3, (n, 2)) + np.linspace(0, 25, n)[:, None]
    return x.tolist()


def frame(spark, points):
    rows = [(i // 3, i, a, b, 7) for i, (a, b) in enumerate(points)]
    return spark.createDataFrame(rows, "t long, id long, a double, b double, cluster int").repartition(5)


@pytest.mark.parametrize("step, chunk, rounds", [(0.5, 100_000, 8), (0.5, 170, 8), (0.3, 400, 1), (0.01, 500, 2)])
def test_equal_to_one_row_after_the_other(spark, drifting, step, chunk, rounds):
    """In one chunk or many; a slow step that forgets late is folded in order in the end."""
    start = [[0.0, 0.0], [40.0, -15.0], [80.0, -30.0]]
    out, centres = oc.online_kmeans(frame(spark, drifting), ["t", "id"], ["a", "b"], start, step=step, chunk_rows=chunk, most_rounds=rounds)
    labels, want = plain(drifting, start, step)
    assert out.columns == ["t", "id", "a", "b", "cluster"]
    assert [r.cluster for r in out.orderBy("id").collect()] == labels
    assert centres == want and len(set(labels)) == 3


def test_chunks_settle_in_few_rounds(spark, drifting, monkeypatch):
    turns, folded = [], oc._fold_rows
    monkeypatch.setattr(oc, "_fold_rows", lambda chunks, size, step, turn, in_order: (turns.append((turn, in_order)), folded(chunks, size, step, turn, in_order))[1])
    oc.online_kmeans(frame(spark, drifting), ["t", "id"], ["a", "b"], [[0.0, 0.0], [40.0, -15.0], [80.0, -30.0]], chunk_rows=400)
    assert max(t for t, _ in turns) <= 4 and not any(o for _, o in turns)


def test_first_centres_and_odd_rows(spark):
    """The first different rows in order; incomplete rows have no cluster; nothing at all."""
    rows = [(1, 5.0), (2, 5.0), (3, None), (4, 9.0), (5, float("nan")), (6, 1.0), (7, 8.0)]
    df = spark.createDataFrame(rows, "id long, x double")
    out, centres = oc.online_kmeans(df, ["id"], ["x"])
    want, last = plain([[x] for _, x in rows if x == x and x is not None], [[5.0], [9.0], [1.0]], 0.5)
    got = {r.id: r.cluster for r in out.collect()}
    assert [got[i] for i in (1, 2, 4, 6, 7)] == want and got[3] is got[5] is None and centres == last
    none, no_centres = oc.online_kmeans(df.where("x IS NULL"), ["id"], ["x"])
    assert [r.cluster for r in none.collect()] == [None] and no_centres == []


def test_batches_do_not_matter(spark, drifting):
    """Centres of a stream are those of one fold, however the rows fall into batches, and after a repeated batch."""
    start = [[0.0, 0.0], [40.0, -15.0], [80.0, -30.0]]
    points = drifting[:900]
    model = OnlineKMeans(scratch_path(spark, "centres"), ["a", "b"], order=["t", "id"], start=start, chunk_rows=100)
    df = frame(spark, points)
    for batch, (a, b) in enumerate([(0, 250), (250, 251), (251, 900)]):
        part = df.where(f"id >= {a} AND id < {b}")
        model.learn(part, batch)
        again = model.learn(part, batch)
    labels, want = plain(points, start, 0.5)
    assert [c for _, c in again] == want and [w for w, _ in again] == [labels.count(j) for j in range(3)]
    assert [c for _, c in model.centres(spark)] == want


def test_centres_in_another_order_settle(spark, monkeypatch):
    """Chunks that come to the same centres under other numbers are renumbered: two rounds, none in order, the fold of one row after the other."""
    rng = np.random.default_rng(2)
    points = np.repeat(rng.uniform(0, 1000, (400, 2)), 20, axis=0).tolist()
    start = [[10.0, 100.0], [60.0, 400.0], [150.0, 800.0]]
    turns, folded = [], oc._fold_rows
    monkeypatch.setattr(oc, "_fold_rows", lambda chunks, size, step, turn, in_order: (turns.append((turn, in_order)), folded(chunks, size, step, turn, in_order))[1])
    out, centres = oc.online_kmeans(frame(spark, points), ["t", "id"], ["a", "b"], start, chunk_rows=500)
    labels, want = plain(points, start, 0.5)
    assert [r.cluster for r in out.orderBy("id").collect()] == labels and centres == want
    assert max(t for t, _ in turns) <= 4 and not any(o for _, o in turns)


def test_a_tie_is_folded_again():
    """Of two centres as near the first one moves, so that another order of the centres may give another fold."""
    a, b, c = (0.0,), (2.0,), (9.0,)
    assert oc.fold([[1.0]], (a, b, c), 0.5) == ([0], ((0.5,), b, c), True)
    assert oc._places((a, b, c), (b, a, c), True) is None and oc._places((a, b, c), (b, c, a), False) == (1, 2, 0)
    assert oc._places((a, a, c), (a, c, a), False) is None
