"""Scores of the 100-row fixture counted by hand: TN 83, FP 8, FN 0, TP 9."""

import pytest

from sensorloom.operators import evaluate as e


@pytest.fixture(scope="module")
def df(spark):
    rows = [(0, 0)] * 83 + [(0, 1)] * 8 + [(1, 1)] * 9
    return spark.createDataFrame(rows, "t int, p int")


def test_confusion(df):
    got = {(r["truth"], r["prediction"]): r["n_rows"] for r in e.confusion_matrix(df, "t", "p").collect()}
    assert got == {(0, 0): 83, (0, 1): 8, (1, 0): 0, (1, 1): 9}


def test_report(df):
    rows = {r["label"]: r for r in e.classification_report(df, "t", "p").collect()}
    line = lambda k: [rows[k][c] for c in ("precision", "recall", "f1_score", "support")]
    assert line("Anomaly") == pytest.approx([9 / 17, 1, 18 / 26, 9])
    assert line("Normal") == pytest.approx([1, 83 / 91, 166 / 174, 91])
    assert line("accuracy") == pytest.approx([0.92, 0.92, 0.92, 100])
    assert line("macro avg")[0] == pytest.approx((1 + 9 / 17) / 2)
    assert line("weighted avg")[2] == pytest.approx((166 / 174 * 91 + 18 / 26 * 9) / 100)


def test_binary(df):
    r = e.binary_scores(df, "t", "p").first()
    assert [r["precision"], r["recall"], r["f1_score"]] == pytest.approx([9 / 17, 1, 18 / 26])
    assert e.accuracy(df, "t", "p").first()[0] == pytest.approx(0.92)


def test_nothing_predicted(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "t int, p int")
    r = e.binary_scores(df, "t", "p").first()
    assert [r["precision"], r["recall"], r["f1_score"]] == [0, 0, 0]
    rows = {x["label"]: x for x in e.classification_report(df, "t", "p").collect()}
    assert rows["Anomaly"]["recall"] == 0 and rows["Normal"]["precision"] == 0.5


def test_labels_of_either_side(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "a"), ("c", None)], "t string, p string")
    got = {(r["truth"], r["prediction"]): r["n_rows"] for r in e.confusion_matrix(df, "t", "p").collect()}
    assert got == {("a", "a"): 1, ("a", "b"): 1, ("b", "a"): 0, ("b", "b"): 0}
