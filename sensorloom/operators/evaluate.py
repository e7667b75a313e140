"""Scores of predicted labels against the truth. All from one small contingency table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pairs(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    known = df.where(F.col(truth).isNotNull() & F.col(prediction).isNotNull())
    return known.groupBy(F.col(truth).alias("truth"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def _f1(precision: str, recall: str) -> Column:
    p, r = F.col(precision), F.col(recall)
    return _ratio(2 * p * r, p + r)


def confusion_matrix(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """Rows per (truth, prediction) over all labels of either side, with zeros for pairs that
    never occur.

    The grid lists every label with every label; the contingency table, a row per pair that
    occurs, is joined to it on both.
    """
    pairs = _pairs(df, truth, prediction)
    seen = pairs.agg(F.array_sort(F.array_union(F.collect_set("truth"), F.collect_set("prediction"))).alias("labels"))
    grid = seen.select("labels", F.explode("labels").alias("truth"))
    grid = grid.select("truth", F.explode("labels").alias("prediction"))
    met = grid.join(pairs, ["truth", "prediction"], "left")
    return met.select("truth", "prediction", F.coalesce("n", F.lit(0)).alias("n_rows"))


def _per_class(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """Hits, predictions and support of every class that occurs on either side."""
    pairs = _pairs(df, truth, prediction)
    sides = F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("prediction").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
    )
    hit = F.when((F.col("truth") == F.col("prediction")) & (F.col("s.support") > 0), F.col("n")).otherwise(0)
    return (
        pairs.select("truth", "prediction", "n", F.explode(sides).alias("s"))
        .groupBy(F.col("s.label").alias("label"))
        .agg(F.sum(hit).alias("hit"), F.sum("s.predicted").alias("predicted"), F.sum("s.support").alias("support"))
    )


def classification_report(
    df: DataFrame, truth: str, prediction: str, names: dict[object, str] | None = None
) -> DataFrame:
    """Precision, recall, F1 and support per class, plus accuracy and two averages.

    The accuracy line carries the accuracy in all three score columns.
    """
    names = names or {0: "Normal", 1: "Anomaly"}
    scored = (
        _per_class(df, truth, prediction)
        .withColumn("precision", _ratio(F.col("hit"), F.col("predicted")))
        .withColumn("recall", _ratio(F.col("hit"), F.col("support")))
        .withColumn("f1_score", _f1("precision", "recall"))
    )
    label = F.col("label").cast("string")
    name = F.coalesce(F.element_at(F.create_map(*[F.lit(str(x)) for kv in names.items() for x in kv]), label), label)
    scores = ["precision", "recall", "f1_score"]
    total = F.sum("support")
    summary = scored.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("label"),
                *[_ratio(F.sum("hit"), total).alias(s) for s in scores], total.alias("support"),
            ),
            F.struct(F.lit("macro avg").alias("label"), *[F.avg(s).alias(s) for s in scores], total.alias("support")),
            F.struct(
                F.lit("weighted avg").alias("label"),
                *[_ratio(F.sum(F.col(s) * F.col("support")), total).alias(s) for s in scores],
                total.alias("support"),
            ),
        ).alias("a")
    )
    summary = summary.select(F.explode("a").alias("s")).select("s.*")
    return scored.select(name.alias("label"), *scores, "support").unionByName(summary)


def binary_scores(df: DataFrame, truth: str, prediction: str, positive: int = 1) -> DataFrame:
    """Precision, recall and F1 of the positive class."""
    t, p = F.col(truth) == positive, F.col(prediction) == positive
    known = df.where(F.col(truth).isNotNull() & F.col(prediction).isNotNull())
    counts = known.agg(
        F.count_if(t & p).alias("tp"), F.count_if(p).alias("predicted"), F.count_if(t).alias("actual")
    )
    return (
        counts.select(
            _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
            _ratio(F.col("tp"), F.col("actual")).alias("recall"),
        )
        .withColumn("f1_score", _f1("precision", "recall"))
    )


def accuracy(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """Share of rows whose labels agree."""
    return df.agg(F.avg((F.col(truth) == F.col(prediction)).cast("double")).alias("accuracy"))
