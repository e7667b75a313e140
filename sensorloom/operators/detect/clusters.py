"""Scaling, centroids and clustering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.parsing import flag
from ...session import write_scratch


def minmax_scale(
    df: DataFrame, columns: Sequence[str], fit_on: DataFrame | str = "self", suffix: str = "_scaled"
) -> DataFrame:
    """(x - min) / (max - min) with the limits of ``fit_on``; a constant column gives NULL.

    ``fit_on`` is usually the train rows. The limits enter the plan as one scalar row.
    """
    base = df if isinstance(fit_on, str) else fit_on
    limits = base.agg(
        F.struct(
            *[F.min(c).cast("double").alias(f"lo_{c}") for c in columns],
            *[F.max(c).cast("double").alias(f"hi_{c}") for c in columns],
        ).alias("l")
    ).scalar()
    scaled = []
    for c in columns:
        lo, hi = limits.getField(f"lo_{c}"), limits.getField(f"hi_{c}")
        scaled.append(((F.col(c) - lo) / F.nullif(hi - lo, F.lit(0.0))).alias(f"{c}{suffix}"))
    return df.select("*", *scaled)


def squared_distance(columns: Sequence[str], centre: Sequence[float]) -> Column:
    total = F.lit(0.0)
    for c, m in zip(columns, centre):
        gap = F.col(c).cast("double") - F.lit(float(m))
        total = total + gap * gap
    return total


def nearest_centroid(
    df: DataFrame, columns: Sequence[str], centres: Sequence[Sequence[float]], name: str = "cluster"
) -> DataFrame:
    """Index of the nearest centre and the distance to it; ties take the lowest index.

    Centres are a model of a few rows, so they are literals of one expression.
    """
    best = F.array_min(
        F.array(
            *[
                F.struct(squared_distance(columns, m).alias("d"), F.lit(i).alias("i"))
                for i, m in enumerate(centres)
            ]
        )
    )
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    return df.withColumn("__best", F.when(known, best)).select(
        *df.columns, F.col("__best.i").alias(name), F.sqrt("__best.d").alias(f"{name}_distance")
    )


def kmeans_fit(df: DataFrame, columns: Sequence[str], k: int = 2, seed: int = 42) -> PipelineModel:
    """Clusters of the given (scaled) columns; rows with a missing value are skipped.

    Every iteration reads the features, so they are written once and read back.
    """
    vector = VectorAssembler(inputCols=list(columns), outputCol="__features", handleInvalid="skip")
    means = KMeans(k=k, seed=seed, featuresCol="__features", predictionCol="cluster")
    return Pipeline(stages=[vector, means]).fit(write_scratch(df.select(*columns), "features"))


def kmeans_predict(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Cluster number of every complete row."""
    return model.transform(df).drop("__features")


def smallest_cluster(df: DataFrame, column: str = "cluster") -> int:
    """Number of the cluster with the fewest rows, which stands for anomalies."""
    sizes = df.groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    return sizes.orderBy("__n", column).first()[0]


def smallest_trained_cluster(model: PipelineModel) -> int:
    """:func:`smallest_cluster` of the rows a model was just fitted on, from its own summary."""
    sizes = model.stages[-1].summary.clusterSizes
    return min(range(len(sizes)), key=lambda k: (sizes[k], k))


def kmeans_anomalies(
    df: DataFrame, model: PipelineModel, anomaly_cluster: int | None = None, name: str = "prediction"
) -> DataFrame:
    """1 for rows of the anomaly cluster. Fix that cluster on train rows and pass it for test rows."""
    labelled = kmeans_predict(df, model)
    if anomaly_cluster is None:
        anomaly_cluster = smallest_cluster(labelled)
    return labelled.withColumn(name, flag(F.col("cluster") == anomaly_cluster))
