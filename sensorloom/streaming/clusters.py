"""Streaming k-means: centres learn from train batches and forget with a half-life."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.detect.clusters import nearest_centroid
from ..operators.detect.online_clusters import moved_centres
from ..operators.ordered import with_rank
from ..operators.quality import drop_incomplete
from ..session import scratch_scope, write_scratch
from ..sinks.tables import append_batch_to_table

_MODEL = "cluster int, weight double, centre array<double>"


@dataclass
class StreamingKMeans:
    """k centres of d numbers, stored once per train batch below ``model_path``.

    The update is the batch rule of Spark's own streaming k-means: with the old weight
    n decayed by 0.5 ** (1 / halflife) and a batch's rows m, the new centre is
    (n·c + sum of rows) / (n + m). :class:`OnlineKMeans` moves centres row by row.
    """

    model_path: str
    columns: Sequence[str]
    k: int = 3
    halflife: float = 0.5
    seed: int = 42

    def centres(self, spark: SparkSession, before: int | None = None) -> list[tuple[float, list[float]]]:
        """(weight, centre) of the newest stored batch, or of the newest one before a batch."""
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.model_path)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        done = []
        for status in fs.listStatus(path):
            number = int(status.getPath().getName().removeprefix("batch_id="))
            if (before is None or number < before) and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                done.append(number)
        if not done:
            return []
        rows = spark.read.schema(_MODEL).parquet(f"{self.model_path}/batch_id={max(done)}").orderBy("cluster").collect()
        return [(r.weight, list(r.centre)) for r in rows]

    def _first_centres(self, batch: DataFrame) -> list[tuple[float, list[float]]]:
        cols = [F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(self.columns)]
        points = batch.select(*cols).na.drop().distinct()
        names = points.columns
        rows = points.orderBy(F.xxhash64(F.lit(self.seed), *names), *names).limit(self.k).collect()
        return [(0.0, [float(v) for v in r]) for r in rows]

    def learn(self, batch: DataFrame, batch_id: int) -> list[tuple[float, list[float]]]:
        """Update the centres with one batch and store them; returns the new centres."""
        spark = batch.sparkSession
        old = self.centres(spark, before=batch_id) or self._first_centres(batch)
        if not old:
            return []
        labelled = nearest_centroid(batch, self.columns, [c for _, c in old]).where("cluster is not null")
        sums = labelled.groupBy("cluster").agg(
            F.count(F.lit(1)).alias("m"),
            F.array(*[F.sum(F.col(c).cast("double")) for c in self.columns]).alias("s"),
        )
        found = {r.cluster: r for r in sums.collect()}  # k rows
        decay = 0.5 ** (1 / self.halflife)
        new = []
        for i, (weight, centre) in enumerate(old):
            kept = weight * decay
            if i in found:
                m = found[i].m
                centre = [(kept * c + s) / (kept + m) for c, s in zip(centre, found[i].s)]
                kept += m
            new.append((kept, centre))
        self._store(spark, new, batch_id)
        return new

    def _store(self, spark: SparkSession, model: list[tuple[float, list[float]]], batch_id: int) -> None:
        rows = [(i, float(w), [float(v) for v in c]) for i, (w, c) in enumerate(model)]
        frame = spark.createDataFrame(rows, _MODEL).coalesce(1)
        frame.write.mode("overwrite").parquet(f"{self.model_path}/batch_id={batch_id}")

    def label(self, df: DataFrame, centres: list[tuple[float, list[float]]] | None = None) -> DataFrame:
        """Cluster of each row by the given or the newest stored centres; NULL before training."""
        centres = centres if centres is not None else self.centres(df.sparkSession)
        if not centres:
            return df.withColumn("cluster", F.lit(None).cast("int"))
        return nearest_centroid(df, self.columns, [c for _, c in centres]).drop("cluster_distance")

    def train_batches(self, output: str):
        """``foreachBatch`` function: learn from the batch, then label and store its rows."""
        write = append_batch_to_table(output)

        def run(batch: DataFrame, batch_id: int) -> None:
            batch.persist()
            try:
                write(self.label(batch, self.learn(batch, batch_id)), batch_id)
            finally:
                batch.unpersist()

        return run

    def test_batches(self, output: str):
        """``foreachBatch`` function: label and store rows with the last stored centres."""
        write = append_batch_to_table(output)
        return lambda batch, batch_id: write(self.label(batch), batch_id)


@dataclass
class OnlineKMeans(StreamingKMeans):
    """Centres that move with every row of a train batch, in order, ``halflife`` of the way to it.

    A batch is folded in chunks by all tasks (:mod:`..operators.detect.online_clusters`) from the centres that the batch before left, so
    that the numbers are those of one row after the other, however the rows fall into batches. ``order`` must identify a row;
    ``start`` are the first centres, else the first different rows are. A centre's weight is the number of its rows.
    """

    order: Sequence[str] = ()
    start: Sequence[Sequence[float]] | None = None
    chunk_rows: int | None = None

    def learn(self, batch: DataFrame, batch_id: int) -> list[tuple[float, list[float]]]:
        spark = batch.sparkSession
        old = self.centres(spark, before=batch_id)
        first = [c for _, c in old] if old else self.start
        with scratch_scope(spark):
            complete = drop_incomplete(batch.select(*dict.fromkeys([*self.order, *self.columns])), self.columns)
            ranked = write_scratch(with_rank(complete, [], self.order, "__rank", self.chunk_rows), "online_rows")
            rows, new = moved_centres(ranked, self.columns, first, self.k, self.halflife, "__moved", self.chunk_rows)
            counts = {r["__moved"]: r["count"] for r in rows.groupBy("__moved").count().collect()} if rows else {}
        if not new:
            return []
        before = [w for w, _ in old] or [0.0] * len(new)
        model = [(w + counts.get(i, 0), c) for i, (w, c) in enumerate(zip(before, new))]
        self._store(spark, model, batch_id)
        return model
