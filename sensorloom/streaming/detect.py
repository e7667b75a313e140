"""Two-phase detection: statistics of a bounded read, flags on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ..operators.detect.bands import ksigma_fit, ksigma_flag
from ..operators.detect.nearest import knn_score_whole
from ..operators.detect.neighbours import knn_score
from ..session import scratch_scope
from ..sinks.tables import append_batch_to_table


def ksigma_stream(
    history: DataFrame, stream: DataFrame, column: str, k: float = 1, baseline: Column | None = None
) -> DataFrame:
    """Flag a stream against mean ± k·std of the history (one row, taken when the job starts)."""
    stats = ksigma_fit(history, column, baseline).first()
    if stats.mean is None or stats.std is None:
        raise ValueError("the baseline needs at least two readings")
    return ksigma_flag(stream, column, (stats.mean, stats.std), k)


def knn_batches(path: str, order: list[str], columns: list[str], k: int = 5, block_rows: int | None = 500):
    """``foreachBatch`` function: score each micro-batch against itself and store it.

    A batch above ``block_rows`` is scored in blocks of that many consecutive rows. With ``block_rows=None`` every row is held against
    the whole micro-batch, whatever its size (:mod:`..operators.detect.nearest`).
    """
    write = append_batch_to_table(path)

    def run(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            if block_rows is None:
                write(knn_score_whole(batch, [], columns, k), batch_id)
                return
            batch.persist()
            try:
                write(knn_score(batch, order, columns, k, block_rows).drop("block"), batch_id)
            finally:
                batch.unpersist()

    return run
