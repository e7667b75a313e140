"""k-means whose centres move with every row: an ordered fold, done by all tasks at once.

A row goes to its nearest centre, which moves ``step`` of the way towards it. That is sequential, but a centre forgets: after some fifty rows
at a step of a half nothing of where it was is left in its digits. So the rows are cut into chunks of the order, every
chunk is folded at once from guessed centres, and again from what the chunk before it left, until no chunk
starts from other centres than its predecessor ended with, bit by bit. Then the chunks are the fold from end to end. A
centre that a chunk never moved is handed on as it came. Two folds often come to the same centres under other numbers, and stay so: a chunk that
began with the centres of its predecessor in another order, and met no row as near to one centre as to another, is renumbered and
not folded again. Should chunks not settle in a bounded number of rounds, the rest is
folded in order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...session import write_scratch
from ..ordered import with_rank
from ..quality import drop_incomplete
from .drift_walk import _lists

CHUNK_ROWS = 32_768
MOST_ROUNDS = 8

Centres = tuple[tuple[float, ...], ...]

_FOLDED = "id long, labels array<int>, centres array<double>, tied boolean, turn int"


def fold(rows: Sequence[Sequence[float]], centres: Centres, step: float) -> tuple[list[int], Centres, bool]:
    """The centre each row moves, ties to the first, the centres afterwards, and whether the order of the centres may have decided a row."""
    now = [list(c) for c in centres]
    labels, tied = [], False
    for x in rows:
        best, least = 0, float("inf")
        for j, c in enumerate(now):
            square = 0.0
            for a, b in zip(x, c):
                square += (a - b) * (a - b)
            if square < least:
                best, least = j, square
            elif square == least:
                tied = True
        if not least < float("inf"):
            tied = True
        c = now[best]
        for i, a in enumerate(x):
            c[i] += step * (a - c[i])
        labels.append(best)
    return labels, tuple(map(tuple, now)), tied


def _fold_rows(chunks: DataFrame, size: int, step: float, turn: int, in_order: bool) -> DataFrame:
    """Fold chunks, each from its ``start``; ``in_order`` the first from its own and each other one from the one before."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: Centres | None = None
        for batch in batches:
            out = []
            for id, flat, start in zip(batch.column("id").to_pylist(), _lists(batch, "x"), _lists(batch, "start")):
                if not in_order or carried is None:
                    carried = tuple(map(tuple, start.reshape(-1, size).tolist()))
                labels, carried, tied = fold(flat.reshape(-1, size).tolist(), carried, step)
                out.append((id, labels, [v for c in carried for v in c], tied, turn))
            if out:
                kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.bool_(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["id", "labels", "centres", "tied", "turn"])

    return write_scratch(chunks.select("id", "x", "start").mapInArrow(task, _FOLDED), "folded")


def _places(used: Centres | None, now: Centres, tied: bool) -> tuple[int, ...] | None:
    """Where each centre of ``now`` stands in ``used``; None if a fold from ``used`` does not tell the one from ``now``."""
    if used == now:
        return tuple(range(len(now)))
    if used is None or tied or len(set(used)) < len(used) or sorted(used) != sorted(now):
        return None
    return tuple(used.index(c) for c in now)


def _guesses(used: list, left: list, moved: list, tied: list, places: list, first: Centres) -> list[tuple[int, Centres]]:
    """The chunks that were not folded from the centres before them, with those centres as far as they can be told.

    ``places`` is set to the places of the true centres in what each other chunk was folded from.
    """
    out, now = [], first
    for k in range(len(used)):
        places[k] = _places(used[k], now, tied[k])
        if places[k] is not None:
            now = tuple(left[k][i] for i in places[k])
            continue
        out.append((k, now))
        if left[k] is not None:
            now = tuple(end if k_moved else start for end, k_moved, start in zip(left[k], moved[k], now))
    return out


def online_kmeans(
    df: DataFrame,
    order: Sequence[str],
    columns: Sequence[str],
    centres: Sequence[Sequence[float]] | None = None,
    k: int = 3,
    step: float = 0.5,
    name: str = "cluster",
    chunk_rows: int | None = None,
    most_rounds: int = MOST_ROUNDS,
) -> tuple[DataFrame, list[list[float]]]:
    """Rows with the centre that each one moved, and the centres after the last row.

    Starts from ``centres``, or from the first ``k`` different rows in order. Incomplete rows move nothing and have no
    cluster. The order columns must identify a row. A column ``name`` is replaced.
    """
    columns = list(columns)
    df = df.drop(name)
    ranked = write_scratch(with_rank(drop_incomplete(df, columns), [], order, "__rank", chunk_rows), "online_rows")
    labels, last = moved_centres(ranked, columns, centres, k, step, name, chunk_rows, most_rounds)
    if labels is None:
        return df.withColumn(name, F.lit(None).cast("int")), last
    out = ranked.join(labels, "__rank").drop("__rank").unionByName(_incomplete(df, columns), allowMissingColumns=True)
    return out, last


def moved_centres(
    ranked: DataFrame,
    columns: Sequence[str],
    centres: Sequence[Sequence[float]] | None = None,
    k: int = 3,
    step: float = 0.5,
    name: str = "cluster",
    chunk_rows: int | None = None,
    most_rounds: int = MOST_ROUNDS,
) -> tuple[DataFrame | None, list[list[float]]]:
    """The centre that each of the rows ``ranked`` moved, as ``__rank`` and ``name``, and the centres after the last row.

    ``__rank`` numbers complete rows from 1. For :func:`online_kmeans`, and for those who need the centres and not the rows.
    """
    spark, size = ranked.sparkSession, len(columns)
    rows = ranked.select("__rank", F.array(*[F.col(c).cast("double") for c in columns]).alias("__x"))
    each = chunk_rows or CHUNK_ROWS
    if centres is None:
        firsts = rows.groupBy("__x").agg(F.min("__rank").alias("__rank")).orderBy("__rank").limit(k).collect()
        centres = [r["__x"] for r in firsts]
    first: Centres = tuple(tuple(float(v) for v in c) for c in centres)
    chunks = rows.groupBy(F.floor((F.col("__rank") - 1) / each).alias("id")).agg(F.array_sort(F.collect_list(F.struct("__rank", "__x"))).alias("rows"))
    chunks = write_scratch(chunks.select("id", F.flatten(F.transform("rows", lambda r: r.getField("__x"))).alias("x")), "online_chunks")
    n = chunks.count()
    used: list[Centres | None] = [None] * n
    left: list[Centres | None] = [None] * n
    moved: list[list[bool] | None] = [None] * n
    tied, places = [False] * n, [None] * n
    done, turn = [], 0
    while first and (todo := _guesses(used, left, moved, tied, places, first)):
        turn += 1
        in_order = turn > most_rounds
        todo = todo[:1] if in_order else todo
        starts = spark.createDataFrame([(c, [v for x in now for v in x]) for c, now in todo], "id long, start array<double>")
        if in_order:
            rest = chunks.where(F.col("id") >= todo[0][0]).join(starts, "id", "left")
            rest = rest.repartition(1).sortWithinPartitions("id")
            done.append(_fold_rows(rest, size, step, turn, True))
            places[todo[0][0] :] = [None] * (n - todo[0][0])
            break
        # Few bytes are long work: Spark by itself would put them in one task.
        tasks = min(len(todo), 4 * spark.sparkContext.defaultParallelism)
        folded = _fold_rows(chunks.join(starts, "id").repartition(tasks, "id"), size, step, turn, False)
        done.append(folded)
        start = dict(todo)
        for r in folded.select("id", "centres", "tied", F.array_distinct("labels").alias("moved")).collect():
            end = tuple(tuple(r.centres[i : i + size]) for i in range(0, len(r.centres), size))
            used[r.id], left[r.id], moved[r.id], tied[r.id] = start[r.id], end, [j in r.moved for j in range(len(first))], r.tied
    if not done:
        return None, [list(c) for c in first]
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    last = write_scratch(found.groupBy("id").agg(F.max_by(F.struct("labels", "centres"), "turn").alias("w")).select("id", "w.*"), "online_folds")
    flat = last.orderBy(F.desc("id")).select("centres").first()[0]
    ends = [flat[i : i + size] for i in range(0, len(flat), size)]
    own = list(range(len(first)))
    if places[-1] is not None:
        ends = [ends[i] for i in places[-1]]
    labels = last.select("id", F.posexplode("labels").alias("at", name))
    other = [(k, [p.index(j) for j in own]) for k, p in enumerate(places) if p is not None and list(p) != own]
    if other:
        names = spark.createDataFrame(other, "id long, __names array<int>")
        labels = labels.join(F.broadcast(names), "id", "left").withColumn(name, F.coalesce(F.get("__names", F.col(name)), name))
    return labels.select((F.col("id") * each + F.col("at") + 1).alias("__rank"), name), ends


def _incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows that ``drop_incomplete`` leaves out."""
    missing = None
    for c in columns:
        one = F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
        missing = one if missing is None else missing | one
    return df.where(missing)
