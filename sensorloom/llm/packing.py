"""Packing documents into sequences of fixed length: dominance reduction, then best fit."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorloom.llm.common import by_size
from sensorloom.llm.encode import encoder
from sensorloom.session import write_scratch


class Plan:
    """Where the pieces of each length go, as runs: the pieces of length ``size`` numbered from
    ``first`` on, ``n`` of them, go to the sequences from ``sequence`` on, one each, at ``offset``."""

    def __init__(self, counts: np.ndarray, capacity: int):
        self.counts, self.capacity = counts.astype(np.int64).copy(), capacity
        self.taken = np.zeros_like(self.counts)
        self.sequences = 0
        self.runs: list[tuple[int, int, int, int, int]] = []

    def place(self, size: int, n: int, sequence: int, offset: int) -> None:
        self.runs.append((size, int(self.taken[size]), n, sequence, offset))
        self.taken[size] += n
        self.counts[size] -= n

    def fix(self, sizes: list[int], n: int) -> None:
        """``n`` new sequences, closed, each of one piece of every size in ``sizes``."""
        offset = 0
        for size in sizes:
            self.place(size, n, self.sequences, offset)
            offset += size
        self.sequences += n


def _below(counts: np.ndarray, limit: int) -> int:
    """The largest size up to ``limit`` that is left, or 0."""
    found = np.flatnonzero(counts[1 : limit + 1])
    return int(found[-1]) + 1 if len(found) else 0


def reduce_dominated(plan: Plan) -> None:
    """Fix sets that dominate every other set their first piece could share a sequence with.

    A set dominates another with the same first piece if the other's further pieces can be spread
    over its own without outgrowing them; some best packing then holds it (Martello and Toth). All
    pieces of one size are alike, so that a set is fixed as often as its sizes last:

    * a piece of size s with one of exactly ``capacity - s``: whatever else would join s fits
      into the partner;
    * the largest piece alone, if nothing fits beside it;
    * the largest piece with the largest that fits, if no two others fit beside it;
    * the largest piece with the two largest that fit, if no three fit and no other pair has
      a larger second piece.
    """
    c, counts = plan.capacity, plan.counts
    if counts[c]:
        plan.fix([c], int(counts[c]))
    for s in range(c - 1, c // 2, -1):
        if n := int(min(counts[s], counts[c - s])):
            plan.fix([s, c - s], n)
    if c % 2 == 0 and counts[c // 2] > 1:
        plan.fix([c // 2, c // 2], int(counts[c // 2] // 2))
    while (s := _below(counts, c)):
        counts[s] -= 1  # the piece itself is no partner
        room = c - s
        a = _below(counts, room)
        left = np.flatnonzero(counts[:s + 1]).tolist()
        least = [x for x in left[:3] for _ in range(min(3, int(counts[x])))][:3]
        counts[s] += 1
        if not a:
            plan.fix([s], 1 if s <= c // 2 else int(counts[s]))
        elif a == room or len(least) < 2 or sum(least[:2]) > room:
            plan.fix([s, a], int(counts[s] // 2) if s == a else int(min(counts[s], counts[a])))
        elif len(least) < 3 or sum(least) > room:
            counts[s] -= 1
            counts[a] -= 1
            b = _below(counts, room - a)
            counts[a] += 1
            # The largest second piece of any pair: two of one size, or a size with a larger one.
            y = _below(counts, room // 2)
            counts[s] += 1
            same = s in (a, b) or a == b
            if b and y <= b:
                plan.fix([s, a, b], 1 if same else int(min(counts[s], counts[a], counts[b])))
            else:
                return
        else:
            return


def best_fit(plan: Plan) -> None:
    """Place what is left, largest first, each where the least room remains.

    Sequences with equal room are kept as ranges, so that the work depends on the number of
    sizes and not of pieces.
    """
    c = plan.capacity
    rooms: dict[int, list[tuple[int, int]]] = {}  # room: ranges (first sequence, number)
    filled = np.zeros(c + 1, bool)
    for size in range(c, 0, -1):
        while left := int(plan.counts[size]):
            fits = np.flatnonzero(filled[size:])
            if len(fits):
                room = int(fits[0]) + size
                first, n = rooms[room].pop()
                if n > left:
                    rooms[room].append((first + left, n - left))
                filled[room] = bool(rooms[room])
                n = min(n, left)
                plan.place(size, n, first, c - room)
                rest = room - size
            else:
                each = c // size
                n = max(left // each, 1)
                each = min(each, left)
                first, plan.sequences = plan.sequences, plan.sequences + n
                for k in range(each):
                    plan.place(size, n, first, k * size)
                rest = c - each * size
            if rest:
                rooms.setdefault(rest, []).append((first, n))
                filled[rest] = True


def plan_packing(counts: np.ndarray, capacity: int) -> Plan:
    """The whole plan for ``counts[size]`` pieces of each size up to ``capacity``."""
    plan = Plan(counts, capacity)
    reduce_dominated(plan)
    best_fit(plan)
    return plan


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, text: str = "text", doc_id: str = "doc_id", ids: bool = False) -> DataFrame:
    """The pieces of every document, written once: doc_id, piece, start, length, ids_crc32, with
    ``ids`` the ids, and the piece's number among those of its length in its task.

    A document is its ids and ``end_id``. Only one longer than ``capacity`` is cut, so that all
    pieces but the first are full.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, end = encoder(tokenizer), int(end_id).to_bytes(4, "little")
        task, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in by_size(batches):
            out: list[tuple] = []
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = (of(t) if t else b"") + end
                n = len(found) // 4
                a = 0
                b = n % capacity or min(n, capacity)
                piece = 0
                while a < n:
                    part = found[4 * a : 4 * b]
                    out.append((doc, piece, a, b - a, zlib.crc32(part), task, seen[b - a], np.frombuffer(part, "<u4") if ids else None))
                    seen[b - a] += 1
                    piece, a, b = piece + 1, b, b + capacity
            columns = list(zip(*out, strict=True))
            arrays = [pa.array(x, k) for x, k in zip(columns, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), *[pa.list_(pa.uint32())] * ids]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "__task", "__nth", *["ids"] * ids]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, __task int, __nth long" + ", ids array<long>" * ids
    if ids:
        kinds[-1] = pa.list_(pa.int64())
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return write_scratch(rows.mapInArrow(cut, schema), "pieces")


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, text: str = "text", doc_id: str = "doc_id", ids: bool = False) -> DataFrame:
    """One row per piece of :func:`cut_pieces` with its ``sequence_id`` and ``offset`` there.

    Only the number of pieces of each length, ``capacity`` numbers, comes to the driver, where
    the plan is made; the plan's runs go back to the tasks. A piece finds its run by its number
    among all pieces of its length: its number within its task, and the pieces of the tasks
    before. No length's pieces meet in one task. An empty table gives no piece; a null text has
    the end id alone; repeated rows are packed each.
    """
    pieces = cut_pieces(docs, tokenizer, capacity, end_id, text, doc_id, ids)
    tasks = write_scratch(pieces.groupBy("length", "__task").agg((F.max("__nth") + 1).alias("n")), "piece_counts")
    counts = np.zeros(capacity + 1, np.int64)
    for size, n in tasks.groupBy("length").agg(F.sum("n")).collect():  # at most ``capacity`` rows
        counts[size] = n
    runs = np.array(sorted(plan_packing(counts, capacity).runs), dtype=np.int64).reshape(-1, 5)
    before = tasks.select(
        "length", "__task", (F.sum("n").over(Window.partitionBy("length").orderBy("__task")) - F.col("n")).alias("__before")
    )
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * ids]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = np.int64(1) << np.int64(50)
        begins = runs[:, 0] * step + runs[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            number = batch.column("number").to_numpy()
            run = runs[np.searchsorted(begins, batch.column("length").to_numpy() * step + number, side="right") - 1]
            sequence = run[:, 3] + number - run[:, 1]
            columns = [batch.column(c) for c in kept] + [pa.array(sequence), pa.array(run[:, 4])]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "sequence_id", "offset"])

    numbered = pieces.join(before, ["length", "__task"]).select(*kept, (F.col("__before") + F.col("__nth")).alias("number"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * ids + ", sequence_id long, offset long"
    return numbered.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``ids`` and ``doc_ids`` (by place).

    ``packed`` is :func:`pack` with ``ids``; a sequence's pieces hold ``capacity`` ids at most.
    """
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"), F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"))
