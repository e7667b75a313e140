"""Token files: documents in id order, their ids packed with Simple-8b, and the reader."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorloom.llm.common import by_size, side
from sensorloom.llm.encode import encoder
from sensorloom.llm.simple8 import pack, unpack
from sensorloom.session import write_scratch

#: Ids at which a record of the file is closed. A longer document has a record of its own.
RECORD_IDS = 1 << 16

SCHEMA = "shard int, record int, start long, n_ids long, doc_ids binary, lengths binary, blocks binary, words binary"
_ARROW = pa.schema([
    ("shard", pa.int32()), ("record", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()),
    ("doc_ids", pa.binary()), ("lengths", pa.binary()), ("blocks", pa.binary()), ("words", pa.binary()),
])


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, text: str = "text", doc_id: str = "doc_id") -> None:
    """Encode ``text``, append ``end_id`` to each document, and write the ids to ``path``.

    The file format is a Parquet folder, so that Spark commits it as a whole, in any store. A
    partition is a shard: documents in ascending ``doc_id`` (null first; equal ids by text), dealt
    by range. A row is a record of whole documents: ``start`` is the shard's ids before it,
    ``doc_ids`` (with nulls as a leading count), ``lengths`` (ids of each document), ``words``
    (the packed ids) and ``blocks`` (the first word of each block of ids). All numbers are
    little-endian. Null text is empty; an empty table gives no record.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, end = encoder(tokenizer), int(end_id).to_bytes(4, "little")
        shard = TaskContext.get().partitionId()
        record = start = 0
        held: list[tuple[int | None, bytes]] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal record, start, held, size
            ids = np.frombuffer(b"".join(b for _, b in held), dtype="<u4")
            words, blocks = pack(ids)
            nulls = sum(d is None for d, _ in held)
            names = np.array([nulls, *(d for d, _ in held if d is not None)], dtype="<i8")
            lengths = np.array([len(b) // 4 for _, b in held], dtype="<i8")
            row = [shard, record, start, len(ids), names.tobytes(), lengths.tobytes(), blocks.astype("<u4").tobytes(), words.astype("<u8").tobytes()]
            record, start, held, size = record + 1, start + len(ids), [], 0
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _ARROW.types, strict=True)], schema=_ARROW)

        for batch in by_size(batches):
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = (of(t) if t else b"") + end
                if held and size + len(ids) > 4 * RECORD_IDS:
                    yield close()
                held.append((doc, ids))
                size += len(ids)
        if held:
            yield close()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encode, SCHEMA).write.parquet(path)


def read_tokens(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """One row per document of a token file: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens``, ``ids_crc32``, and with ``ids`` the ids themselves.

    Shards follow each other; the sum of one number per shard puts them in place.
    """
    records = spark.read.schema(SCHEMA).parquet(path)
    shards = records.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    bases = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                names = np.frombuffer(row["doc_ids"], "<i8")
                docs = [None] * int(names[0]) + names[1:].tolist()
                lengths = np.frombuffer(row["lengths"], "<i8")
                found = unpack(np.frombuffer(row["words"], "<u8"), row["n_ids"]).astype("<u4")
                ends = np.cumsum(lengths)
                begins = ends - lengths
                out = [
                    pa.array(docs, pa.int64()),
                    pa.array(begins + (row["base"] + row["start"])),
                    pa.array(lengths),
                    pa.array([zlib.crc32(found[a:b]) for a, b in zip(begins, ends, strict=True)], pa.int64()),
                ]
                if ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.append(begins, ends[-1:]), pa.int32()), pa.array(found.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(out, names=[x.split()[0] for x in schema.split(", ")])

    return records.join(side(write_scratch(bases, "shards")), "shard").mapInArrow(decode, schema)
