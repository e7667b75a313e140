"""What several operators of this subpackage share: small batches, ranks, side tables, components."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorloom.session import write_scratch

#: Rows of two 8-byte numbers that may be broadcast: 16 MB. Beyond it the join shuffles.
SMALL_ROWS = 1_000_000


def by_size(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that ``column`` takes about ``limit`` bytes (one row at least) in each."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for at, n in enumerate(sizes.tolist()):
            if held and held + n > limit:
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def ranked(df: DataFrame, order: Sequence[str], rank: str, name: str = "ranked") -> DataFrame:
    """``df`` with its row number from 0 in the order of ``order``, without one task that sees all rows.

    Rows are dealt by range and written in order; a row's number is the size of the ranges before
    its own plus its place there. One row per range is summed up in one task.
    """
    kept = df.columns
    at = write_scratch(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), name
    )
    at = at.withColumn("__range", F.shiftright("__at", 33))
    sizes = at.groupBy("__range").agg((F.max("__at") - F.min("__at") + 1).alias("__n"))
    before = sizes.select(
        "__range",
        (F.sum("__n").over(Window.orderBy("__range")) - F.col("__n")).alias("__before"),
    )
    place = F.col("__at") - F.shiftleft("__range", 33)
    return at.join(before, "__range").select(*kept, (F.col("__before") + place).alias(rank))


def side(table: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A written table of few narrow columns, marked for broadcast if it has at most ``rows`` rows."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def key_of(column: str) -> list[Column]:
    """Two columns that tell every value of a text column apart, null from all others."""
    return [F.col(column).isNull().alias(f"{column}__null"), F.coalesce(F.col(column), F.lit("")).alias(f"{column}__text")]


def parts_for(spark: SparkSession, rows: int, each: int) -> int:
    """Partitions for ``rows`` rows at about ``each`` a partition, the session's number at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / each))


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``links``; a component is named by its smallest node.

    Alternating stars: every node's larger neighbours are linked to its smallest neighbour, then
    its smaller ones, until nothing changes. A round keeps at most the links there were, and a
    node's neighbours are never gathered: only their minimum is, which is summed before the
    shuffle. Each round is written to the shared folder, so that a lost executor repeats a round.
    Links grow with the input: their joins shuffle at every size.
    """
    edges = write_scratch(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links"
    )
    last = None
    for _ in range(most_rounds):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: u's larger neighbours v get the link (v, m).
        large = both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: u's smaller neighbours, and u itself, get the link to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low.hint("merge"), "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u <> v").distinct()
        edges = write_scratch(small, "links")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(tops)
