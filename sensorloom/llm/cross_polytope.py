"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import components, side
from sensorloom.llm.words import mix
from sensorloom.session import write_scratch

#: Vectors of a bucket that meet in one row; a larger bucket is dealt into blocks, and every two
#: blocks meet.
BLOCK = 512
#: Buckets a vector looks into besides its own, in each table.
PROBES = 2


def tuned(rows: int) -> tuple[int, int]:
    """``(tables, hashes of each)`` for so many vectors: another hash for each 500 000, as a hash of 64
    dimensions has 128 values, and more tables, as a pair of cosine 0.95 then meets less often."""
    hashes = 2
    while rows > 500_000 * 128 ** (hashes - 2):
        hashes += 1
    return 4 + 4 * hashes, hashes


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, in log2(d) passes of sums and differences."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x


def codes(x: np.ndarray, tables: int, hashes: int, seed: int = 0) -> np.ndarray:
    """For each row and table the key of its own bucket and of PROBES further ones.

    A hash is the largest coordinate, with its sign, after three rounds of random signs and a
    Hadamard transform. The further buckets replace the one hash whose second largest coordinate
    comes closest to the largest.
    """
    n, d = x.shape
    width = 1 << max(0, d - 1).bit_length()
    padded = np.zeros((n, width))
    padded[:, :d] = x
    signs = np.random.RandomState(seed).choice([-1.0, 1.0], size=(tables * hashes, 3, width))
    first = np.empty((n, tables, hashes), np.uint64)
    second = np.empty((n, tables, hashes), np.uint64)
    gap = np.empty((n, tables, hashes))
    rows = np.arange(n)
    for k in range(tables * hashes):
        y = padded
        for s in signs[k]:
            y = hadamard(y * s)
        size = np.abs(y)
        best = size.argmax(axis=1)
        top = size[rows, best].copy()
        size[rows, best] = -1.0
        other = size.argmax(axis=1)
        t, i = divmod(k, hashes)
        first[:, t, i] = 2 * best + (y[rows, best] < 0)
        second[:, t, i] = 2 * other + (y[rows, other] < 0)
        gap[:, t, i] = 1 - size[rows, other] / np.maximum(top, 1e-300)
    base = np.uint64(2 * width)
    power = base ** np.arange(hashes, dtype=np.uint64)
    own = (first * power).sum(axis=2, dtype=np.uint64)
    out = np.empty((n, tables, 1 + PROBES), np.uint64)
    out[:, :, 0] = own
    order = np.argsort(gap, axis=2, kind="stable")
    for p in range(PROBES):
        if p < hashes:
            i = order[:, :, p][:, :, None]
            a, b = np.take_along_axis(first, i, 2)[:, :, 0], np.take_along_axis(second, i, 2)[:, :, 0]
            out[:, :, 1 + p] = own + (b - a) * power[i[:, :, 0]]
        else:
            out[:, :, 1 + p] = own
    # Other tables have other keys, and so, but for chance, have vectors of other dimensions.
    salt = np.arange(tables, dtype=np.uint64)[None, :, None] + np.uint64(d * 1000)
    return mix(out + mix(salt, 5), 9)


def _valid(column: pa.ListArray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """For every row whether it can link, and the rows and vectors of each dimension that can."""
    n = len(column)
    lengths = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    good = np.zeros(n, bool)
    groups = []
    for d in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == d)
        flat = column.take(pa.array(rows)).flatten()
        x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
        fine = np.isfinite(x).all(axis=1) & (np.abs(x) > 0).any(axis=1)
        good[rows[fine]] = True
        groups.append((rows[fine], x[fine]))
    return good, groups


def _hashed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 128-bit hash of each row's numbers."""
    raw = np.ascontiguousarray(x).view(np.uint64)
    at = mix(np.arange(x.shape[1], dtype=np.uint64), x.shape[1])
    return tuple(mix(raw ^ at, k).sum(axis=1, dtype=np.uint64).view(np.int64) for k in (3, 5))


def _signatures(vectors: DataFrame) -> DataFrame:
    """``vec`` and two hashes of the vector, null where it cannot link."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, groups = _valid(batch.column(1))
            s = np.zeros((2, len(good)), np.int64)
            for rows, x in groups:
                s[:, rows] = _hashed(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(k, mask=~good) for k in s]], names=["vec", "s1", "s2"])

    return vectors.mapInArrow(sign, "vec long, s1 long, s2 long")


def _coded(classes: DataFrame, tables: int, hashes: int) -> DataFrame:
    """``rep``, ``copies``, the vector, its dimension ``d``, and the bucket keys of all tables."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2000):
                part = batch.slice(a, 2000)
                for rows, x in _valid(part.column("vector"))[1]:
                    kept = part.take(pa.array(rows))
                    # Half of a key will do: buckets that fall together are only compared more.
                    keys = (codes(x, tables, hashes).reshape(-1) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                    lists = pa.FixedSizeListArray.from_arrays(pa.array(keys), tables * (1 + PROBES)).cast(pa.list_(pa.int32()))
                    d = pa.array(np.full(len(x), x.shape[1], np.int32))
                    yield pa.RecordBatch.from_arrays([kept.column("rep"), kept.column("copies"), kept.column("vector"), d, lists], names=["rep", "copies", "vector", "d", "keys"])

    kind = dict(classes.dtypes)["vector"]
    return classes.mapInArrow(code, f"rep long, copies long, vector {kind}, d int, keys array<int>")


def _first_meeting(keys_a: np.ndarray, keys_b: np.ndarray, table: int, bucket: np.int32) -> np.ndarray:
    """Whether this bucket of this table is the first in which rows and columns meet, one of them in its own."""
    met = np.zeros((len(keys_a), len(keys_b)), bool)
    for t in range(table + 1):
        own_a, own_b = keys_a[:, t, 0][:, None], keys_b[:, t, 0][None]
        in_b = np.zeros_like(met)  # b looks into a's bucket
        in_a = np.zeros_like(met)
        for p in range(PROBES):
            in_b |= own_a == keys_b[:, t, 1 + p][None]
            in_a |= keys_a[:, t, 1 + p][:, None] == own_b
        same = own_a == own_b
        if t < table:
            met |= same | in_a | in_b
    lowest = np.where(in_a & in_b, np.minimum(own_a, own_b), np.where(in_b, own_a, own_b))
    here = np.where(same, own_a == bucket, (in_a | in_b) & (lowest == bucket))
    return here & ~met


def _roots(linked: np.ndarray) -> np.ndarray:
    """The smallest index each index reaches by links."""
    label = np.arange(len(linked))
    while True:
        new = np.minimum(label, np.where(linked, label[None], len(label)).min(axis=1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def bucket_links(coded: DataFrame, least: float) -> DataFrame:
    """``rep``, ``links`` (vectors it links with, of other classes, found first here) and ``root``
    (the smallest class it reaches here), for each place in which two blocks of a bucket meet."""
    entries = coded.select("rep", "d", F.posexplode("keys").alias("at", "key"))
    entries = entries.select("rep", "d", F.floor(F.col("at") / (1 + PROBES)).cast("int").alias("table"), (F.col("at") % (1 + PROBES) == 0).alias("own"), "key")
    entries = entries.groupBy("table", "d", "key", "rep").agg(F.max("own").alias("own"))
    entries = write_scratch(entries, "bucket_entries")
    sizes = entries.groupBy("table", "d", "key").agg(F.count("*").alias("members"), F.max("own").alias("any")).where("members > 1 AND any")
    met = entries.join(sizes.drop("any"), ["table", "d", "key"])
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("rep", "table"), blocks).cast("int")
    met = met.withColumn("blocks", blocks).withColumn("mine", mine)
    dealt = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "table", "d", "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), (F.col("mine") > F.col("other")).alias("second"), "rep"
    )
    full = dealt.join(coded.drop("d"), "rep")
    units = full.groupBy("table", "d", "key", "i", "j").agg(F.collect_list(F.struct("rep", "copies", "second", "vector", "keys")).alias("m"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], []]
            table, key, i, j = (batch.column(k).to_numpy() for k in ("table", "key", "i", "j"))
            column = batch.column("m")
            for u in range(batch.num_rows):
                m = column.slice(u, 1).flatten()
                if len(m) < 2:
                    continue
                rep, copies, second = (m.field(k).to_numpy(zero_copy_only=False) for k in ("rep", "copies", "second"))
                order = np.argsort(rep, kind="stable")
                rep, copies, second = rep[order], copies[order], second[order]
                x = m.field("vector").flatten().to_numpy().astype(np.float64).reshape(len(m), -1)[order]
                keys = m.field("keys").flatten().to_numpy().reshape(len(m), -1, 1 + PROBES)[order]
                norm = np.sqrt((x * x).sum(axis=1))
                linked = (x @ x.T) / (norm[:, None] * norm[None]) >= least
                np.fill_diagonal(linked, False)
                if i[u] != j[u]:
                    linked &= second[:, None] != second[None]
                if not linked.any():
                    continue
                some = np.flatnonzero(linked.any(axis=1))
                linked = linked[np.ix_(some, some)]
                first = _first_meeting(keys[some], keys[some], int(table[u]), key[u])
                counted = linked & first
                out[0].append(rep[some])
                out[1].append((counted * copies[some][None]).sum(axis=1))
                out[2].append(rep[some][_roots(linked)])
            arrays = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out]
            yield pa.RecordBatch.from_arrays(arrays, names=["rep", "links", "root"])

    return units.mapInArrow(link, "rep long, links long, root long")


def near_vectors(vectors: DataFrame, least: float = 0.95, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Equal vectors are one class and count as linked with each other. Classes meet in the buckets
    of all tables and are compared in double precision; a link is counted where its two classes
    meet first. Links leave a bucket as one row per class, never as pairs. Vectors that are null,
    empty, zero, or hold nulls or non-finite numbers link with nothing; those of different
    dimensions do not meet. Rows of one vec_id count as vectors of that name.
    """
    # Single precision travels as it is; all numbers are made doubles where they are used.
    kind = dict(vectors.dtypes)[vector]
    whole = F.col(vector) if kind == "array<float>" else F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec"), whole.alias("vector"))
    signed = write_scratch(_signatures(rows), "signatures")
    groups = signed.where("s1 IS NOT NULL").groupBy("s1", "s2").agg(F.min("vec").alias("rep"), F.count("*").alias("copies"))
    groups = write_scratch(groups, "vector_classes")
    n = groups.count()
    firsts = rows.join(groups.select(F.col("rep").alias("vec"), "rep", "copies"), "vec").dropDuplicates(["rep"])
    coded = write_scratch(_coded(firsts.select("rep", "copies", "vector"), *tuned(n)), "coded")
    found = write_scratch(bucket_links(coded, least), "vector_links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    named = groups.join(links, "rep", "left").join(reached, "rep", "left")
    named = named.select(
        "s1", "s2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component")
    )
    done = signed.join(side(write_scratch(named, "vector_components")), ["s1", "s2"], "left")
    component = F.coalesce("component", "vec")
    return done.select(F.col("vec").alias("vec_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("vec").eqNullSafe(component).alias("kept"))
