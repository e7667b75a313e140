"""Near-duplicate documents by a chosen-path join of their shingle sets."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import by_size, components, side
from sensorloom.llm.cross_polytope import _roots
from sensorloom.llm.words import mix, shingle_hashes, utf8, word_hashes
from sensorloom.session import write_scratch

#: Independent trees, levels of each, and documents of a node that are compared with each other.
#: Two sets of similarity s meet at a level with probability s: at 0.8, sixteen trees miss a pair
#: in nodes of the second level once in 10**7, of the third in 100 000, of the fifth in 600.
TREES, DEPTH, SMALL = 16, 5, 24
#: Members of a large node, drawn by hash, that vote on its usual sketch, byte by byte; the member
#: nearest to it, which a group's common origin is, is sought among all and compared with all.
VOTERS = 64
#: Sets, and hashes in them, of a block of a node that is large at the last level (4 MB).
BLOCK, BLOCK_TOKENS = 256, 1 << 19
#: Columns of the tables of ones by which two blocks are intersected.
COLUMNS = 4096
#: A pair is confirmed on its full sets if its sketches, one byte for each of the TREES * DEPTH
#: minwise tokens, agree this much less than asked for: four standard deviations at 0.8.
SLACK = 0.18

_STEPS = mix(np.arange(TREES * DEPTH, dtype=np.uint64), 77) | np.uint64(1)


def _sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, and where each set begins (rows + 1)."""
    words, before = word_hashes(*utf8(column))
    shingles, first = shingle_hashes(words, before, size)
    found = [np.unique(shingles[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    return (np.concatenate(found) if found else shingles), np.concatenate([[0], np.cumsum([len(x) for x in found], dtype=np.int64)])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def sketches(docs: DataFrame, size: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc``, ``n`` (set size), ``s1``, ``s2`` (128-bit hash of the set), the keys of the nodes on
    each tree's path and the sketch; the last four are null for an empty set."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches):
            tokens, first = _sets(batch.column(1), size)
            n = np.diff(first)
            some = n > 0
            begins = first[:-1][some]
            rows = int(some.sum())
            keys = np.zeros((rows, TREES * DEPTH), np.uint64)
            marks = np.zeros((rows, TREES * DEPTH), np.uint8)
            s1 = s2 = np.zeros(0, np.uint64)
            if rows:
                s1, s2 = (np.add.reduceat(mix(tokens, k), begins) for k in (7, 11))
                for k, step in enumerate(_STEPS):
                    token = mix(np.minimum.reduceat(tokens * step, begins), k)
                    above = keys[:, k - 1] if k % DEPTH else np.full(rows, k, np.uint64)
                    keys[:, k] = mix(above + token)
                    marks[:, k] = token.astype(np.uint8)
            at = np.full(len(n), -1)
            at[some] = np.arange(rows)
            pick = pa.array(at, mask=~some)
            whole = pa.FixedSizeListArray.from_arrays(_signed(keys.ravel()), TREES * DEPTH).cast(pa.list_(pa.int64()))
            marked = pa.array([x.tobytes() for x in marks], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), *[x.take(pick) for x in (_signed(s1), _signed(s2), whole, marked)]],
                names=["doc", "n", "s1", "s2", "keys", "sketch"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    return rows.mapInArrow(sketch, "doc long, n long, s1 long, s2 long, keys array<long>, sketch binary")


def tree_nodes(classes: DataFrame) -> DataFrame:
    """``node``, ``rep``, ``n``, ``sketch``, ``small``, ``last``, ``members``: where each class ends up in each tree.

    At each level a class goes to the node of its least token under that tree's and level's hash.
    A node of one class is dropped, one of up to SMALL is a leaf, a larger one goes a level down.
    Only counts meet by node; the join that brings them back is split where a node is large.
    Large nodes come out with ``small`` false from the second level on, those of the last with
    ``last`` true.
    """
    paths = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.slice("keys", t * DEPTH + 1, DEPTH))
    rows = classes.select("rep", "n", "sketch", F.explode(paths).alias("path"))
    found = []
    for level in range(DEPTH):
        rows = rows.withColumn("node", F.get("path", F.lit(level)))
        sizes = rows.groupBy("node").agg(F.count("*").alias("members")).where("members > 1")
        met = rows.join(sizes, "node")
        last = level == DEPTH - 1
        met = met.select("node", "rep", "n", "sketch", "members", *[] if last else ["path"])
        met = write_scratch(met, "tree_level")
        found.append(met.where(F.col("members") <= SMALL).select("node", "rep", "n", "sketch", F.lit(True).alias("small"), F.lit(False).alias("last"), "members"))
        rows = met.where(F.col("members") > SMALL)
        if level:
            found.append(rows.select("node", "rep", "n", "sketch", F.lit(False).alias("small"), F.lit(last).alias("last"), "members"))
        if not last:
            rows = rows.drop("members")
    return reduce(DataFrame.union, found)


def _alike(sizes: np.ndarray, marks: np.ndarray, other_sizes: np.ndarray, other_marks: np.ndarray, percent: int, slack: float = SLACK) -> tuple[np.ndarray, np.ndarray]:
    """Agreement of sketches, row against row, and whether sizes and agreement allow a link."""
    agree = (marks == other_marks).mean(axis=-1)
    low, high = np.minimum(sizes, other_sizes), np.maximum(sizes, other_sizes)
    return agree, (100 * low >= percent * high) & (agree >= percent / 100 - slack)


def _marks(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def nearest_pairs(nodes: DataFrame, percent: int, slack: float = SLACK) -> DataFrame:
    """Pairs ``a < b`` of classes to try first: in each leaf, every class with the one most like it;
    in each large node, every class with the one nearest to the node's usual sketch."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for reps, sizes, marks, _ in _leaves(batches):
            agree, can = _alike(sizes[:, None], marks[:, None], sizes[None], marks[None], percent, slack)
            agree = np.where(can & ~np.eye(len(reps), dtype=bool), agree, -1)
            best = agree.argmax(axis=1)
            yield _pairs(reps, reps[best], agree[np.arange(len(reps)), best] >= 0)

    def to_pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, n, mine, b, m, other = (batch.column(k) for k in ("rep", "n", "sketch", "pivot", "pivot_n", "pivot_sketch"))
                can = _alike(n.to_numpy(), _marks(mine), m.to_numpy(), _marks(other), percent, slack)[1]
                yield _pairs(a.to_numpy(), b.to_numpy(), can)

    def usual(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            modes = []
            for drawn in batch.column("drawn"):
                marks = _marks(drawn.values)
                modes.append(np.array([np.bincount(marks[:, k]).argmax() for k in range(marks.shape[1])], np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(modes, pa.binary())], names=["node", "usual"])

    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                agree = (_marks(batch.column("sketch")) == _marks(batch.column("usual"))).mean(axis=1)
                yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in ("node", "rep", "n", "sketch")], pa.array(agree)], names=["node", "rep", "n", "sketch", "agree"])

    leaves = gathered(nodes).mapInArrow(nearest, "a long, b long")
    large = nodes.where("NOT small")
    drawn = large.where(F.pmod(F.xxhash64("node", "rep"), F.ceil(F.col("members") / VOTERS)) == 0)
    modes = drawn.groupBy("node").agg(F.collect_list("sketch").alias("drawn")).mapInArrow(usual, "node long, usual binary")
    met = large.join(side(write_scratch(modes, "usual_sketches"), 100_000), "node")
    near = met.select("node", "rep", "n", "sketch", "usual").mapInArrow(agreeing, "node long, rep long, n long, sketch binary, agree double")
    one = F.struct(F.col("rep").alias("pivot"), F.col("n").alias("pivot_n"), F.col("sketch").alias("pivot_sketch"))
    pivots = near.groupBy("node").agg(F.max_by(one, F.struct("agree", -F.col("rep"))).alias("x")).select("node", "x.*")
    met = large.join(side(write_scratch(pivots, "pivots"), 100_000), "node")
    return leaves.union(met.where("rep <> pivot").mapInArrow(to_pivots, "a long, b long")).distinct()


def gathered(nodes: DataFrame, *more: str) -> DataFrame:
    """One row per leaf with its at most SMALL classes."""
    leaves = nodes.where("small").groupBy("node").agg(F.collect_list(F.struct("rep", "n", "sketch", *more)).alias("members"))
    return leaves.where(F.size("members") > 1).select("members")


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.StructArray]]:
    for batch in batches:
        column = batch.column("members")
        inner, ends = column.flatten(), np.cumsum(column.value_lengths().to_numpy())
        if not len(inner):
            continue
        reps, sizes, marks = inner.field("rep").to_numpy(), inner.field("n").to_numpy(), _marks(inner.field("sketch"))
        begin = 0
        for end in ends.tolist():
            yield reps[begin:end], sizes[begin:end], marks[begin:end], inner.slice(begin, end - begin)
            begin = end


def _pairs(a: np.ndarray, b: np.ndarray, keep: np.ndarray) -> pa.RecordBatch:
    a, b = a[keep], b[keep]
    keep = a != b
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[keep]), pa.array(np.maximum(a, b)[keep])], names=["a", "b"])


def open_pairs(nodes: DataFrame, known: DataFrame, percent: int, slack: float = SLACK) -> DataFrame:
    """All other pairs of a leaf whose sketches allow a link and that are not yet in one component."""

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for reps, sizes, marks, inner in _leaves(batches):
            group = inner.field("component").to_numpy()
            a, b = np.triu_indices(len(reps), 1)
            apart = group[a] != group[b]
            a, b = a[apart], b[apart]
            if len(a):
                yield _pairs(reps[a], reps[b], _alike(sizes[a], marks[a], sizes[b], marks[b], percent, slack)[1])

    named = nodes.join(known.withColumnRenamed("node", "rep").hint("merge"), "rep", "left")
    named = named.withColumn("component", F.coalesce("component", "rep"))
    return gathered(named, "component").mapInArrow(rest, "a long, b long").distinct()


def full_sets(docs: DataFrame, reps: DataFrame, size: int, text: str, doc_id: str) -> DataFrame:
    """``doc`` and its sorted shingle hashes as bytes, for the documents in ``reps`` (``doc``)."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches):
            tokens, first = _sets(batch.column(1), size)
            sets = [tokens[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["doc", "tokens"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    return rows.join(side(reps), "doc", "left_semi").mapInArrow(whole, "doc long, tokens binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have ``100 * intersection >= percent * union``."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = pairs.join(sets.select(F.col("doc").alias("a"), F.col("tokens").alias("x")).hint("merge"), "a")
    two = one.join(sets.select(F.col("doc").alias("b"), F.col("tokens").alias("y")).hint("merge"), "b")
    return two.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _common(some: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """How many hashes each of ``some`` sets has in common with each of the others, or of ``some``."""

    def flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])

    tokens, rows = flat(some)
    if others is None:
        found, n = np.unique(tokens, return_counts=True)
        shared = found[n > 1]
    else:
        other_tokens, other_rows = flat(others)
        shared = np.intersect1d(tokens, other_tokens)

    def placed(tokens: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(shared, tokens)
        hit = at < len(shared)
        hit[hit] = shared[at[hit]] == tokens[hit]
        at, rows = at[hit], rows[hit]
        order = np.argsort(at, kind="stable")
        return at[order], rows[order]

    sides = [(placed(tokens, rows), len(some))]
    if others is not None:
        sides.append((placed(other_tokens, other_rows), len(others)))
    both = np.zeros((len(some), sides[-1][1]), np.int64)
    for begin in range(0, len(shared), COLUMNS):
        ones = []
        for (at, rows), n in sides:
            a, b = np.searchsorted(at, [begin, begin + COLUMNS])
            x = np.zeros((n, min(COLUMNS, len(shared) - begin)), np.float32)
            x[rows[a:b], at[a:b] - begin] = 1
            ones.append(x)
        both += (ones[0] @ ones[-1].T).astype(np.int64)
    return both


def block_links(nodes: DataFrame, known: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame | None:
    """Links between the components that meet in a node that is large at the last level, or None.

    In such a node the members outside its largest component are compared with all its members,
    on full sets: both are dealt into blocks by a hash, and every two blocks meet but for two of
    the largest component. A class leaves a meeting with one link, to the smallest it reaches there.
    """
    named = nodes.where("last").join(known.withColumnRenamed("node", "rep").hint("merge"), "rep", "left")
    named = named.select("node", "rep", "n", F.coalesce("component", "rep").alias("component"))
    parts = named.groupBy("node", "component").agg(F.count("*").alias("rows"), F.sum("n").alias("tokens"))
    most = parts.groupBy("node").agg(
        F.max(F.struct("rows", "component", "tokens")).alias("main"), F.sum("rows").alias("rows"), F.sum("tokens").alias("tokens")
    )
    blocks = lambda rows, tokens: F.ceil(F.greatest(rows / BLOCK, tokens / BLOCK_TOKENS)).cast("int")
    several = most.where(F.col("rows") > F.col("main.rows")).select(
        "node", F.col("main.component").alias("main"), blocks(F.col("main.rows"), F.col("main.tokens")).alias("mains"),
        blocks(F.col("rows") - F.col("main.rows"), F.col("tokens") - F.col("main.tokens")).alias("opens"),
    )
    several = write_scratch(several, "open_nodes")
    if not several.limit(1).count():
        return None
    met = named.join(side(several, 100_000), "node").withColumn("open", F.col("component") != F.col("main"))
    met = write_scratch(met.withColumn("mine", F.pmod(F.xxhash64("node", "rep"), F.when(F.col("open"), F.col("opens")).otherwise(F.col("mains"))).cast("int")), "open_members")
    unit = lambda i, j, with_main, second: F.struct(i.alias("i"), j.alias("j"), F.lit(with_main).alias("with_main"), second.alias("second"))
    mine, no, yes = F.col("mine"), F.lit(False), F.lit(True)
    to = lambda n, f: F.transform(F.sequence(F.lit(0), F.col(n) - 1), f)
    units = F.when(
        F.col("open"),
        F.concat(to("opens", lambda k: unit(F.least(mine, k), F.greatest(mine, k), False, mine > k)), to("mains", lambda k: unit(mine, k, True, no))),
    ).otherwise(to("opens", lambda k: unit(k, mine, True, yes)))
    dealt = met.select("node", "rep", "component", F.explode(units).alias("u")).select("node", "u.*", "rep", "component")
    # Spark takes the exploded units for as many as there are members and would broadcast them.
    full = dealt.join(sets(met.select(F.col("rep").alias("doc")).distinct()).withColumnRenamed("doc", "rep").hint("merge"), "rep")

    def link(key: tuple, table: pa.Table) -> pa.Table:
        rep, group, second = (table.column(k).to_numpy() for k in ("rep", "component", "second"))
        tokens = [np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()]
        order = np.argsort(rep, kind="stable")
        rep, group, second, tokens = rep[order], group[order], second[order].astype(bool), [tokens[k] for k in order]
        n = np.array([len(x) for x in tokens])
        linked = np.zeros((len(rep), len(rep)), bool)
        one = key[1].as_py() == key[2].as_py() and not key[3].as_py()
        a, b = (np.arange(len(rep)),) * 2 if one else (np.flatnonzero(~second), np.flatnonzero(second))
        if len(a) and len(b):
            both = _common([tokens[k] for k in a], None if one else [tokens[k] for k in b])
            can = (100 * both >= percent * (n[a][:, None] + n[b][None] - both)) & (group[a][:, None] != group[b][None])
            linked[np.ix_(a, b)] = can
            linked |= linked.T
        root = rep[_roots(linked)]
        return pa.table({"a": root[root != rep], "b": rep[root != rep]})

    full = full.select("node", "i", "j", "with_main", "second", "rep", "component", "tokens")
    return full.groupBy("node", "i", "j", "with_main").applyInArrow(link, "a long, b long").distinct()


def linked_components(nodes: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int, slack: float = SLACK) -> DataFrame:
    """``(node, component)`` for all classes that are linked with others that they meet in ``nodes``.

    ``sets`` makes ``doc`` and ``tokens`` for given classes (``doc``). Each step leaves out what the
    steps before it have connected: the nearest, then all pairs of a leaf, then large nodes by blocks.
    Pairs and classes grow with the documents: their joins shuffle at every size.
    """
    first = write_scratch(nearest_pairs(nodes, percent, slack), "first_pairs")
    active = first.select(F.col("a").alias("doc")).union(first.select(F.col("b").alias("doc"))).distinct()
    active = write_scratch(active, "active")
    made = write_scratch(sets(active), "sets")
    links = write_scratch(confirmed(first, made, percent), "links")
    known = write_scratch(components(links), "components")
    more = write_scratch(open_pairs(nodes, known, percent, slack).join(first.hint("merge"), ["a", "b"], "left_anti"), "open_pairs")
    more = write_scratch(confirmed(more, made, percent), "links")
    if more.limit(1).count():
        known = write_scratch(components(links.union(more)), "components")

    def made_for(wanted: DataFrame) -> DataFrame:
        rest = write_scratch(wanted.join(active.hint("merge"), "doc", "left_anti"), "wanted_sets")
        return made.union(write_scratch(sets(rest), "sets"))

    far = block_links(nodes, known, made_for, percent)
    if far is not None:
        far = write_scratch(far, "block_links")
        if far.limit(1).count():
            known = write_scratch(components(known.select(F.col("component").alias("a"), F.col("node").alias("b")).union(far)), "components")
    return known


def near_classes(docs: DataFrame, size: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents of equal sets are one class from the start and never compared. Classes meet in the
    leaves of TREES trees. First each is tried with its nearest in every leaf, and in large nodes
    with the most usual member, which joins most of a group of near copies by few links; then all
    pairs of a leaf, and of a node that stays large, that are still in different components. Links are confirmed on the full sets, which are made again for classes in some
    pair only. A text without words (null, empty) is in no class; a shorter one than a shingle has
    its whole sequence of words as its one shingle. Rows of one doc_id count as one document.
    """
    all_ = write_scratch(sketches(docs, size, text, doc_id), "sketches")
    classes = all_.where("n > 0").groupBy("s1", "s2").agg(
        F.min_by(F.struct(F.col("doc").alias("rep"), "n", "keys", "sketch"), "doc").alias("x"), F.count("*").alias("copies")
    )
    classes = write_scratch(classes.select("s1", "s2", "copies", "x.*"), "classes")
    nodes = write_scratch(tree_nodes(classes), "nodes")
    found = linked_components(nodes, lambda reps: full_sets(docs, reps, size, text, doc_id), percent)
    # Where a document belongs: its class, and the component of that.
    several = classes.where("copies > 1").select("s1", "s2", "rep")
    placed = all_.select("doc", "n", "s1", "s2").join(side(write_scratch(several, "copies")), ["s1", "s2"], "left")
    placed = placed.withColumn("rep", F.coalesce("rep", "doc"))
    placed = placed.join(side(found.withColumnRenamed("node", "rep")), "rep", "left")
    component = F.coalesce("component", "rep")
    return placed.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc").eqNullSafe(component).alias("kept"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that :func:`near_classes` does not keep, with the same columns."""
    names = docs.columns
    inner = docs.toDF(*[f"k{i}" for i in range(len(names))])
    d = f"k{names.index(doc_id)}"
    gone = near_classes(inner, size, percent, f"k{names.index(text)}", d).where("NOT kept").select(F.col("doc_id").alias("__doc"))
    left = inner.join(side(write_scratch(gone.distinct(), "gone")), F.col(d) == F.col("__doc"), "left_anti")
    return left.toDF(*names)
