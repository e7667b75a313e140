"""Adaptive windowing over long series: all tasks walk a series at once.

In the exponential histogram of the test a bucket of level i always holds ``2**i`` items, so the whole shape of a
window is the number of buckets on each level, and while nothing is cut that number follows from how many items were added
(:func:`grown`). Sums inside buckets are differences of running sums. So the looks for a cut up to the next
one are independent of each other: they are taken some thousand at a time, and after a cut the walk goes on from the smaller window.

Over chunks of a series the walk is speculative. A chunk needs the window before it, which is known only when the
chunks before it are done. It is guessed: a chunk without cuts hands on its window, grown; a chunk with cuts hands on what its last
walk left. All chunks whose guess has changed are walked at once, and the guesses are made again from what they found. When
no guess changes any more, each chunk was walked from the window that the chunk before it left, which is the walk in one
task. Without drift that takes one round, and with drift a few, as windows cut at the same place are alike from there on.
Should chunks not settle in a bounded number of rounds, the rest of their series is walked in order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...session import write_scratch
from ..ordered import join_same

CHUNK_ITEMS = 32_768
MOST_ROUNDS = 8
#: Chunks whose windows are laid out by the driver at a time: some hundred places each.
PART = 16_384
_FIRST, _MOST = 64, 4096

Counts = tuple[int, ...]


@dataclass(frozen=True)
class Rule:
    """Settings of the test; an item is a reading, or the sum of ``block_rows`` readings."""

    delta: float = 0.002
    clock: int = 32
    max_buckets: int = 5
    min_window: int = 5
    grace: int = 10
    block_rows: int = 1

    @property
    def every(self) -> int:
        """Items from one look for a cut to the next."""
        return -(-self.clock // self.block_rows)


def grown(counts: Counts, items: int, most: int) -> Counts:
    """Buckets by level after ``items`` more: a level over ``most`` sends its two oldest up as one."""
    out, more, level = [], items, 0
    while more or level < len(counts):
        have = more + (counts[level] if level < len(counts) else 0)
        more = max(0, -(-(have - most) // 2))
        out.append(have - 2 * more)
        level += 1
    while out and not out[-1]:
        out.pop()
    return tuple(out)


def _grown_many(counts: Counts, items: np.ndarray, most: int) -> np.ndarray:
    """:func:`grown` for many numbers of items: levels by numbers."""
    out, more, level = [], items, 0
    while level < len(counts) or more.any():
        have = more + (counts[level] if level < len(counts) else 0)
        more = np.maximum(0, -(-(have - most) // 2))
        out.append(have - 2 * more)
        level += 1
    return np.array(out or [np.zeros(len(items), np.int64)])


def sizes_of(counts: Counts) -> np.ndarray:
    """Items in each bucket, oldest first."""
    return np.repeat(1 << np.arange(len(counts))[::-1], counts[::-1]).astype(np.int64)


class Window:
    """The buckets before some item: their counts by level and running sums of ``(rows, total, squares)``.

    ``sums`` has a row for the beginning of the oldest bucket, then one for the end of each.
    """

    def __init__(self, counts: Counts, sums: np.ndarray):
        self.counts, self.sums = tuple(int(c) for c in counts), sums

    @classmethod
    def empty(cls) -> Window:
        return cls((), np.zeros((1, 3)))

    def ends(self) -> np.ndarray:
        """Items from each boundary to the end of the window, as numbers up to 0."""
        sizes = sizes_of(self.counts)
        return np.r_[0, np.cumsum(sizes)] - sizes.sum()


def _cuts(rule: Rule, sums: np.ndarray, index: Callable[[np.ndarray], np.ndarray], counts: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the window of ``counts`` (levels by looks) that ends at ``at`` has a cut; ``sums[index(p)]`` are the sums up to ``p``."""
    level = np.arange(len(counts))[:, None, None]
    below = np.cumsum(counts << np.arange(len(counts))[:, None], axis=0)
    whole = below[-1]
    nth = np.arange(1, rule.max_buckets + 1)[None, :, None]
    offset = (below - (counts << np.arange(len(counts))[:, None]))[:, None, :] + (nth << level)
    valid = (nth <= counts[:, None, :]) & (offset < whole)
    offset = np.where(valid, offset, 0)
    end, begin = sums[index(at)], sums[index(at - whole)]
    n, total, squares = (end - begin).T
    new = end[None, None] - sums[index(at - offset)]
    n1, t1 = new[..., 0], new[..., 1]
    n0, t0 = n - n1, total - t1
    valid &= (n1 >= rule.min_window) & (n0 >= rule.min_window) & (n > rule.grace)
    with np.errstate(divide="ignore", invalid="ignore"):
        variance = np.maximum(squares - total * total / n, 0) / n
        spread = np.log(2 * np.log(np.maximum(n, 2)) / rule.delta)
        harmonic = 1 / (n0 - rule.min_window + 1) + 1 / (n1 - rule.min_window + 1)
        bound = np.sqrt(2 * harmonic * variance * spread) + 2 / 3 * harmonic * spread
        return (valid & (np.abs(t0 / n0 - t1 / n1) > bound)).any(axis=(0, 1))


def walk(items: np.ndarray, before: Window, wait: int, rule: Rule) -> tuple[list[int], Window]:
    """The items at which the test cuts its window, and the window afterwards.

    ``items`` has a row ``(rows, total, squares)`` per item; ``wait`` items have come since the last look.
    """
    past = before.ends()
    sums = np.r_[before.sums, before.sums[-1] + np.cumsum(items, axis=0)]
    last = len(past) - 1

    def index(p: np.ndarray) -> np.ndarray:
        out = p + last
        old = p < 0
        if old.any():
            out[old] = np.searchsorted(past, p[old])
        return out

    looks = np.arange(rule.every - wait, len(items) + 1, rule.every)
    if len(looks) and looks[-1] == len(items) and (rule.every - 1) * rule.block_rows + items[-1, 0] < rule.clock:
        looks = looks[:-1]  # a last block of fewer rows
    found, counts, since, at, size = [], before.counts, 0, 0, _FIRST
    while at < len(looks):
        part = looks[at : at + size]
        hit = _cuts(rule, sums, index, _grown_many(counts, part - since, rule.max_buckets), part)
        if not hit.any():
            at, size = at + len(part), min(2 * size, _MOST)
            continue
        first = int(np.argmax(hit))
        now = part[first]
        counts = grown(counts, int(now - since), rule.max_buckets)
        while True:  # The oldest bucket goes until nothing more is to be cut.
            counts = (*counts[:-1], counts[-1] - 1)
            while counts and not counts[-1]:
                counts = counts[:-1]
            if not _cuts(rule, sums, index, np.array(counts)[:, None], np.array([now]))[0]:
                break
        found.append(int(now) - 1)
        since, at, size = int(now), at + first + 1, _FIRST
    counts = grown(counts, len(items) - since, rule.max_buckets)
    after = Window(counts, np.zeros((1, 3)))
    after.sums = sums[index(after.ends() + len(items))]
    return found, after


def _centred(n: np.ndarray, total: np.ndarray, m2: np.ndarray, shift: float) -> np.ndarray:
    """``(rows, total, squares)`` around ``shift``, which keeps differences of running sums exact enough."""
    own = total - n * shift
    return np.stack([n, own, m2 + own * own / n], axis=1)


def _plain(window: Window, shift: float) -> np.ndarray:
    """Rows, total and squared deviations of each bucket."""
    n, own, squares = np.diff(window.sums, axis=0).T
    return np.stack([n, own + n * shift, np.maximum(squares - own * own / n, 0)], axis=1)


_STATE = "shift double, wait int, counts array<int>, sums array<double>"
_WALKED = "id long, cuts array<int>, counts array<int>, buckets array<double>, turn int"


def _lists(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    column = batch.column(name)
    values, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    return np.split(values, ends[:-1])


def _walk_rows(rows: DataFrame, rule: Rule, turn: int, in_order: bool = False) -> DataFrame:
    """Walk the chunks of ``rows``, each from its state; ``in_order`` carries the window from chunk to chunk of a series."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, carried, shift, wait = None, None, 0.0, 0
        for batch in batches:
            n, total, m2, counts, sums = (_lists(batch, c) for c in ("n", "total", "m2", "counts", "sums"))
            out = []
            for r, (id, own, s, w) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("id", "key", "shift", "wait")))):
                if not in_order or own != key:
                    key, shift, wait = own, s, w
                    carried = Window(counts[r], sums[r].reshape(-1, 3))
                cuts, carried = walk(_centred(n[r], total[r], m2[r], shift), carried, wait, rule)
                wait = (wait + len(n[r])) % rule.every
                out.append((id, cuts, list(carried.counts), _plain(carried, shift).ravel(), turn))
            if not out:
                continue
            kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["id", "cuts", "counts", "buckets", "turn"])

    return write_scratch(rows.mapInArrow(task, _WALKED), "walked")


def _chunks(items: DataFrame, series: Sequence[str], size: int) -> DataFrame:
    """One row per chunk of ``size`` items: ``id, key, chunk, n, total, m2`` and the series."""
    key = F.to_json(F.struct(*[F.coalesce(F.concat(F.lit("k"), F.col(c).cast("string")), F.lit("")).alias(f"k{i}") for i, c in enumerate(series)]))
    rows = items.groupBy(*series, F.floor(F.col("item") / size).alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct("item", "n", "total", "m2"))).alias("items")
    )
    part = lambda c: F.transform("items", lambda x: x.getField(c)).alias(c)
    rows = rows.select(*series, key.alias("key"), "chunk", part("n"), part("total"), part("m2"))
    return write_scratch(rows.withColumn("id", F.monotonically_increasing_id()), "chunk_items")


class _Series:
    """What the driver knows of a series of several chunks: a few numbers for each."""

    def __init__(self, ids: list[int], lengths: list[int], stats: np.ndarray, before: np.ndarray | None, counts: Counts, wait: int):
        rows, total = stats[:, 0].sum(), stats[:, 1].sum()
        self.shift = float(total / rows)
        self.ids, self.lengths = ids, lengths
        self.starts = np.r_[0, np.cumsum(lengths)]
        self.sums = np.r_[np.zeros((1, 3)), np.cumsum(_centred(*stats.T, self.shift), axis=0)]
        self.first = Window.empty()
        if before is not None:
            own = _centred(*before.T, self.shift)
            self.first = Window(counts, np.r_[np.zeros((1, 3)), np.cumsum(own, axis=0)])
            self.first.sums -= self.first.sums[-1]
        self.wait = wait
        self.used: list[Counts | None] = [None] * len(ids)
        self.left: list[Counts | None] = [None] * len(ids)
        self.cut = [False] * len(ids)

    def guesses(self, most: int) -> list[tuple[int, Counts]]:
        """Chunks whose window before them is not the one they were walked from, with the window that is expected."""
        out, counts = [], self.first.counts
        for k, length in enumerate(self.lengths):
            if self.used[k] == counts:
                counts = self.left[k]
                continue
            out.append((k, counts))
            counts = self.left[k] if self.cut[k] else grown(counts, length, most)
        return out

    def boundaries(self, k: int, counts: Counts) -> np.ndarray:
        """The places of the boundaries of a window before chunk ``k``, counted from the first item."""
        return Window(counts, np.zeros((1, 3))).ends() + self.starts[k]


def _sums_at(chunks: DataFrame, asked: DataFrame) -> DataFrame:
    """For every chunk of ``asked`` and each of its ``targets``, the running sums after ``sizes`` of its ``places``, from ``base`` on."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, total, m2, base, targets, sizes, places = (_lists(batch, c) for c in ("n", "total", "m2", "base", "targets", "sizes", "places"))
            out = []
            for r, (nth, shift) in enumerate(zip(batch.column("nth").to_pylist(), batch.column("shift").to_pylist())):
                sums = base[r] + np.r_[np.zeros((1, 3)), np.cumsum(_centred(n[r], total[r], m2[r], shift), axis=0)]
                for target, own in zip(targets[r].tolist(), np.split(places[r], np.cumsum(sizes[r])[:-1])):
                    out.append((target, nth, sums[own].ravel()))
            if out:
                kinds = [pa.int64(), pa.int32(), pa.list_(pa.float64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["id", "nth", "sums"])

    rows = chunks.select("id", "n", "total", "m2").join(asked.hint("shuffle_hash"), "id")
    return rows.mapInArrow(task, "id long, nth int, sums array<double>")


def _state_rows(spark, chunks: DataFrame, todo: list[tuple[_Series, int, Counts]], rule: Rule) -> DataFrame:
    """The windows that the chunks ``todo`` start from, by chunk id.

    The driver says where their boundaries lie. The sums there are taken inside the chunks before and sent to the task that walks,
    not to the driver: a hundred or so for every chunk that is walked.
    """
    rows, asked = [], {}
    for s, k, counts in todo:
        places = s.boundaries(k, counts)[:-1]  # The last one is the beginning of chunk k.
        old = dict(zip(s.first.ends().tolist(), s.first.sums.tolist()))
        before = [v for p in places[places < 0].tolist() for v in old[p]]
        wait = int((s.wait + s.starts[k]) % rule.every)
        rows.append((s.ids[k], s.shift, wait, list(counts), before, s.sums[k].tolist()))
        places = places[places >= 0]
        nth = np.searchsorted(s.starts, places, side="right") - 1
        for j in np.unique(nth).tolist():
            own = (places[nth == j] - s.starts[j]).tolist()
            _, _, _, targets, sizes, inside = asked.setdefault(s.ids[j], (j, s.shift, s.sums[j].tolist(), [], [], []))
            targets.append(s.ids[k])
            sizes.append(len(own))
            inside += own
    states = spark.createDataFrame(rows, "id long, shift double, wait int, counts array<int>, old array<double>, last array<double>")
    inside = F.array().cast("array<double>")
    if asked:
        kinds = "id long, nth int, shift double, base array<double>, targets array<long>, sizes array<int>, places array<int>"
        found = _sums_at(chunks, spark.createDataFrame([(i, *a) for i, a in asked.items()], kinds))
        parts = found.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("nth", "sums"))).alias("parts"))
        states = states.join(parts.hint("merge"), "id", "left")
        inside = F.coalesce(F.flatten(F.transform("parts", lambda x: x.getField("sums"))), inside)
    return states.select("id", "shift", "wait", "counts", F.concat("old", inside, "last").alias("sums"))


def walk_series(
    items: DataFrame,
    series: Sequence[str],
    rule: Rule,
    start: DataFrame | None = None,
    chunk_items: int = CHUNK_ITEMS,
    most_rounds: int = MOST_ROUNDS,
) -> tuple[DataFrame, DataFrame]:
    """The test over every series of ``items`` (series columns, ``item`` from 0 without gaps, ``n, total, m2``).

    ``start`` holds the windows to go on from: series columns, ``counts array<int>``, ``buckets array<double>`` (rows, total and
    squared deviations of each bucket, oldest first) and ``wait int``. Returns the items with a cut (series, ``item``) and
    the windows afterwards, in the form of ``start``.
    """
    series = list(series)
    chunks = _chunks(items, series, chunk_items)
    known = write_scratch(_with_start(_numbers(chunks, series), start, series), "chunk_starts")

    # First chunks start from what is known, without the driver.
    begun = known.where("chunk = 0").select("id", "counts0", "buckets0", "wait0")
    firsts = _with_first_state(_dealt(chunks.where("chunk = 0"), begun))
    done = [_walk_rows(firsts.select("id", "key", "n", "total", "m2", "shift", "wait", "counts", "sums"), rule, 0)]
    long = _long_series(known, done[0])
    every = {i: (s, k) for s in long for k, i in enumerate(s.ids)}
    turn = 0
    while todo := [(s, k, counts) for s in long for k, counts in s.guesses(rule.max_buckets)]:
        turn += 1
        in_order = turn > most_rounds
        if in_order:  # Not settled: the rest of each such series in one task.
            first = {}
            for s, k, counts in todo:
                first.setdefault(s.ids[0], (s, k, counts))
            todo = list(first.values())
        for at in range(0, len(todo), PART):
            part = todo[at : at + PART]
            walked = _walk_rows(_from_states(chunks, part, rule, in_order), rule, turn, in_order)
            done.append(walked)
            used = {s.ids[k]: counts for s, k, counts in part}
            if not in_order:
                for r in walked.select("id", "counts", F.size("cuts").alias("cuts")).collect():
                    s, k = every[r.id]
                    s.used[k], s.left[k], s.cut[k] = used[r.id], tuple(r.counts), r.cuts > 0
        if in_order:
            break

    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    # The last walk of a chunk is the one from the right window.
    last = found.groupBy("id").agg(F.max_by(F.struct("cuts", "counts", "buckets"), "turn").alias("w")).select("id", "w.*")
    last = write_scratch(known.select("id", *series, "chunk", "wait0", "items").join(last.hint("merge"), "id"), "walks")
    cuts = last.select(*series, "chunk", F.explode("cuts").alias("cut")).select(*series, (F.col("chunk") * chunk_items + F.col("cut")).alias("item"))
    seen = F.coalesce(F.max("wait0"), F.lit(0)) + F.sum("items")
    after = last.groupBy(*series).agg(F.max_by(F.struct("counts", "buckets"), "chunk").alias("w"), F.pmod(seen, F.lit(rule.every)).cast("int").alias("wait"))
    return cuts, after.select(*series, "w.counts", "w.buckets", "wait")


def _dealt(chunks: DataFrame, states: DataFrame, most: int | None = None) -> DataFrame:
    """Chunks with their states, dealt to four tasks a core: the walk takes long over few bytes, by which Spark would put them in one task."""
    tasks = 4 * chunks.sparkSession.sparkContext.defaultParallelism
    return chunks.join(states.hint("shuffle_hash"), "id").repartition(min(tasks, most or tasks), "id")


def _from_states(chunks: DataFrame, todo: list[tuple[_Series, int, Counts]], rule: Rule, in_order: bool) -> DataFrame:
    """The chunks ``todo`` with the windows they start from; ``in_order`` all later ones of their series behind them."""
    spark = chunks.sparkSession
    states = _state_rows(spark, chunks, todo, rule)
    if not in_order:
        return _dealt(chunks.select("id", "key", "n", "total", "m2"), states, len(todo))
    rest = spark.createDataFrame([(i,) for s, k, _ in todo for i in s.ids[k:]], "id long")
    rest = rest.join(states.hint("merge"), "id", "left")
    rows = chunks.select("id", "key", "chunk", "n", "total", "m2").join(rest.hint("shuffle_hash"), "id")
    return rows.repartition("key").sortWithinPartitions("key", "chunk").drop("chunk")


def _with_first_state(rows: DataFrame) -> DataFrame:
    """First chunks with the state they start from: the window of ``start``, or an empty one."""
    own = F.aggregate("total", F.lit(0.0), lambda a, x: a + x) / F.aggregate("n", F.lit(0.0), lambda a, x: a + x)
    return rows.withColumns(
        {"shift": own, "wait": F.coalesce("wait0", F.lit(0)), "counts": F.coalesce("counts0", F.array().cast("array<int>"))}
    ).withColumn("sums", _bucket_sums(F.coalesce("buckets0", F.array().cast("array<double>")), F.col("shift")))


def _bucket_sums(buckets: Column, shift: Column) -> Column:
    """Running sums around ``shift`` of buckets given as rows, total and squared deviations."""

    def add(sums: Column, k: Column) -> Column:
        n, total, m2 = (F.get(buckets, 3 * k + i) for i in range(3))
        own = total - n * shift
        step = [n, own, m2 + own * own / n]
        return F.concat(sums, F.array(*[F.element_at(sums, i - 3) + x for i, x in enumerate(step)]))

    places = F.filter(F.sequence(F.lit(0), F.floor(F.size(buckets) / 3)), lambda k: k < F.size(buckets) / 3)
    return F.aggregate(places, F.array(*[F.lit(0.0)] * 3), add)


def _numbers(chunks: DataFrame, series: Sequence[str]) -> DataFrame:
    """A few numbers for each chunk in place of its items."""
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    rows = chunks.withColumns({"rows": total("n"), "sum": total("total")})
    # Squared deviations around the chunk's own mean.
    spread = F.aggregate(
        F.arrays_zip("n", "total", "m2"), F.lit(0.0),
        lambda a, x: a + x.getField("m2") + x.getField("n") * F.pow(x.getField("total") / x.getField("n") - F.col("sum") / F.col("rows"), 2),
    )
    return rows.select(*series, "key", "chunk", "id", F.size("n").alias("items"), "rows", "sum", spread.alias("spread"))


def _with_start(numbers: DataFrame, start: DataFrame | None, series: Sequence[str]) -> DataFrame:
    """The window of ``start`` beside the first chunk of each series."""
    none = {"counts0": F.lit(None).cast("array<int>"), "buckets0": F.lit(None).cast("array<double>"), "wait0": F.lit(None).cast("int")}
    if start is None:
        return numbers.withColumns(none)
    known = start.select(*series, F.col("counts").alias("counts0"), F.col("buckets").alias("buckets0"), F.col("wait").alias("wait0"))
    firsts = join_same(numbers.where("chunk = 0"), known.hint("merge"), series)
    return firsts.unionByName(numbers.where("chunk > 0").withColumns(none))


def _long_series(known: DataFrame, walked: DataFrame) -> list[_Series]:
    """The series of several chunks; a row of a few numbers for each chunk comes to the driver."""
    keys = known.where("chunk > 0").select("key").distinct()
    first = walked.select("id", F.col("counts").alias("left"), F.size("cuts").alias("cuts"))
    rows = known.join(keys.hint("merge"), "key", "left_semi").join(first.hint("merge"), "id", "left")
    rows = rows.select("key", "chunk", "id", "items", "rows", "sum", "spread", "counts0", "buckets0", "wait0", "left", "cuts")
    found: dict[str, list] = {}
    for r in rows.collect():
        found.setdefault(r.key, []).append(r)
    out = []
    for rows in found.values():
        rows.sort(key=lambda r: r.chunk)
        r = rows[0]
        before = None if r.buckets0 is None else np.array(r.buckets0, dtype=float).reshape(-1, 3)
        s = _Series([x.id for x in rows], [x["items"] for x in rows], np.array([[x.rows, x.sum, x.spread] for x in rows]), before, tuple(r.counts0 or ()), r.wait0 or 0)
        s.used[0], s.left[0], s.cut[0] = s.first.counts, tuple(r.left), r.cuts > 0
        out.append(s)
    return out
