import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import SCHEMA, WORD
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sensorloom.llm.encode import encoder
from sensorloom.llm.mixing import fill, mix, mixed
from sensorloom.llm.packing import best_fit, pack, Plan, plan_packing, sequences
from sensorloom.llm.simple8 import BLOCK, unpack
from sensorloom.llm.simple8 import pack as pack8
from sensorloom.llm.token_files import read_tokens, write_tokens
from sensorloom.session import scratch_path

NAMES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


@pytest.fixture(scope="module")
def whole():
    found = {n: Tokenizer.from_file(public_tokenizers.path(n)) for n in NAMES}
    return lambda name, text: found[name].encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*" \n\t\r\x1f  '’.,#aBcéÉßıİſΣς한漢́1٣<|>_", "<|endoftext|>", "'ll", "the ", "\n\n", "Word.\nNext", " x"]), max_size=30).map("".join))
def test_encoder_equals_whole_text(whole, text):
    for name in NAMES:
        assert np.frombuffer(encoder(public_tokenizers.path(name))(text), "<u4").tolist() == whole(name, text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=700))
def test_simple8(ids):
    words, blocks = pack8(np.array(ids, np.uint64))
    assert unpack(words, len(ids)).tolist() == ids
    assert len(blocks) == -(-len(ids) // BLOCK)
    for k, first in enumerate(blocks.tolist()):  # a reader can begin at any block
        some = ids[k * BLOCK : (k + 1) * BLOCK]
        assert unpack(words[first:], len(ids) - k * BLOCK)[: len(some)].tolist() == some


def test_token_files(spark, docs, rows, empty, whole):
    path = scratch_path(spark, "t")
    tokenizer = public_tokenizers.path(NAMES[0])
    write_tokens(docs.repartition(5).withColumnRenamed("lang", "ids"), path, tokenizer)
    got = {r.doc_id: r for r in read_tokens(spark, path, ids=True).collect()}
    at = 0
    for d, t, *_ in sorted(rows):
        ids = [*whole(NAMES[0], t), 2]
        assert got[d].ids == ids and (got[d].start, got[d].n_tokens) == (at, len(ids))
        assert got[d].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    none = scratch_path(spark, "t")
    write_tokens(empty, none, tokenizer)
    assert read_tokens(spark, none).count() == 0
    odd = scratch_path(spark, "t")
    write_tokens(spark.createDataFrame([(None, "b"), (3, None), (3, None), (None, "a")], "doc_id long, text string"), odd, tokenizer)
    assert sorted((r.start, r.doc_id, r.n_tokens) for r in read_tokens(spark, odd).collect()) == [(0, None, 2), (2, None, 2), (4, 3, 1), (5, 3, 1)]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(0, 40), st.integers(1, 6), min_size=1, max_size=8), st.integers(0, 400))
def test_fill_is_exact(counts, budget):
    lengths, n = list(counts), list(counts.values())
    take = fill(lengths, n, budget)
    assert all(0 <= a <= b for a, b in zip(take, n, strict=True))
    total = sum(a * b for a, b in zip(lengths, n, strict=True))
    got = int(np.dot(take, lengths))
    sums = {0}
    for x, c in counts.items():
        sums = {s + k * x for s in sums for k in range(c + 1)}
    assert got == max(x for x in sums if x <= budget)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 300), st.integers(1, 400), min_size=1, max_size=8), st.integers(0, 200_000))
def test_fill_beyond_the_exact_part(counts, budget):
    """Most of a large budget goes by shares; what is missing in the end is less than a document that is left."""
    lengths, n = list(counts), list(counts.values())
    take = fill(lengths, n, budget)
    assert all(0 <= a <= b for a, b in zip(take, n, strict=True))
    got = int(np.dot(take, lengths))
    left = [x for x, c, k in zip(lengths, n, take, strict=True) if k < c]
    assert got <= budget and (not left or budget - got < min(left))


def test_fill_of_a_length_that_shares_would_miss():
    assert fill([2, 5], [10, 1], 5).tolist() == [0, 1]


def plain_targets(sizes, share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    budget, target, free = share * sum(sizes.values()), {}, set(order)
    while free:
        level = (budget - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level >= most * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in free}
        target |= {s: most * sizes[s] for s in over}
        free -= over
    return target


def test_mix(docs, rows):
    got = mix(docs).collect()
    size = {d: len(WORD.findall(t or "")) for d, t, *_ in rows}
    source = {d: s for d, _, _, s, _ in rows}
    total = Counter()
    for d, n in size.items():
        total[source[d]] += n
    want, taken = plain_targets(total), Counter()
    assert {r.doc_id: r.size for r in got} == size
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == total[s] and r.target == pytest.approx(want[s]) and r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
    for s in total:
        # Nothing that was left out would still have fitted.
        left = [r.size for r in got if source[r.doc_id] == s and r.size and r.taken // r.size == want[s] // total[s]]
        assert taken[s] <= want[s] + 1 and (not left or taken[s] + min(left) > want[s] - 1)
        assert want[s] > 1.999 * total[s] or len(left) < 20 or taken[s] >= 0.99 * want[s]
    again = mix(docs.repartition(7, "lang", "n_chars")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_mixed_rows(docs, rows, empty):
    copies = {r.doc_id: r.copies for r in mix(docs).collect()}
    clash = docs.withColumnsRenamed({"lang": "size", "n_chars": "copies"})
    got = mixed(clash)
    assert got.columns == clash.columns
    assert Counter(r.doc_id for r in got.collect()) == Counter({d: n for d, n in copies.items() if n})
    assert mix(empty).count() == 0 and mixed(empty).count() == 0


def used(plan):
    found = {}
    for size, _, n, sequence, offset in plan.runs:
        for k in range(n):
            found.setdefault(sequence + k, []).append((offset, size))
    return found


@settings(max_examples=300, deadline=None)
@given(st.sampled_from([8, 12, 20]), st.lists(st.integers(1, 20), max_size=9))
def test_plan_is_best_on_small_sets(capacity, sizes):
    sizes = [min(s, capacity) for s in sizes]
    plan = plan_packing(np.bincount(sizes, minlength=capacity + 1), capacity)
    found = used(plan)
    assert Counter(s for x in found.values() for _, s in x) == Counter(sizes) and len(found) == plan.sequences
    for x in found.values():
        at = 0
        for offset, size in sorted(x):
            assert offset == at
            at += size
        assert at <= capacity

    def fits(rooms, items):
        return not items or any(
            fits(rooms[:k] + [r - items[0]] + rooms[k + 1 :], items[1:]) for k, r in enumerate(rooms) if r >= items[0] and r not in rooms[:k]
        )

    items = sorted(sizes, reverse=True)
    best = -(-sum(items) // capacity)
    while not fits([capacity] * best, items):
        best += 1
    assert plan.sequences == best
    alone = Plan(np.bincount(sizes, minlength=capacity + 1), capacity)
    best_fit(alone)
    assert plan.sequences <= alone.sequences


def test_pack(docs, rows, empty, whole):
    tokenizer = public_tokenizers.path(NAMES[1])
    got = pack(docs.union(docs).withColumnRenamed("lang", "length"), tokenizer, capacity=256, ids=True).collect()
    pieces, places = {}, {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append((r.start, r.piece, r.length, r.ids_crc32))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, t, *_ in rows:
        ids = [*whole(NAMES[1], t), 2]
        first = len(ids) % 256 or min(len(ids), 256)
        cuts = [0, *range(first, len(ids) + 1, 256)]
        want = [(a, k, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
        assert sorted(pieces[d]) == sorted(want * 2)
    for x in places.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r.length for r in got)
    sizes = np.bincount([r.length for r in got], minlength=257)
    assert len(places) == plan_packing(sizes, 256).sequences >= total / 256
    assert pack(empty, tokenizer).count() == 0
    one = spark_row = docs.sparkSession.createDataFrame([(1, "a b c")], "doc_id long, text string")
    packed = sequences(pack(spark_row.union(one), tokenizer, ids=True)).collect()
    assert len(packed) == 1 and packed[0].ids == 2 * [*whole(NAMES[1], "a b c"), 2] and packed[0].doc_ids == [1, 1]
    assert SCHEMA


def test_mix_of_repeated_and_missing_ids(spark):
    """Rows are documents: none leaves the sizes, and each comes as often as it is taken."""
    rows = [(1, "a b c", "s"), (1, "a b", "s"), (2, "x " * 9, "s"), (None, "n n n n", "s"), (None, "m", None), (None, None, "s"), (3, "same two", "t"), (3, "same two", "t"), (3, "else two", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix(df).collect()
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(d), len((t or "").split())) for d, t, _ in rows)
    assert {r.source_size for r in got} == {18, 1, 6}
    taken, made = Counter(), Counter()
    for r in got:
        taken[r.doc_id, r.size] += r.copies
    out = mixed(df)
    assert out.columns == df.columns
    for r in out.collect():
        made[r.doc_id, len((r.text or "").split())] += 1
    assert made == Counter({k: n for k, n in taken.items() if n})
    assert {tuple(r) for r in out.collect()} <= set(rows)
