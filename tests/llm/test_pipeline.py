"""The pipeline's stages beside plain versions of each, on its own input."""

from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
from helpers import WORD
from test_near_copies import plain_classes
from test_rules_lines_urls import measures, plain_removals
from tokenizers import Tokenizer

from sensorloom.session import write_scratch


@pytest.fixture(scope="module")
def folder(docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    docs.write.parquet(f"{path}/documents.parquet")
    return path


def test_stages(spark, docs, folder):
    at = docs
    for (name, stage), check in zip(corpus_pipeline.STAGES, (quality, lines, near, mixture, packing), strict=True):
        before = [tuple(r) for r in at.collect()]
        at = write_scratch(stage(spark, at, folder), "stage")
        if name != "packing":
            assert at.columns == docs.columns
        check(before, [tuple(r) for r in at.collect()])


def quality(before, after):
    want = set()
    for r in before:
        n, _, _, _, repeated = measures(r[1])
        if n >= 50 and 100 * repeated <= 50 * n:
            want.add(r)
    assert set(after) == want and 0 < len(after) < len(before)


def lines(before, after):
    gone = {}
    for d, k, _ in plain_removals(before, 10):
        gone.setdefault(d, set()).add(k)
    want = {r[0]: "\n".join(x for k, x in enumerate(r[1].split("\n")) if k not in gone.get(r[0], ())) for r in before}
    assert {r[0]: r[1] for r in after} == want and gone and all(r[4] == len(r[1]) for r in after)


def near(before, after):
    assert {r[0] for r in after} == {d for d, x in plain_classes(before, 5).items() if x[3]} and len(after) < len(before)


def mixture(before, after):
    copies = Counter(after)
    assert set(copies) <= set(before) and max(copies.values()) <= 2
    words = lambda rows: sum(len(WORD.findall(r[1])) for r in rows)
    assert words(after) == pytest.approx(1.5 * words(before), rel=0.05)


def packing(before, after):
    of = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert sum(r[3] for r in after) == sum(len(of.encode(r[1], add_special_tokens=False).ids) + 1 for r in before)
    rooms = Counter()
    for r in after:
        rooms[r[5]] += r[3]
    assert max(rooms.values()) <= 1024


def test_run(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(got.columns) and got.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None
