import numpy as np
from stars import jaccard_classes, star

from sensorloom.llm.paragraph_dedup import BANDS, ROWS, repeated_paragraphs


def test_a_star_of_paragraphs(spark):
    """Edited copies of one paragraph, more than a bucket compares, that are linked by it alone."""
    rnd = np.random.RandomState(22)
    texts = star(rnd, 1100, words=300, low=4, high=6)
    rows = [(int(d), t) for d, t in zip(rnd.permutation(len(texts)), texts, strict=True)]
    want = jaccard_classes(rows, 5)
    assert set(want.values()) == {0}
    got = {r.doc_id: r.kept_doc_id for r in repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: 0 for d, _ in rows if d}


def test_bands_miss_few_pairs():
    """At similarity 0.8 fewer than one pair in 50 000 shares no band."""
    assert (1 - 0.8**ROWS) ** BANDS < 1 / 50_000
