import numpy as np
from stars import jaccard_classes, star

from sensorloom.llm.near_dedup import near_classes


def test_a_star_and_a_template(spark):
    """Copies that are linked by their origin alone, and texts of one template in pairs at the border."""
    rnd = np.random.RandomState(21)
    texts = star(rnd, 1100)
    template = [f"t{k}" for k in range(110)]
    for _ in range(150):
        own = [f"y{rnd.randint(10**9)}" for _ in range(30)]
        texts.append(" ".join(template + own))
        texts.append(" ".join(template + [x if k % 8 else f"z{rnd.randint(10**9)}" for k, x in enumerate(own)]))
    rows = [(int(d), t) for d, t in zip(rnd.permutation(len(texts)), texts, strict=True)]
    want = jaccard_classes(rows, 2)
    assert len(set(want.values())) < 400
    got = {r.doc_id: r.component_id for r in near_classes(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()}
    assert got == want
