import math
import subprocess
import sys

import numpy as np
import pytest
from test_near_copies import plain_scores

from sensorloom.llm.bloom_lm import score
from sensorloom.llm.words import word_hashes


def hashes(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return word_hashes(data, np.array([0, len(data)]))[0].tolist()


def test_hash_of_a_word_does_not_hang_on_the_words_before():
    """In a fresh process, before and after a word that is longer than any."""
    code = (
        "import numpy as np; from sensorloom.llm.words import word_hashes\n"
        "h = lambda t: word_hashes(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0].tolist()\n"
        "a = h(b'some words'); h(b'x' * 65); b = h(b'some words'); h(b'x' * 5000); c = h(b'some words'); print(a == b == c)"
    )
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.strip() == "True"
    assert len(set(hashes("a" * 70 + " " + "a" * 71 + " b" + "a" * 70))) == 3


def test_scores_with_long_words(spark):
    """Documents of several tasks, some with words of more than 64 bytes, keep their exact columns."""
    texts = [f"One two word{k % 5} " + ("y" * (60 + k) + " " if k % 9 == 4 else "") + "the end" for k in range(60)]
    texts[3], texts[7], texts[8] = None, "", " \t\x1f é\xa0 \x00 É"
    rows = [(k - 5, t) for k, t in enumerate(texts)]
    want = plain_scores(rows)
    got = score(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert r.base_score == pytest.approx(w[4], rel=1e-9) and math.isfinite(r.score)
