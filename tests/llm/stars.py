"""Large groups whose links go by few members, and their components by brute force."""

import numpy as np
from helpers import components_of, shingles


def star(rnd, copies, words=150, low=6, high=8):
    """One text and copies of it with so many words replaced, each its own: links go by the text alone."""
    base = [f"w{k}" for k in range(words)]
    texts = [" ".join(base)]
    for _ in range(copies):
        w = list(base)
        at, step = rnd.randint(0, 3), words // high
        for k in range(rnd.randint(low, high)):
            w[(at + k * step) % words] = f"x{rnd.randint(10**9)}"
        texts.append(" ".join(w))
    return texts


def jaccard_classes(rows, size):
    """The components of the texts by brute force, with counts of shared shingles by a table of ones."""
    sets = [shingles(t, size) for _, t in rows]
    number = {}
    for s in sets:
        for x in s:
            number.setdefault(x, len(number))
    ones = np.zeros((len(sets), len(number)), np.float32)
    for k, s in enumerate(sets):
        ones[k, [number[x] for x in s]] = 1
    both, n = ones @ ones.T, ones.sum(1)
    a, b = np.nonzero(np.triu(100 * both >= 80 * (n[:, None] + n[None] - both), 1))
    return components_of([(rows[i][0], rows[j][0]) for i, j in zip(a.tolist(), b.tolist(), strict=True)], [r[0] for r in rows])
