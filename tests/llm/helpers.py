"""Small odd tables and plain Python versions that the operators are compared with."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, size):
    w = words_of(text)
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def odd_documents(n=90, seed=3):
    """Random texts with null, empty and blank ones, one long one, exact and near copies, a hot source,
    null sources, odd white space and letters of several kinds."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeéñü") for _ in range(rnd.randint(1, 7))) for _ in range(400)]
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([1, 3, 30, 60, 120]))) for _ in range(n)]
    texts[5] = None
    texts[6] = ""
    texts[7] = " \t\n\r\x0b\x0c "
    texts[8] = "One"
    texts[9] = "Two  words\n\n"
    texts[10] = "a b 　c\x1fd x y 漢字 \U0001f600 İstanbul ſ <|endoftext|> " * 9
    texts[11] = " ".join(rnd.choice(vocabulary) for _ in range(6000))
    texts[12] = "same three words " * 40
    base = [rnd.choice(vocabulary) for _ in range(120)]
    for k in range(20, 40):  # a group of near copies of different strength
        w = list(base)
        for _ in range(k - 20):
            w[rnd.randrange(120)] = rnd.choice(vocabulary)
        texts[k] = " ".join(w)
    for k in range(40, 50):
        texts[k] = texts[20]
    shared = ["Shared line of some words here", "  Shared line of some words here \t"]
    for k in range(50, 75):
        texts[k] = " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([60, 90])))
        texts[k] += "\n" + shared[k % 2] + "\nown line " + str(k)
    sources = ["hot" if k % 3 else rnd.choice(["a", "B", "é", None, ""]) for k in range(n)]
    for k in range(50, 75):
        sources[k] = f"site{k % 14}"
    rows = [(k * 7 % n, t, "en", s, len(t or "")) for k, (t, s) in enumerate(zip(texts, sources, strict=True))]
    rnd.shuffle(rows)
    return rows


def components_of(links, nodes):
    """The smallest node each node reaches."""
    top = {k: k for k in nodes}

    def find(a):
        while top[a] != a:
            a = top[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            top[max(a, b)] = min(a, b)
    return {k: find(k) for k in nodes}
