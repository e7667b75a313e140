"""Whole texts to token ids with the tokenizers library; a Python worker encodes a word once."""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Callable

import numpy as np

#: A space in front of more white space: such texts are encoded whole.
_ODD = re.compile(r" \s")
_TWO_LINES = re.compile(r"(\S+)\n(\S+)")
#: Letters of Latin-1 with ASCII signs behind them, without the apostrophe: two pieces at most
#: for the model, whatever case folding and composition do before.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
#: Words kept with their ids, by each of two forms; then that memory starts anew. A million take
#: about 200 MB of a Python worker, which keeps them from task to task.
KEPT_WORDS = 1_000_000
#: Longer words are encoded each time.
KEPT_CHARS = 48


def _byte_letters() -> dict[int, int]:
    """The letter that byte-level models write for each byte: itself if printable, else the next one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return dict(zip(shown, shown, strict=True)) | {b: 256 + k for k, b in enumerate(hidden)}


@functools.cache
def encoder(path: str) -> Callable[[str], bytes]:
    """A function from a text to its ids as little-endian unsigned 32-bit integers.

    Equal to ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` for the two
    kinds of tokenizer that cut text at its words before merging: byte-level, where a word takes
    the space before it, and lower-cased words without spaces. Texts are cut at single spaces, a
    word's ids are remembered, plain words go straight to the tokenizer's model, and all else
    through the whole tokenizer. The strings of special tokens become their ids, as there.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    model, letters = tokenizer.model, _byte_letters()
    folded = tokenizer.normalizer is not None

    def whole(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def piece(text: str) -> bytes:
        found = model.tokenize(text.encode().decode("latin-1").translate(letters))
        return b"".join(t.id.to_bytes(4, "little") for t in found)

    # Which words the model may see alone is tried once, on words of both forms.
    def plain(space: str, word: str, signs: str) -> bytes:
        ids = piece(word.lower()) if folded else piece(space + word)
        if signs and (more := behind.get(signs)) is None:
            more = piece(signs)
            if len(behind) < 10_000:
                behind[signs] = more
        return ids + more if signs else ids

    behind: dict[str, bytes] = {}

    direct = all(plain(s, w, g) == whole(s + w + g) for s in ("", " ") for w, g in (("Élan", ""), ("the", "###"), ("Straße", ".,")))

    class Memory(dict):
        def __init__(self, space: str):
            self.space = space

        def __missing__(self, word: str) -> bytes:
            if direct and (m := _PLAIN.fullmatch(word)):
                ids = plain(self.space, m[1], m[2])
            elif m := _TWO_LINES.fullmatch(word):
                return self[m[1]] + newline + first[m[2]]
            else:
                ids = whole(self.space + word)
            if len(word) <= KEPT_CHARS:
                if len(self) >= KEPT_WORDS:
                    self.clear()
                self[word] = ids
            return ids

    newline = whole("\n")
    first, later = Memory(""), Memory(" ")

    def encode(text: str) -> bytes:
        if _ODD.search(text):
            return whole(text)
        words = text.split(" ")
        return first[words[0]] + b"".join(map(later.__getitem__, words[1:]))

    return encode
