"""Codes of words, as arrays of whole batches of texts."""

import random

import numpy as np

from quillwort.llm import ngramlm


def test_codes_of_words_are_ids_or_hashes():
    rng = random.Random(5)
    pool = ["a", "Ab", "aB\x00", "é", "É", "日本", "x" * 300, *(f"w{i}" for i in range(400))]
    texts = [None, "", " \t\x0b ", *("".join(rng.choice(pool) + rng.choice(" \n\t\r\x0b\x0c") for _ in range(rng.randrange(60))) for _ in range(200))]
    raw = [t if t is None else t.encode() for t in texts]
    split = [(t or b"").lower().split() for t in raw]
    words = {w.decode(): i + 2 for i, w in enumerate(sorted({w for s in split for w in s})[::2])} | {ngramlm.END: 1}
    codes, sizes = ngramlm.Codes(words).of(raw)
    assert sizes.tolist() == [len(s) + 2 for s in split]
    assert codes.dtype == np.uint64 and (codes[np.cumsum(sizes) - sizes] == 0).all() and (codes[np.cumsum(sizes) - 1] == 1).all()
    seen, at = {}, 0
    for s, n in zip(split, sizes.tolist(), strict=True):
        for w, code in zip(s, codes[at + 1 : at + n - 1].tolist(), strict=True):
            assert words.get(w.decode()) == code if w.decode() in words else code >> 63 and seen.setdefault(code, w) == w
        at += n


def test_pairs_are_tallied():
    rng = np.random.default_rng(1)
    prev, word = rng.integers(0, 40, 5000).astype(np.uint64), rng.integers(0, 40, 5000).astype(np.uint64) | ngramlm.RARE
    got = sorted(zip(*(c.tolist() for c in ngramlm.tallied(prev, word)), strict=True))
    assert got == list(zip(*(c.tolist() for c in ngramlm.summed(prev, word, np.ones(5000, np.int64))), strict=True))
    assert all(len(c) == 0 for c in ngramlm.tallied(prev[:0], word[:0]))
