"""Parts without Spark against plain forms of the same."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from quillwort.llm import bpe, htmltext, langid, neardup, ngramlm, tiling, warc


def greedy(text, item, least):
    """Longest free match first, by trying everything."""
    used_t, used_i, out = [x < 0 for x in text], [x < 0 for x in item], []
    while True:
        best = (0, 0, 0)
        for a in range(len(item)):
            for b in range(len(text)):
                n = 0
                while a + n < len(item) and b + n < len(text) and not used_i[a + n] and not used_t[b + n] and item[a + n] == text[b + n]:
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        n, a, b = best
        if n < least:
            return out
        used_i[a : a + n] = used_t[b : b + n] = [True] * n
        out.append((b, a, n))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-1, 3), max_size=30), st.lists(st.integers(0, 3), max_size=20), st.integers(2, 4))
def test_tiles_are_greedy(text, item, least):
    assert tiling.tile(text, item, least) == greedy(text, item, least)


def test_reordered_passages_are_found():
    a, b = "one two three four five six seven", "alpha beta gamma delta epsilon zeta"
    index = tiling.Index([(1, f"{a} {b}"), (2, "short item"), (3, "")], 5)
    assert index.matches(f"x {b}, y! {a} z", 0.6)[0][:3] == (1, 1.0, 2)
    assert index.matches("a short, ITEM here", 0.6) == [(2, 1.0, 1, 2)]
    assert index.matches("one two three four five", 0.6) == [] and index.matches(None, 0.6) == []


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.mark.parametrize("size", [1, 2, 7, 64])
def test_chunks_meet_where_one_scanner_goes(codec, size):
    rng = random.Random(size)
    for _ in range(60):
        text = "".join(rng.choice(["a", "b1", " ", "  ", "\n", "'s", "'re", "é", "…", "!!", "x" * 30, "   \n\n "]) for _ in range(rng.randint(0, 60)))
        parts = [(s, [s + e for e in codec.boundaries(text[s : s + size + 5] + "\0" * (s + size + 5 < len(text)), 0, size, len(text[s : s + size + 5]))]) for s in bpe.chunks(len(text), size)]
        assert codec.stitch(text, parts) == [m.end() for m in codec.find.finditer(text)]


def test_ids_are_those_of_the_library(codec):
    ranks = bpe._ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("", "Hello,  wörld!\n\n<|endoftext|> 12345 日本語 🙂", " " * 50 + "x"):
        assert codec.encode(text) == library.encode_ordinary(text) and codec.decode(codec.encode(text)) == text.encode()


def test_loser_tree_merges():
    rng = random.Random(1)
    for k in range(9):
        runs = [sorted((rng.randint(0, 9), j) for j in range(rng.randint(0, 6))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert warc.url_key("HTTP://www.A.example.com:80/X?q=1#f") == "com,example,a)/x?q=1"
    assert warc.url_key(None) == "" and warc.url_key("nonsense") == "nonsense)/"


def test_shingle_sets_and_the_guarantee():
    s = neardup.Shingler(5)
    assert len(s.shingles(None)) == 0 and len(s.shingles(" \n ")) == 0 and len(s.shingles("A b")) == 1
    assert s.shingles("A b  c d e F").tolist() == s.shingles("a B c\td\ne f").tolist() and len(s.shingles("a b c d e f")) == 2
    signer = neardup.Signer(4)
    values = signer.signature(s.shingles(" ".join(map(str, range(50)))))
    rng = random.Random(2)
    for _ in range(50):  # any differences up to the guaranteed distance leave a shared key
        other = values.copy()
        for i in rng.sample(range(len(values)), neardup.signature_distance(4)):
            other[i] ^= np.uint64(1)
        keys = []
        for v in (values, other):
            signer.signature = lambda _, v=v: v
            keys.append(set(signer.keys(None).tolist()))
        assert keys[0] & keys[1]


def test_chance_of_a_miss():
    for s in (0.8, 0.85):
        n = neardup.chunks_for(s)
        hit = s**7 + 7 * (1 - s) * s**6
        assert (1 - hit) ** n <= neardup.MISS


PAGE = """<html><head><title>T</title></head><body><header>Site</header><nav><ul><li>Menu</ul></nav><div class="cookie-notice">We use</div>
<div class="ad">Buy</div><article><header><h1>A &amp; B</h1></header><p>One <b>two<br>three<p>four\n  five<script>x()</script><form>f</form>
<aside>side</aside><div id="comments"><p>me too</p></div><article>reply</article></article><footer>&copy;</footer></body></html>"""


def test_main_text():
    assert htmltext.main_text(PAGE) == "A & B\nOne two\nthree\nfour five"
    assert htmltext.main_text(None) == "" and htmltext.main_text("") == "" and htmltext.main_text("plain  text") == "plain text"
    assert htmltext.main_text("<div>" * 3000 + "deep") == "deep"


def test_templates_go_and_prose_of_articles_stays():
    page = "<body><div>box</div><article><p>text</p><div><span>share</span></div></article></body>"
    hashes = {n.digest for n in htmltext.hash_subtrees(htmltext.parse(page)) if n.tag in {"div", "p"}}
    assert htmltext.main_text(page, hashes) == "text"
    loose = "<body><div>box</div><p>text</p></body>"
    assert htmltext.main_text(loose, {n.digest for n in htmltext.hash_subtrees(htmltext.parse(loose)) if n.tag == "div"}) == "text"


def test_letters_only_count():
    assert langid.ngram_counts(None, 64) is None and langid.ngram_counts("12 !?", 64) is None
    assert langid.ngram_counts("Ab 7", 64)[1].sum() == langid.ngram_counts("aB !1", 64)[1].sum()


def test_automaton_is_a_distribution():
    words = ["a", "b", "c", ngramlm.END]
    model = ngramlm.Automaton(100, 4, {w: i + 1 for i, w in enumerate(words)}, np.array([0, 40, 30, 20, 10]), 5)
    pairs = np.array([model.code(np.array(s), np.array(w)) for s, w in ((0, 1), (1, 2), (1, 3), (2, 1))])
    model.build(pairs, np.array([8, 20, 10, 30]), np.array([10.0, 40, 30, 20, 0]))
    for before in (1, 2, 3):
        total = 0.0
        for w in (1, 2, 3, 4):
            first, _ = model.traverse(np.array([before]))
            both, _ = model.traverse(np.array([before, w]))
            total += 10 ** (both - first)
        rare = 10 ** (model.traverse(np.array([before, -1]))[0] - model.traverse(np.array([before]))[0]) * 10 ** float(model.base(0))
        assert total + rare == pytest.approx(1.0)
