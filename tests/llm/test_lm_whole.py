"""Scores of the language model against brute force over all pairs of words, whatever is cached."""

import math
from collections import Counter

import pytest

from quillwort.llm import ngramlm


@pytest.mark.parametrize("head", [1, 20, 1 << 17])
def test_all_pairs_count_whatever_is_cached(spark, head):
    rows = [(i, " ".join(f"w{(i * j * j + j) % 37}" if j % 3 else "the" for j in range(30))) for i in range(40)] + [(90, None), (91, "w1 unseen the w2"), (92, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = [["", *(t or "").split(), "\n"] for d, t in rows if d < 91]
    c, n = Counter(w for t in seen for w in t[1:]), Counter(p for t in seen for p in zip(t, t[1:]))
    followed, types = Counter(), Counter(a for a, _ in n)
    for (a, _), k in n.items():
        followed[a] += k
    size = sum(c.values()) + len(c) + 1

    def prob(a, b):
        root = (c[b] + 1) / size
        rest = ngramlm.DISCOUNT * types[a] / followed[a] if followed[a] else 1.0
        return max(n[a, b] - ngramlm.DISCOUNT, 0) / followed[a] + rest * root if followed[a] else root

    model, table = ngramlm.train(docs.filter("doc_id < 91").select("text"), head=head, arcs=head)
    for r in ngramlm.score(docs, model, table).collect():
        tokens = ["", *(dict(rows)[r["doc_id"]] or "").split(), "\n"]
        assert r["score"] == pytest.approx(sum(math.log10(prob(a, b)) for a, b in zip(tokens, tokens[1:])))
        assert r["base_score"] == pytest.approx(sum(math.log10((c[b] + 1) / size) for b in tokens[1:]))


def test_parts_and_turns_change_no_score(spark, monkeypatch):
    """Rare and frequent words before and after each other, dealt out to one part or to many."""
    rows = [(i, " ".join(f"r{(i * 31 + j * j) % 90}" if (i + j) % 3 else f"f{j % 4}" for j in range(25))) for i in range(40)] + [(90, "r1 unseen f1 unseen unseen"), (91, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = []
    for size in (1 << 19, 60):
        monkeypatch.setattr(ngramlm, "SLICE", size)
        model, table = ngramlm.train(docs.filter("doc_id < 90").select("text"), head=40)
        assert (model.parts > 10) == (size == 60) and 1 < model.states < 20
        got.append({r["doc_id"]: r for r in ngramlm.score(docs, model, table).collect()})
    for d in got[0]:
        assert got[0][d]["n_known"] == got[1][d]["n_known"]
        assert [got[1][d][c] for c in ("score", "base_score")] == pytest.approx([got[0][d][c] for c in ("score", "base_score")], rel=1e-12)


def test_what_is_dealt_out_is_small(spark, monkeypatch):
    """Pairs took 40 bytes and more in each shuffle as texts."""
    sizes, stored = [], ngramlm.common.store

    def store(df, name):
        got = stored(df, name)
        if name == "lm-pairs":
            sizes.append(got.selectExpr("sum(octet_length(blob))").first()[0])
        return got

    monkeypatch.setattr(ngramlm.common, "store", store)
    rows = [(i, " ".join(f"seldomseen{i}x{j}" if j % 5 == 0 else f"often{(i * j) % 50}" for j in range(100))) for i in range(100)]
    ngramlm.train(spark.createDataFrame(rows, "doc_id long, text string").select("text"), head=1000)
    assert sizes and sizes[0] < 100 * 101 * 16
