"""The operators on small tables: brute force, nulls, empty and long texts, ties, repeated rows, clashing columns."""

import math
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quillwort.llm import bpe, components, fingerprint, htmltext, langid, linededup, neardup, ngramlm, queries, surrogates, tiling, warc

DOCS = "doc_id long, text string, _text string, key string"
BASE = "the quick brown fox jumps over the lazy dog while seven wizards brew strong potions near old castle walls every single rainy night of may"


def docs(spark, rows):
    """Documents with two more columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], DOCS)


ROWS = [(1, BASE), (2, BASE + " "), (3, BASE.replace("single", "second") + " or june or july or august or any other month of year"), (5, None), (6, ""), (7, "ab"), (7, "ab"), (None, BASE), (9, " \t")]


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (8, 9), (7, 7), (3, None), (10, 3)], "u long, v long")
    got = {(r["node"], r["component"]) for r in components.components(edges).collect()}
    assert got == {(3, 3), (4, 3), (5, 3), (10, 3), (8, 8), (9, 8)}
    assert components.components(edges.limit(0)).count() == 0


def test_near_duplicates(spark):
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs(spark, ROWS), percent=60).collect()}
    n = len(BASE.split()) - 4
    assert {(1, n, 1, True), (2, n, 1, False), (5, 0, 5, True), (6, 0, 6, True), (9, 0, 9, True), (7, 1, 7, True), (None, n, None, True)} <= got
    assert neardup.near_duplicates(docs(spark, [])).count() == 0


def test_near_duplicates_in_a_crowd(spark):
    words = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(40):  # copies with edits of their own; some are too far from all others
        own = list(words)
        for j in range(1 + d % 5):
            own[(7 * d + 23 * j) % 120] = f"e{d}x{j}"
        rows.append((d, " ".join(own)))
    sets = {d: {tuple(t.split()[i : i + 5]) for i in range(116)} for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs(spark, rows), percent=85).collect()}
    assert got == {d: find(d) for d in sets}


def test_line_dedup(spark):
    line, near = "alpha beta gamma delta epsilon zeta eta theta", "Alpha, beta gamma delta epsilon zeta ETA theta!"
    long = " ".join(f"word{i}" for i in range(200))
    rows = [(2, f"{near}\nhi\n{long} end"), (1, f"{line}\nhi"), (3, None), (4, ""), (5, f"{long}\n{long} fin"), (None, line)]
    got = {r["doc_id"]: (r["text"], r["removed_lines"]) for r in linededup.dedup_lines(docs(spark, rows)).collect()}
    assert got[1] == (f"{line}\nhi", 0) and got[2][0].startswith("hi") and got[3] == (None, 0) and got[4] == ("", 0) and got[None] == (line, 0)
    assert linededup.dedup_lines(docs(spark, [])).columns == ["doc_id", "text", "_text", "key", "removed_lines"]


def test_edit_similarity(spark):
    df = spark.createDataFrame([("a b c d".split(), "a x c d".split()), ("a".split(), "a".split())], "a array<string>, b array<string>")
    assert [r["s"] for r in df.select(linededup.edit_similarity(*map(linededup.as_characters, map(F.col, "ab"))).alias("s")).collect()] == [0.75, 1.0]


def test_fingerprints(spark):
    rows = [(1, BASE), (4, "one two three four five six"), (200, BASE + " x"), (9, None), (9, None), (None, BASE)]
    got = {}
    for r in fingerprint.edited_and_next(docs(spark, rows)).collect():
        got.setdefault(r["doc_id"], r)
    order = {1: 4, 4: 9, 200: 1}
    texts = {d: t or "" for d, t in rows if d is not None}
    for d, following in order.items():
        cut = len(texts[d]) // 4
        assert got[d]["edited"] == texts[d][: len(texts[d]) - cut] + texts[following][:cut]
    assert got[9]["sketch"] == [] and got[None]["next_sketch"] is None and got[1]["sketch"] == got[None]["sketch"]
    like = fingerprint.resemblance(F.col("sketch"), F.col("next_sketch"))
    row = fingerprint.edited_and_next(docs(spark, rows)).filter("doc_id = 200").select(like.alias("x"), fingerprint.distinct_count(F.col("sketch")).alias("n")).first()
    n = len(BASE.split()) - 4
    assert row["x"] == pytest.approx(n / (n + 1)) and row["n"] == n + 1


def test_sketches_merge(spark):
    df = spark.createDataFrame([("a", " ".join(f"w{i}" for i in range(s, s + 300))) for s in (0, 100, 200)], "g string, text string")
    parts = fingerprint.with_sketch(df, k=32)
    whole = fingerprint.with_sketch(spark.createDataFrame([(" ".join(f"w{i}" for i in range(500)),)], "text string"), k=32).first()["sketch"]
    assert fingerprint.merge_agg(parts, ["g"], k=32).first()["sketch"] == whole


def test_bpe_of_nulls_long_texts_and_repeats(spark):
    path, pattern = queries.tokenizer()
    rows = [(1, None), (2, ""), (3, "héllo " * 40), (3, "héllo " * 40), (4, "x" * 500)]
    got = bpe.decode(bpe.encode(docs(spark, rows), path, pattern, size=50, overlap=8), path, pattern).collect()
    codec = bpe.Codec(path, pattern)
    assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in got) == Counter((d, tuple(codec.encode(t or "")), (t or "").encode()) for d, t in rows)
    assert bpe.encode(docs(spark, []), path, pattern).count() == 0


def test_pages(spark):
    box = "<div>subscribe today</div>"
    rows = [(i, f"http://a.com/{i}", f"<body>{box}<p>text {i}</p></body>") for i in range(8)] + [(20, None, f"<body>{box}</body>"), (21, "http://b.com", None), (22, "http://b.com/x", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("old"))
    got = {r["page_id"]: r["text"] for r in htmltext.extract(pages).collect()}
    assert got == {i: f"text {i}" for i in range(8)} | {20: "subscribe today", 21: "", 22: ""}


def test_archives(spark, tmp_path):
    rows = [(3, "http://a/x y", "é\r\n\r\nWARC/1.1"), (1, "http://a/x", "é\r\n\r\nWARC/1.1"), (2, None, None), (4, "http://a/x", ""), (None, "u", "alone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write(pages, str(tmp_path / "w"))
    got = warc.merge(warc.read(spark, str(tmp_path / "w"))).collect()
    by = {r["page_id"]: r for r in got}
    assert (by[1]["record_type"], by[3]["record_type"], by[3]["refers_to"], by[3]["payload_bytes"]) == ("response", "revisit", 1, len("é\r\n\r\nWARC/1.1".encode()))
    assert (by[2]["record_type"], by[4]["refers_to"], by[None]["record_type"]) == ("response", 2, "response")
    assert [(r["urlkey"], r["captured"]) for r in got] == sorted((r["urlkey"], r["captured"]) for r in got)
    warc.write(pages.limit(0), str(tmp_path / "none"))
    assert warc.merge(warc.read(spark, str(tmp_path / "none"))).count() == 0


def test_language(spark):
    rows = [(i, " ".join(ws[(i + j) % len(ws)] for j in range(12)), lang) for lang, ws in (("en", "the and that with from this".split()), ("de", "und der nicht auch für über".split())) for i in range(30)]
    df = spark.createDataFrame(rows + [(99, None, "en"), (98, "123", None)], "doc_id long, text string, lang string").withColumn("score", F.lit("old"))
    model = langid.fit(df)
    got = [(r["lang"], r["lang_pred"]) for r in langid.classify(df, model).filter("doc_id < 98").collect()]
    assert all(a == b for a, b in got) and len(got) == 60
    assert {r["lang_pred"] for r in langid.classify(df, model).filter("doc_id >= 98").collect()} == {"und"}
    empty = langid.fit(df.limit(0))
    assert langid.classify(df, empty).filter("lang_pred = 'und' and score = 0").count() == df.count()


def test_scores(spark):
    rows = [(i, BASE if i % 2 else "the fox and the dog\x0bAND The fox") for i in range(20)] + [(20, None), (21, "unseen words"), (21, "unseen words")]
    df = docs(spark, rows)
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    model, counts = ngramlm.train(df.filter(~out).select("text"))
    tokens = {d: [w.decode() for w in (t or "").encode().lower().split()] + ["\n"] for d, t in rows}
    c = Counter(w for d, t in rows if zlib.crc32(str(d).encode()) % 7 != 2 for w in tokens[d])
    n, v = sum(c.values()), len(c)
    got = ngramlm.score(df, model, counts).collect()
    assert len(got) == len(rows) and model.total == n and model.distinct == v
    for r in got:
        w = tokens[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"]) == (len(w), sum(c[x] > 0 for x in w))
        assert r["base_score"] == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
    model, counts = ngramlm.train(df.limit(0).select("text"))
    assert ngramlm.score(df, model, counts).count() == len(rows)


def test_decontamination(spark):
    bench = spark.createDataFrame([(1, BASE), (2, None), (3, ""), (1, BASE)], "item_id long, text string")
    rows = [(1, f"intro {BASE.upper()} outro"), (2, BASE[: len(BASE) // 3]), (3, None), (4, " ".join(BASE.split()[10:] + BASE.split()[:10]))]
    got = {(r["doc_id"], r["item_id"]) for r in tiling.contamination(docs(spark, rows), bench).collect()}
    assert got == {(1, 1), (4, 1)}
    assert {r["doc_id"] for r in tiling.decontaminate(docs(spark, rows), bench).collect()} == {2, 3}
    assert tiling.contamination(docs(spark, rows), bench.limit(0)).count() == 0 and tiling.contamination(docs(spark, []), bench).count() == 0


def test_surrogates(spark):
    rows = [(1, "mail Ana.Sol@mail.example.com now, or ana.sol@mail.example.com"), (2, "call +1 (988) 555-2485 or +1 988 555 2485. ip 10.2.3.4"), (3, None), (4, ""), (5, "nothing: 1995, 3.5 and 12"), (6, "card 4111 1111 1111 1111"), (7, "Mrs Jane Doe, Господин Иванов"), (7, "password=abcdef0123456789")]
    got = [(r["doc_id"], r["text"], r["pii_kinds"]) for r in surrogates.replace_entities(docs(spark, rows), "k").collect()]
    by = {}
    for d, t, k in got:
        by.setdefault(d, []).append((t, k))
    assert by[3] == [(None, [])] and by[4] == [("", [])] and by[5] == [(rows[4][1], [])]
    a, b = by[1][0][0].split()[1].rstrip(","), by[1][0][0].split()[-1]
    assert a.lower().strip(",") == b and a != b and "sol@" not in b and b.endswith(".com") and a[0].isupper()
    digits = lambda s: "".join(c for c in s if c.isdigit())
    phones = by[2][0][0].split("call ")[1].split(". ip")[0].split(" or ")
    assert digits(phones[0]) == digits(phones[1]) and phones[0].startswith("+1 (") and "555-2485" not in by[2][0][0]
    card = digits(by[6][0][0])
    total = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(card)))
    assert len(card) == 16 and total % 10 == 0 and card != "4111111111111111"
    names = next(t for t, k in by[7] if "name" in k)
    assert names.startswith("Mrs ") and names.split(",")[0].split()[1] in surrogates.GIVEN["latin", "female"] and "Иванов" not in names
    assert all("a" <= c.lower() <= "я" or c == "ё" for c in names.rsplit(" ", 1)[1])
    assert surrogates.replace_entities(docs(spark, []), "k").count() == 0


def test_surrogates_collide_and_try_again(spark):
    entities = spark.createDataFrame([("ssn", f"{i:04d}") for i in range(300)], "kind string, norm string")
    got = surrogates.assign(entities, "k").collect()
    assert len({r["surrogate"] for r in got}) == 300 and not {r["surrogate"] for r in got} & {r["norm"] for r in got}


def test_pipeline_keeps_what_it_should(spark, tmp_path):
    import corpus_pipeline

    rows = [(i, f"{BASE} number{i} " + " ".join(f"u{i}w{j}" for j in range(40)), "en", "s", 10) for i in range(12)]
    rows += [(20, rows[0][1], "en", "s", 10), (21, "solo benchmark text that holds a whole item of the test set and more", "en", "s", 10)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "benchmark text that holds a whole item")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} == set(range(12)) and all(r["round_trip"] for r in got)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]


