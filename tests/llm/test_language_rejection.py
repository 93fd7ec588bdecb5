"""Texts of unlearnt languages and junk are rejected, held-out texts of learnt ones stay; edge cases of the operator."""

import random
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quillwort.llm import langid, queries

DATA = Path("/root/testdata/sf0.01")


@pytest.mark.skipif(not DATA.exists(), reason="the driver's tables are not here")
@pytest.mark.parametrize("missing", ["de", "en", "es", "fr"])
def test_a_language_that_was_not_learnt_is_rejected(spark, missing):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = langid.fit(docs.filter(~out & (F.col("lang") != missing)))
    got = langid.classify(docs.filter("lang is not null"), model).select("doc_id", "lang", "rejected").collect()
    other = [r["rejected"] for r in got if r["lang"] == missing]
    clean = [r["rejected"] for r in got if r["lang"] != missing and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert sum(other) >= 0.9 * len(other) and sum(clean) <= 0.05 * len(clean)
    rng = random.Random(3)
    junk = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(n)) for n in (100, 300, 1000, 3000) for _ in range(10)]
    assert sum(model.predict(t)[2] for t in junk) >= 36


def test_clashing_columns_repeats_and_long_texts(spark):
    rows = [(1, "the cat and the dog " * 20_000, "en", 1, "x"), (2, "der hund und die katze " * 40, "de", 2, "x"), (2, "der hund und die katze " * 40, "de", 2, "x"), (3, None, "en", 3, "x"), (4, "", None, 4, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int, _lang_found string")
    got = langid.classify(docs, langid.fit(docs))
    assert got.columns == ["doc_id", "text", "lang", "_lang_found", "lang_pred", "score", "rejected"]
    told = sorted((r["doc_id"], r["lang_pred"], r["rejected"]) for r in got.collect())
    assert told == [(1, "en", False), (2, "de", False), (2, "de", False), (3, "und", True), (4, "und", True)]


@pytest.mark.skipif(not DATA.exists(), reason="the driver's tables are not here")
def test_held_out_accuracy_of_the_query(spark):
    got = queries.op8_language_id(spark, str(DATA))
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{DATA}/documents.parquet").filter("lang is not null and text is not null").collect()}
    out = [(r["doc_id"], r["lang_pred"]) for r in got.filter("held_out and lang_pred <> 'und'").collect()]
    assert out and sum(truth.get(d, p) == p for d, p in out) >= 0.97 * len(out)
