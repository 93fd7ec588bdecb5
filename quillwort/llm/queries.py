"""The queries opN_<name> over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, common, fingerprint, htmltext, langid, linededup, neardup, ngramlm, surrogates, tiling, warc

#: Folder-independent name of the rank file, and where the tokenizers' package keeps it.
RANKS = "byte_bpe_50k.tiktoken"


def tokenizer() -> tuple[str, str]:
    """Path of the rank file and the split pattern that goes with it."""
    import public_tokenizers

    return public_tokenizers.path(RANKS), public_tokenizers.PATTERN


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every text; digests of the ids and of the decoded bytes."""
    path, pattern = tokenizer()
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    got = bpe.decode(bpe.encode(docs, path, pattern).drop("text"), path, pattern)
    return got.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learnt from four fifths of the labelled documents."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = common.held_out(F.col("doc_id"), 5, 0)
    model = langid.fit(docs.filter(~out))
    return langid.classify(docs.drop("lang"), model).select(
        "doc_id", out.alias("held_out"), "lang_pred", "score", "rejected"
    )


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every text and of its edited text, and how alike they are to each other and to the next one."""
    got = fingerprint.edited_and_next(_table(spark, sf_dir, "documents"))
    sketch, edited, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return got.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint.digest(sketch).alias("fingerprint"), fingerprint.digest(edited).alias("edited_fingerprint"),
        fingerprint.resemblance(sketch, edited).alias("near_edited"), fingerprint.resemblance(sketch, following).alias("near_next"),
        fingerprint.distinct_count(sketch).alias("distinct_shingles"), fingerprint.containment(sketch, edited).alias("contained_edited"),
    )


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with its personal data and secrets replaced."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs, secret="production surrogate key")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without lines that occur before, exactly or nearly."""
    return linededup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), min_words=1)


def op3_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 85 hundredths of their five-word shingles."""
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return htmltext.extract(pages).drop("html").withColumn("n_chars", F.length("text").cast("long"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every text under a model of six sevenths of them."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = common.held_out(F.col("doc_id"), 7, 2)
    model, counts = ngramlm.train(docs.filter(~out).select("text"))
    got = ngramlm.score(docs, model, counts, flag=out).withColumnRenamed("flag", "held_out")
    return got.withColumn("train_tokens", F.lit(model.total).cast("long"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page, read the archives back and merge their captures in order."""
    path = common.new_path(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages"), path)
    return warc.merge(warc.read(spark, path))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the share of it that they hold."""
    return tiling.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_fingerprint, op2_line_dedup, op3_minhash_neardup, op4_byte_bpe, op5_html_text, op6_lm_score, op7_warc, op8_language_id, op9_decontamination, op10_pii_surrogates)}
ORACLES: dict[str, str] = {}
