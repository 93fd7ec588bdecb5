"""Document fingerprints: bottom-k sketches of word-shingle hashes, in DataFrame functions only.

A sketch is the sorted array of the ``k`` smallest distinct 64-bit hashes of a document's shingles. Sketches of
parts merge to the sketch of the whole, and estimate resemblance, containment and the number of distinct shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

K = 128
WORDS = 5
#: Ids of one bucket of ``with_next`` follow each other; neighbours meet within a bucket of this width.
BUCKET = 128


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-cased words of a text."""
    return F.transform(common.words(text), lambda w: F.xxhash64(w))


def sketch_of(hashes: Column, k: int = K, words: int = WORDS) -> Column:
    """The bottom-k sketch of the shingles of a column of word hashes.

    ``hashes`` should be a column of the child, not an expression, as it is read at every position. A document of
    fewer words than a shingle is one shingle; one without words has the empty sketch.
    """
    many = F.transform(F.sequence(F.lit(0), F.size(hashes) - words), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(words)]))
    few = F.when(F.size(hashes) > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<bigint>"))
    shingles = F.when(F.size(hashes) >= words, many).otherwise(few)
    return F.slice(F.sort_array(F.array_distinct(shingles)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of what two sketches stand for; null counts as empty."""
    none = F.array().cast("array<bigint>")
    return F.slice(F.sort_array(F.array_union(F.coalesce(a, none), F.coalesce(b, none))), 1, k)


def merge_agg(sketches: DataFrame, by: list[str], sketch: str = "sketch", k: int = K) -> DataFrame:
    """One sketch for each group of rows: the k smallest hashes of all of them.

    Only the k smallest of each group are gathered, as ranks are cut off before the shuffle as well.
    """
    rows = sketches.select(*by, F.explode(sketch).alias("_h")).distinct()
    order = Window.partitionBy(*by).orderBy("_h")
    low = rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k)
    return low.groupBy(*by).agg(F.sort_array(F.collect_list("_h")).alias(sketch))


def distinct_count(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else from how densely the k smallest lie."""
    top = F.element_at(sketch, -1).cast("double") + F.lit(2.0**63)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) * F.lit(2.0**64) / F.greatest(top, F.lit(1.0)))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard resemblance of two sketches; 1 if both are empty, exact if the union has at most k hashes."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(a == b, F.lit(1.0)).otherwise(both / F.greatest(F.size(union), F.lit(1)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated part of the first document's shingles that the second has; 1 if the first is empty."""
    like = resemblance(a, b, k)
    na, nb = distinct_count(a, k), distinct_count(b, k)
    shared = like / (1 + like) * (na + nb)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / na))


def digest(sketch: Column) -> Column:
    """A sketch as text: 16 hex digits for each hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def with_sketch(df: DataFrame, text: str = "text", out: str = "sketch", k: int = K) -> DataFrame:
    """``df`` with the sketch of each whole text in ``out``, which replaces a column of that name; null is empty."""
    plain = df.drop("_words", *({out} - {text}))
    return plain.withColumn("_words", word_hashes(F.col(f"`{text}`"))).withColumn(out, sketch_of(F.col("_words"), k)).drop("_words")


def dealt_with_next(df: DataFrame, key: str, order: str) -> DataFrame:
    """``df`` dealt out so that every row can see the next one in ascending key order.

    Rows are dealt out by ranges of ``BUCKET`` consecutive keys, so a text moves once. The first row of every bucket
    is also sent to the bucket before, which needs it for its last row, and the very first to the last bucket; which
    rows these are is found on the keys alone. A null key has no place in the order and is spread by its content.
    """
    bucket = F.floor(F.col(f"`{key}`") / BUCKET)
    lone = F.pmod(F.xxhash64(F.col(f"`{order}`")), F.lit(1 << 20))
    rows = df.withColumn("_none", F.col(f"`{key}`").isNull()).withColumn("_at", F.coalesce(bucket, lone)).withColumn("_halo", F.lit(False))
    keys = df.select(F.col(f"`{key}`").alias("_k")).filter("_k is not null")
    firsts = keys.groupBy(F.floor(F.col("_k") / BUCKET).alias("_at")).agg(F.min("_k").alias("_k"))
    # The bucket before each one: within ranges of buckets first, then between the ranges, which are few.
    firsts = firsts.withColumn("_range", F.floor(F.col("_at") / (1 << 14)))
    firsts = firsts.withColumn("_before", F.lag("_at").over(Window.partitionBy("_range").orderBy("_at")))
    ends = firsts.groupBy("_range").agg(F.max("_at").alias("_end"))
    ends = ends.select("_range", F.coalesce(F.lag("_end").over(Window.orderBy("_range")), F.max("_end").over(Window.partitionBy())).alias("_last"))
    homes = firsts.join(ends, "_range").select("_k", F.coalesce("_before", "_last").alias("_home"))
    copies = df.join(homes, df[key] == homes["_k"])
    copies = copies.select(*[df[c] for c in df.columns], F.lit(False).alias("_none"), F.col("_home").alias("_at"), F.lit(True).alias("_halo"))
    return rows.unionByName(copies).repartition("_none", "_at")


def edited_and_next(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """(key, text, sketch, edited, edited_sketch, next_sketch) for every row.

    The edited text has the last quarter of the code points (rounded down) replaced by as many, or all, from the
    beginning of the next document in ascending key order; the first document follows the last. Rows that repeat a
    key follow each other in the order of their texts. Null texts are empty. A row with a null key has no next
    document: nothing replaces its last quarter, and next_sketch is null. Other columns play no part.
    """
    rows = df.select(F.col(f"`{key}`").alias("_key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    met = with_sketch(dealt_with_next(rows, "_key", "_text"), "_text", "_sketch", k)
    linked = Window.partitionBy("_none", "_at").orderBy("_halo", "_key", "_text")
    follow = lambda c: F.when(~F.col("_none"), F.lead(c).over(linked))
    met = met.select("*", follow("_text").alias("_next"), follow("_sketch").alias("_next_sketch")).filter(~F.col("_halo"))
    n = F.length("_text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("_text", F.lit(1), n - cut), F.coalesce(F.substring("_next", F.lit(1), cut), F.lit("")))
    got = met.select("_key", "_text", "_sketch", "_next_sketch", edited.alias("_edited"))
    got = with_sketch(got, "_edited", "_edited_sketch", k)
    return got.select(
        F.col("_key").alias(key), F.col("_text").alias(text), F.col("_sketch").alias("sketch"), F.col("_edited").alias("edited"),
        F.col("_edited_sketch").alias("edited_sketch"), F.col("_next_sketch").alias("next_sketch"),
    )
