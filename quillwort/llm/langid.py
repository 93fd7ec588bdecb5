"""Language identification by the nearest of several clustered centroids per language.

A text becomes a TF-IDF vector of its letter n-grams (lengths 1 to 3, hashed), normalised to length 1.
Each language keeps up to ``clusters`` centroids, found by spherical k-means over a bounded sample of labelled
texts. The language of the nearest centroid by cosine wins. A text whose best cosine lies below the radius for texts
of its length is flagged as rejected; the radii lie between the cosines that the sample's texts, and pieces of them,
reach with centroids of their own language and with those of others.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

UNDETERMINED = "und"
#: Words of the pieces that show how cosines depend on length; lengths count in powers of 2 of letters.
PIECES, LENGTHS = (4, 8, 16, 32, 64, 128), 32
#: How far the radius lies inward of what the best other language reaches at most, towards the own one; and what part
#: of the latter it is at most.
INWARD, MARGIN = 0.1, 0.8
OUTPUT = "lang_pred string, score double, rejected boolean"


@lru_cache(1)
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or a blank if it is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for start, end in ((0, 0xD800), (0xE000, 0x110000)):
        for c in range(start, end):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
    return table


def ngram_counts(text: str | None, buckets: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Hashed letter n-grams of a whole text and how often each occurs; None without letters."""
    if not text:
        return None
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = codes != 32
    if not keep.any():
        return None
    keep[1:] |= codes[:-1] != 32  # one blank after each word
    codes = np.concatenate(([32], codes[keep], [32])).astype(np.uint64)
    mask = np.uint64(buckets - 1)
    mix = lambda x: ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) & mask
    two = codes[:-1] * np.uint64(0x110000) + codes[1:] + np.uint64(1 << 50)
    three = (codes[:-2] * np.uint64(1000003) + codes[1:-1]) * np.uint64(1000003) + codes[2:]
    found = np.concatenate((mix(codes), mix(two), mix(three))).astype(np.int64)
    counts = np.bincount(found, minlength=buckets)
    at = np.flatnonzero(counts)
    return at, counts[at]


def length_class(found: tuple[np.ndarray, np.ndarray]) -> int:
    """The power of 2 of a text's letters, of which there is about one for three n-grams."""
    return min(LENGTHS - 1, int(max(1, found[1].sum() // 3)).bit_length() - 1)


def _pieces(text: str) -> list[str]:
    """Runs of words from the inside of a text, at places that its hash gives."""
    words, out = text.split(), []
    for size in PIECES:
        if len(words) > size:
            at = crc32(text.encode("utf-8", "surrogatepass")) * (size + 7) % (len(words) - size)
            out.append(" ".join(words[at : at + size]))
    return out


@dataclass
class Model:
    """Centroids with the language of each, and the rejection radius for each class of lengths."""

    langs: list[str]
    centroids: np.ndarray
    radius: np.ndarray
    idf: np.ndarray

    def vector(self, found: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        at, n = found
        weights = np.sqrt(n) * self.idf[at]
        return at, weights / (np.linalg.norm(weights) or 1.0)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        found = ngram_counts(text, len(self.idf))
        if found is None or not self.langs:
            return UNDETERMINED, 0.0, True
        at, weights = self.vector(found)
        like = self.centroids[:, at] @ weights
        best = int(np.argmax(like))
        score = float(min(1.0, max(0.0, like[best])))
        return self.langs[best], score, bool(score < self.radius[length_class(found)])

    def calibrate(self, texts: Iterable[tuple[str, tuple[np.ndarray, np.ndarray]]], slack: float) -> None:
        """Sets the radii from texts with their languages; classes without any take that of the nearest shorter one.

        With a single language there is nothing to tell it from: the radius is ``slack`` times its smallest cosines.
        """
        names = np.array(self.langs)
        own: dict[int, list[float]] = {}
        other: dict[int, list[float]] = {}
        for name, found in texts:
            at, weights = self.vector(found)
            like = self.centroids[:, at] @ weights
            own.setdefault(length_class(found), []).append(float(like[names == name].max()))
            if (names != name).any():
                other.setdefault(length_class(found), []).append(float(like[names != name].max()))
        last = 0.0
        for c in range(min(own, default=LENGTHS), LENGTHS):
            if c in own:  # with the neighbouring classes, as few texts may be of one
                near = np.concatenate([own.get(x, []) for x in (c - 1, c, c + 1)])
                far = np.concatenate([other.get(x, []) for x in (c - 1, c, c + 1)])
                least = float(np.quantile(near, 0.05))
                most = float(np.quantile(far, 0.95)) if len(far) else None
                last = slack * float(near.min()) if most is None else min(MARGIN * least, most + INWARD * max(0.0, least - most))
            self.radius[c] = last


def _clusters(vectors: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from farthest-first seeds; centroids and the cluster of each vector."""
    seeds = [int(np.argmax(vectors @ vectors.mean(0)))]
    while len(seeds) < min(k, len(vectors)):
        near = (vectors @ vectors[seeds].T).max(1)
        if near.min() > 1 - 1e-9:
            break
        seeds.append(int(np.argmin(near)))
    centers, own = vectors[seeds].copy(), np.zeros(len(vectors), int)
    for _ in range(rounds):
        own = np.argmax(vectors @ centers.T, 1)
        for c in range(len(centers)):
            if (own == c).any():
                mean = vectors[own == c].mean(0)
                centers[c] = mean / (np.linalg.norm(mean) or 1.0)
    return centers, own


def fit(
    labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
    sample_per_lang: int = 300, clusters: int = 3, buckets: int = 8192, slack: float = 0.25,
) -> Model:
    """Learn the centroids from at most ``sample_per_lang`` whole texts of each language.

    The sample is the rows whose key has the smallest hashes; ids are chosen first, so texts outside the sample
    are never moved. Rows with a null text, language or key, and texts without letters, teach nothing. An empty
    table gives a model that answers ``und``. ``slack`` counts only where all texts are of one language.
    """
    rows = labelled.select(F.col(key).alias("_key"), F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    order = Window.partitionBy("_lang").orderBy(F.xxhash64("_key"), "_key")
    chosen = (
        rows.filter("_key is not null and _lang is not null and _text is not null")
        .select("_key", "_lang").withColumn("_n", F.row_number().over(order))
        .filter(F.col("_n") <= sample_per_lang).select("_key").distinct()
    )
    common.small_batches(labelled.sparkSession)

    # Counts reach the driver as bytes: as lists of Python's numbers they would take many times the room there.
    @F.pandas_udf("struct<at:binary,n:binary,pieces:array<string>>")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            got = [ngram_counts(x, buckets) or ((), ()) for x in texts]
            yield pd.DataFrame({"at": [np.asarray(a, ">i4").tobytes() for a, _ in got], "n": [np.asarray(n, ">i4").tobytes() for _, n in got], "pieces": [_pieces(x) for x in texts]})

    # The sample is bounded by sample_per_lang rows of each language, so its ids can be broadcast.
    sample = rows.join(F.broadcast(chosen), "_key").filter("_text is not null and _lang is not null")
    sample = sample.select("_key", "_lang", counted("_text").alias("c")).select("_key", "_lang", "c.*").filter("octet_length(at) > 0")
    got = sorted(sample.collect(), key=lambda r: (r["_lang"], r["_key"], bytes(r["at"][:32])))
    counts = lambda r: tuple(np.frombuffer(r[c], ">i4").astype(np.int64) for c in ("at", "n"))
    seen, kept = {}, []
    for r in got:  # keys may repeat: the bound holds for rows too
        seen[r["_lang"]] = seen.get(r["_lang"], 0) + 1
        if seen[r["_lang"]] <= sample_per_lang:
            kept.append(r)
    df = np.zeros(buckets)
    for r in kept:
        df[counts(r)[0]] += 1
    idf = np.log((1 + len(kept)) / (1 + df)) + 1
    model = Model([], np.zeros((0, buckets)), np.zeros(LENGTHS), idf)
    centers = []
    for name in sorted(seen):
        own = [r for r in kept if r["_lang"] == name]
        vectors = np.zeros((len(own), buckets), np.float32)
        for i, r in enumerate(own):
            at, weights = model.vector(counts(r))
            vectors[i, at] = weights
        found, member = _clusters(vectors, clusters)
        for c in range(len(found)):
            if (member == c).any():
                model.langs.append(name)
                centers.append(found[c])
    if centers:
        model.centroids = np.array(centers, np.float32)
        whole = ((r["_lang"], counts(r)) for r in kept)
        parts = ((r["_lang"], ngram_counts(x, buckets)) for r in kept for x in r["pieces"])
        model.calibrate(chain(whole, ((name, found) for name, found in parts if found is not None)), slack)
    return model


def predicted(df: DataFrame, model: Model, text: str = "text") -> Column:
    """A struct column of lang_pred, score and rejected for the whole text in ``text``."""
    common.small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # a few centroids of fixed width per language

    @F.pandas_udf(OUTPUT)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for texts in batches:
            yield pd.DataFrame([own.predict(x) for x in texts], columns=["lang_pred", "score", "rejected"])

    return predict(df[text])


def classify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with lang_pred, score and rejected. Columns of these names are replaced, all others stay.

    Null texts and texts without letters give ``und``, 0 and rejected. Every row gets its own answer, also
    repeated ones; an empty table gives an empty table.
    """
    plain = df.drop("lang_pred", "score", "rejected")
    packed = plain.select(F.struct(*[F.col(f"`{c}`") for c in plain.columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    told = packed.select("row", predicted(packed, model).alias("told"))
    return told.select(*[F.col(f"row.`{c}`").alias(c) for c in plain.columns], "told.lang_pred", "told.score", "told.rejected")
