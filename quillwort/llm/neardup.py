"""Near-duplicate documents by a multi-index Hamming join of b-bit MinHash signatures.

A document is the set of its distinct word shingles. Its signature is a row of minhash values cut to ``BITS`` bits.
The signature is split into chunks, and every chunk is indexed once for each way to leave out ``ERRORS`` of its
values: two signatures that differ in at most ``chunks * (ERRORS + 1) - 1`` values share an index key for certain,
by the pigeonhole principle. Documents that share a key are candidates, and a link is confirmed on the full sets.

Equal sets form one class and are represented by one document. Within a key, candidates are not all paired: first
everything is compared with one pivot; after the confirmed links have been joined to components, only documents of
different components are still compared. No link between components is lost by that. Texts move only for pairs whose
parities allow for a link: a set has ``PARITIES`` bits, each the parity of how many of its shingles fall to it, and
two sets differ in at least as many shingles as bits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components, linked, meeting

#: Bits kept of each minhash value, values of a chunk, and values of a chunk that may differ.
BITS, WIDTH, ERRORS = 16, 7, 1
#: The chance that a pair right at the threshold shares no key decides the number of chunks.
MISS = 5e-6
#: Bits of shingle parities.
PARITIES = 512
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_REMEMBERED = 500_000


def chunks_for(similarity: float) -> int:
    """Chunks so that a pair of this resemblance is missed with a chance of ``MISS`` at most."""
    good = sum(math.comb(WIDTH, e) * (1 - similarity) ** e * similarity ** (WIDTH - e) for e in range(ERRORS + 1))
    return max(1, math.ceil(math.log(MISS) / math.log(1 - good))) if good < 1 else 1


def signature_distance(chunks: int) -> int:
    """The number of differing values up to which a shared key is certain."""
    return chunks * (ERRORS + 1) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sets of hashed word shingles; words are remembered within a worker."""

    def __init__(self, words: int = 5):
        self.words, self.known = words, {}

    def _hash(self, word: bytes) -> int:
        if len(self.known) >= _REMEMBERED:
            self.known.clear()
        got = self.known[word] = xxhash.xxh3_64_intdigest(word)
        return got

    def hashes(self, text: str | None) -> np.ndarray:
        """Hashes of the words: ASCII letters in lower case, split at blank, tab, line ends, VT and FF."""
        found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        get, new = self.known.get, self._hash
        return np.fromiter((get(w) or new(w) for w in found), np.uint64, len(found))

    def shingles(self, text: str | None) -> np.ndarray:
        """The sorted distinct shingle hashes; the whole sequence is one if it is shorter; empty without words."""
        h = self.hashes(text)
        if not len(h):
            return h
        width = min(self.words, len(h))
        n = len(h) - width + 1
        out = np.full(n, width, np.uint64)
        for i in range(width):
            out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
        return np.unique(out)


class Signer:
    """Index keys of the signature of a shingle set."""

    def __init__(self, chunks: int):
        rng = np.random.Generator(np.random.PCG64(20240229))
        n = chunks * WIDTH
        self.chunks = chunks
        self.xor = rng.integers(0, 2**64, n, np.uint64, endpoint=False)
        self.times = rng.integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)
        self.kept = np.array([[i for i in range(WIDTH) if i not in out] for out in combinations(range(WIDTH), ERRORS)])

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.xor), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), 2048):
            part = shingles[at : at + 2048, None] ^ self.xor
            part *= self.times
            np.minimum(least, part.min(0), out=least)
        return _mixed(least) >> np.uint64(64 - BITS)

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """One key for each chunk and each choice of values left out of it."""
        values = self.signature(shingles).reshape(self.chunks, WIDTH)[:, self.kept]
        where = np.arange(values.shape[0] * values.shape[1], dtype=np.uint64).reshape(values.shape[:2])
        out = where + np.uint64(1)
        for i in range(values.shape[2]):
            out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + values[:, :, i])
        return out.reshape(-1).view(np.int64)


def parities(shingles: np.ndarray) -> np.ndarray:
    """The parity of how many shingles fall to each of ``PARITIES`` bits, as numbers of 64 bits."""
    odd = np.bincount((_mixed(shingles) % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _fingerprinted(docs: DataFrame, chunks: int, words: int) -> DataFrame:
    """(id, n, cls, keys, odd) of every document; cls tells equal sets, and is null for empty ones."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, signer = Shingler(words), Signer(chunks)
        for b in batches:
            sizes, classes, keys, odd = [], [], [], []
            for text in b.column("text").to_pylist():
                s = shingler.shingles(text)
                sizes.append(len(s))
                classes.append(xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None)
                keys.append(signer.keys(s) if len(s) else None)
                odd.append(parities(s) if len(s) else None)
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(sizes, pa.int64()), pa.array(classes, pa.string()), pa.array(keys, lists), pa.array(odd, lists)], names=["id", "n", "cls", "keys", "odd"])

    return docs.mapInArrow(sign, "id long, n long, cls string, keys array<bigint>, odd array<bigint>")


def may_be_linked(percent: int) -> Callable[[Column, Column], Column]:
    """Whether sets with these sizes and parities can be linked at all; a null load bounds nothing."""

    def fits(x: Column, y: Column) -> Column:
        apart = reduce(Column.__add__, (F.bit_count(x[f"odd{i}"].bitwiseXOR(y[f"odd{i}"])) for i in range(PARITIES // 64)))
        both = x["n"] + y["n"]
        # At most half of what the sets hold besides their differences is shared, and the smaller set at most.
        shared = F.least((both - F.greatest(apart, F.abs(x["n"] - y["n"]))) / 2, x["n"], y["n"])
        return x.isNull() | y.isNull() | (shared * (100 + percent) >= both * percent)

    return fits


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets have 100 * intersection >= percent * union."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        last, held = None, None
        for b in batches:
            keep = []
            for i, (v, ta, tb) in enumerate(zip(b.column("b").to_pylist(), b.column("ta").to_pylist(), b.column("tb").to_pylist(), strict=True)):
                if last != v:
                    last, held = v, shingler.shingles(tb)
                own = shingler.shingles(ta)
                common_ = len(np.intersect1d(own, held, assume_unique=True))
                if 100 * common_ >= percent * (len(own) + len(held) - common_):
                    keep.append(i)
            if keep:
                yield b.select(["a", "b"]).take(pa.array(keep))

    return both.mapInArrow(check, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, words: int = 5) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row of ``docs``, over whole texts.

    Documents are linked if 100 * intersection >= percent * union of their sets of distinct ``words``-word
    shingles; component_id is the smallest key reachable over links, and the row with that key is kept. Null, empty
    and blank texts have no shingles and are linked with nothing. Rows with equal keys are one document, linked
    with whatever any of them is. A null key is linked with nothing and kept, with a null component. The keys must
    be integers; other columns play no part, and an empty table gives an empty result.
    """
    common.small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    signed = common.store(_fingerprinted(rows, chunks_for(percent / 100), words), "near-signed")
    load = F.struct("n", *[F.get("odd", F.lit(i)).alias(f"odd{i}") for i in range(PARITIES // 64)])
    classes = signed.filter("id is not null and cls is not null").groupBy("cls").agg(F.min("id").alias("rep"), F.first(load).alias("load"), F.first("keys").alias("keys"))
    classes = common.store(classes, "near-classes")
    every = common.store(signed.drop("keys", "odd"), "near-sizes")
    common.discard(signed)
    # An id that stands for several texts has no load, which bounds nothing.
    loads = common.store(classes.groupBy(F.col("rep").alias("id")).agg(F.when(F.count(F.lit(1)) == 1, F.first("load")).alias("load")), "near-loads")
    fits = may_be_linked(percent)

    members = meeting(classes.select(F.col("rep").alias("id"), F.explode("keys").alias("key")), "near")
    texts = common.store(rows.join(members.select("id").distinct(), "id", "left_semi"), "near-texts")

    def check(pairs: DataFrame, name: str) -> DataFrame:
        side = lambda x: loads.select(F.col("id").alias(x), F.col("load").alias(f"l{x}"))
        wanted = pairs.join(side("a"), "a").join(side("b"), "b").filter(fits(F.col("la"), F.col("lb"))).select("a", "b")
        return common.store(_confirmed(wanted, texts, percent, words), name)

    def loaded(apart: DataFrame) -> DataFrame:
        return apart.join(loads, "id")

    links = linked(members, check, "near", fits=fits, tighten=loaded, gradual=True)
    same = classes.select("cls", "rep").join(every.filter("id is not null").select("id", "cls"), "cls").filter("id <> rep").select(F.col("id").alias("u"), F.col("rep").alias("v"))
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(same)
    final = common.store(components(edges), "near-components")
    common.discard(members, texts, loads, classes)
    out = every.select(F.col("id").alias("_id"), F.col("n").alias("n_shingles")).join(final.withColumnRenamed("node", "_id"), "_id", "left")
    component = F.coalesce("component", "_id")
    return out.select(F.col("_id").alias(key), "n_shingles", component.alias("component_id"), F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept"))
