"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item become candidates by a shared seed, a run of ``min_match`` tokens. For candidates,
the longest matches that overlap nothing marked so far are marked again and again, found by running Karp-Rabin,
down to ``min_match`` tokens. The share of an item's tokens that lies in tiles is its coverage, whatever the order
of its passages in the document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Characters of benchmark text that are broadcast at once; a larger benchmark is taken in blocks.
BLOCK_CHARS = 8_000_000
WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> list[str]:
    """Lower-case runs of letters, digits and underscores."""
    return WORD.findall(text.lower()) if text else []


def _windows(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` ids (Karp-Rabin, the powers summed at once)."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    values = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    for i in range(size):
        out = out * _BASE + values[i : i + n]
    return out


def tile(text: list[int], item: list[int], min_match: int) -> list[tuple[int, int, int]]:
    """Tiles as (start in text, start in item, length), longest first, disjoint on both sides.

    Among matches of one length the first in the item, then the first in the text, is marked first. Ids below 0
    stand for tokens that no item has and match nothing.
    """
    done_t, done_i = [x < 0 for x in text], [x < 0 for x in item]
    tiles: list[tuple[int, int, int]] = []
    mod, base = (1 << 61) - 1, 1_000_003

    def rolling(ids: list[int], done: list[bool], size: int) -> Iterator[tuple[int, int]]:
        """Start and running hash of each unmarked window."""
        top, value, run = pow(base, size, mod), 0, 0
        for i, (x, gone) in enumerate(zip(ids, done, strict=True)):
            if gone:
                value = run = 0
                continue
            value = (value * base + x + 1) % mod
            run += 1
            if run > size:
                value = (value - (ids[i - size] + 1) * top) % mod
            if run >= size:
                yield i - size + 1, value

    size = max(min_match, min(len(item), len(text)))
    while size >= min_match:
        table: dict[int, list[int]] = {}
        for at, value in rolling(item, done_i, size):
            table.setdefault(value, []).append(at)
        found, longest = [], size
        for t, value in rolling(text, done_t, size) if table else ():
            for i in table.get(value, ()):
                n = 0
                while t + n < len(text) and i + n < len(item) and not done_t[t + n] and not done_i[i + n] and text[t + n] == item[i + n]:
                    n += 1
                if n >= size:
                    found.append((-n, i, t))
                    longest = max(longest, n)
        if longest > size:  # a longer match exists: it comes first
            size = longest
            found = [x for x in found if -x[0] == longest]
        marked = False
        for n, i, t in sorted(found):
            n = -n
            if not any(done_t[t : t + n]) and not any(done_i[i : i + n]):
                done_t[t : t + n] = done_i[i : i + n] = [True] * n
                tiles.append((t, i, n))
                marked = True
        if size == min_match and not marked:
            break
        size = max(min_match, size // 2) if size > min_match and not (marked and longest > size) else min_match if size == min_match and marked else size - 1
        if size < min_match:
            break
    return tiles


class Index:
    """The items of a block, their vocabulary, and the seeds with the items and places they occur at."""

    def __init__(self, items: list[tuple[object, str]], min_match: int):
        self.min_match = min_match
        self.vocabulary: dict[str, int] = {}
        self.keys = [k for k, _ in items]
        self.items = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in tokens(t)] for _, t in items]
        seeds, owner, place = [], [], []
        for i, ids in enumerate(self.items):
            got = _windows(np.array(ids, np.int64), self.seed(ids)) if ids else []
            seeds.append(np.asarray(got, np.uint64))
            owner += [i] * len(got)
            place += range(len(got))
        flat = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.seeds, self.owner, self.place = flat[order], np.array(owner, np.int64)[order], np.array(place, np.int64)[order]
        self.sizes = sorted({self.seed(ids) for ids in self.items if ids})

    def seed(self, ids: list[int]) -> int:
        """An item shorter than a seed is its own seed."""
        return min(self.min_match, len(ids))

    def matches(self, text: str | None, threshold: float) -> list[tuple[object, float, int, int]]:
        """(item key, coverage, tiles, tokens in tiles) of the items covered to ``threshold`` or more."""
        words = tokens(text)
        if not words or not len(self.seeds):
            return []
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        hit: dict[int, set[int]] = {}
        for size in self.sizes:
            ok = np.convolve(ids >= 0, np.ones(size, np.int64), "valid") == size if len(ids) >= size else np.zeros(0, bool)
            if not ok.any():
                continue
            seen = np.unique(_windows(ids, size)[ok])
            left, right = np.searchsorted(self.seeds, seen, "left"), np.searchsorted(self.seeds, seen, "right")
            for a, b in zip(left[left < right], right[left < right], strict=True):
                for k in range(a, b):
                    hit.setdefault(int(self.owner[k]), set()).update(range(self.place[k], self.place[k] + size))
        out = []
        for i, covered in sorted(hit.items()):
            item = self.items[i]
            if len(covered) < threshold * len(item):  # tiles consist of seeds, so coverage cannot be higher
                continue
            tiles = tile(ids.tolist(), item, self.seed(item))
            marked = sum(n for _, _, n in tiles)
            if marked >= threshold * len(item):
                out.append((self.keys[i], marked / len(item), len(tiles), marked))
        return out


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[object, str]]]:
    """The benchmark in blocks of bounded size; its total size is taken first."""
    rows = benchmark.select(F.col(f"`{item}`").alias("k"), F.col(f"`{text}`").alias("t")).filter("k is not null and t is not null").distinct()
    total = rows.agg(F.sum(F.length("t") + 16)).first()[0] or 0
    n = max(1, -(-total // BLOCK_CHARS))
    for i in range(n):
        yield sorted((r["k"], r["t"]) for r in rows.filter(F.pmod(F.xxhash64("k", "t"), F.lit(n)) == i).collect())


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", min_match: int = 5, threshold: float = 0.6,
) -> DataFrame:
    """Pairs (key, item_id, coverage, tiles, matched) of documents and items covered to ``threshold`` or more.

    The benchmark is the stated query set: it is taken against all documents, in blocks of bounded size that are
    broadcast. Texts are used whole, and documents need no shuffle. Items with a null key or text, or without
    tokens, match nothing, and neither do null or empty documents; rows that repeat give repeated pairs, repeated
    items one. Other columns of either table play no part. An empty table on either side gives no pairs.
    """
    spark: SparkSession = docs.sparkSession
    common.small_batches(spark)
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).filter("text is not null")
    kind = benchmark.schema[item].dataType
    out: DataFrame | None = None
    for block in _blocks(benchmark, item, item_text):
        shared = spark.sparkContext.broadcast(block)
        made = spark.createDataFrame([], f"item_id {kind.simpleString()}, coverage double, tiles int, matched int").schema
        schema = type(made)([rows.schema["doc_id"], *made.fields])

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, min_match)
            for b in batches:
                at, got = [], []
                for i, x in enumerate(b.column("text").to_pylist()):
                    for m in index.matches(x, threshold):
                        at.append(i)
                        got.append(m)
                if at:
                    columns = [pa.array([m[j] for m in got]) for j in range(4)]
                    columns[2:] = [c.cast(pa.int32()) for c in columns[2:]]
                    yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(at)), *columns], names=["doc_id", "item_id", "coverage", "tiles", "matched"])

        part = rows.mapInArrow(find, schema)
        out = part if out is None else out.unionByName(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that cover a benchmark item; all columns, and rows with a null key, stay."""
    bad = contamination(docs, benchmark, key=key, **options).select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(bad, docs[key] == bad["_leak"], "left_anti")
