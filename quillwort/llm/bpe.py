"""Byte-level BPE: overlapping chunk encoding, and decoding.

A long text is cut into chunks at fixed offsets. Each chunk finds its pre-tokens on its own, reading some
characters past its end. A scanner of the split pattern depends on nothing but where it stands, so two scanners
that reach the same boundary agree from there on: the pre-tokens of a chunk are used up to the first boundary
that the next chunk also has, and the next chunk's from there. Pieces are then merged by rank.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

CHUNK = 32_768
OVERLAP = 256
#: Pieces whose ids a worker remembers before it starts over.
REMEMBERED = 200_000


@lru_cache(4)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Encoder and decoder of one rank file. Made anew in each Python worker."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        self.find = regex.compile(pattern)
        ranks = _ranks(path)
        self.merge = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._encode_single_piece
        self.bytes: dict[int, bytes] = {v: k for k, v in ranks.items()}
        self.known: dict[str, list[int]] = {}

    def boundaries(self, text: str, start: int, stop: int, end: int) -> list[int]:
        """Where pre-tokens end, for a scanner that starts at ``start``, reads up to ``end`` and goes on past ``stop``.

        Unless ``end`` is the end of the text, a match that touches it may be cut short and is left out, and so
        is one whose next character is the last read, as the pattern looks one character ahead.
        """
        final = end >= len(text)
        out = []
        for m in self.find.finditer(text, start, end):
            if not final and m.end() >= end - 1:
                break
            out.append(m.end())
        return out

    def stitch(self, text: str, parts: list[tuple[int, list[int]]]) -> list[int]:
        """All pre-token ends of ``text`` from (start, ends) of its chunks in order."""
        ends: list[int] = []
        at = 0
        for k, (start, found) in enumerate(parts):
            following = parts[k + 1] if k + 1 < len(parts) else None
            if at != start and at not in set(found):  # no meeting in the overlap: scan on until there is one
                marks = {start, *found}
                for m in self.find.finditer(text, at):
                    ends.append(m.end())
                    at = m.end()
                    if at in marks or following and at >= following[0]:
                        break
                if at not in marks:
                    continue
            meet = {following[0], *following[1]} if following else ()
            for e in found:
                if e > at:
                    ends.append(e)
                    at = e
                if following and at >= following[0] and at in meet:
                    break
        if at < len(text):
            ends.extend(m.end() for m in self.find.finditer(text, at))
        return ends

    def ids(self, piece: str) -> list[int]:
        got = self.known.get(piece)
        if got is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            got = self.known[piece] = self.merge(piece)
        return got

    def encode(self, text: str, ends: list[int] | None = None) -> list[int]:
        """Token ids of a text, by given pre-token ends or by its own scan."""
        out: list[int] = []
        known, ids, extend = self.known, self.ids, out.extend
        pieces = self.find.findall(text) if ends is None else map(lambda a, b: text[a:b], [0, *ends], ends)
        for piece in pieces:
            extend(known.get(piece) or ids(piece))
        return out

    def decode(self, ids) -> bytes:
        """The raw bytes of the tokens, one after the other; ids without a token give none."""
        get = self.bytes.get
        return b"".join([get(i, b"") for i in ids])


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def chunks(length: int, size: int = CHUNK) -> list[int]:
    """Where the chunks of a text of that length start."""
    return list(range(0, max(length, 1), size))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids", size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``df`` with the token ids of each whole text in the array column ``out``, which replaces one of that name.

    Texts of up to ``size`` characters are one chunk and are encoded where they are. Longer ones are dealt out as
    chunk rows, whose pre-tokens are found in parallel, and meet again to be stitched and encoded; only those
    texts are shuffled. A null text counts as empty and has no ids. Every row keeps its own result, also a repeated
    one; an empty table gives an empty one. Names of other columns do not matter.
    """
    common.small_batches(df.sparkSession)
    plain = df.drop(out)
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    is_long = F.length(whole) > size

    @F.pandas_udf("array<int>")
    def short_ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path, pattern)
        for texts in batches:
            yield pd.Series([np.array(own.encode(x), np.int32) for x in texts])

    short = plain.filter(~is_long).withColumn(out, short_ids(whole))

    # A long row is told by its whole content, so equal rows share the work; the copies are counted and given back.
    payload = F.struct(*[F.col(f"`{c}`") for c in plain.columns])
    rows = plain.filter(is_long).select(whole.alias("_t"), payload.alias("_row"))
    dealt = rows.withColumn("_uid", F.expr("uuid()"))
    held = common.store(dealt, "bpe-long")
    cut = held.select(
        "_uid", F.length("_t").cast("long").alias("_len"),
        F.explode(F.expr(f"sequence(0, length(_t) - 1, {size})")).alias("_start"), "_t",
    ).withColumn("_part", F.expr(f"substring(_t, _start + 1, {size + overlap})")).drop("_t")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for b in batches:
            found = []
            for start, n, part in zip(b.column("_start").to_pylist(), b.column("_len").to_pylist(), b.column("_part").to_pylist(), strict=True):
                # a text that goes on is told by one character that the scanner must not reach
                seen = own.boundaries(part + "\0" * (start + len(part) < n), 0, size, len(part))
                found.append([start + e for e in seen])
            yield pa.RecordBatch.from_arrays([b.column("_uid"), pa.array(b.column("_start").to_pylist(), pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["_uid", "_start", "_ends"])

    scanned = cut.repartition("_uid", "_start").mapInArrow(scan, "_uid string, _start long, _ends array<bigint>")
    parts = scanned.groupBy("_uid").agg(F.array_sort(F.collect_list(F.struct("_start", "_ends"))).alias("_parts"))

    @F.pandas_udf("array<int>")
    def long_ids(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        own = codec(path, pattern)
        for texts, found in batches:
            yield pd.Series([np.array(own.encode(t, own.stitch(t, [(p["_start"], list(p["_ends"])) for p in f])), np.int32) for t, f in zip(texts, found, strict=True)])

    joined = held.join(parts, "_uid").select("_row.*", long_ids("_t", "_parts").alias(out))
    return short.unionByName(joined)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes of the tokens in ``ids`` in the binary column ``out``, which replaces one of that name.

    A null list gives no bytes. Every row keeps its own result, also a repeated one; an empty table gives an empty one.
    """
    common.small_batches(df.sparkSession)

    @F.pandas_udf("binary")
    def raw(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path, pattern)
        for lists in batches:
            yield pd.Series([own.decode(x.tolist()) if x is not None else b"" for x in lists])

    return df.withColumn(out, raw(F.col(f"`{ids}`")))
