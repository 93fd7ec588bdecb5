"""WARC archives: write with revisit records, read back, and merge the captures into one ordered index.

Every archive file yields a run of captures sorted by URL key and timestamp. Runs are dealt out by key ranges;
in each range a k-way loser tree merges the parts of the runs, so the partitions in order hold every URL's
capture history in order.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Capture time of a page without one of its own: this epoch plus its id in seconds.
EPOCH = 1_700_000_000
CAPTURE = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long,"
    " urlkey string, captured long, file string, offset long"
)
#: Records in a file at most, so that a reader holds a bounded file.
RECORDS_PER_FILE = 2_000


def url_key(url: str | None) -> str:
    """Sort-friendly form of a URL: host labels reversed, then path and query, in lower case."""
    if not url:
        return ""
    rest = url.strip().lower().split("#", 1)[0]
    rest = rest.split("://", 1)[1] if "://" in rest else rest
    cut = min([i for i in (rest.find("/"), rest.find("?")) if i >= 0], default=len(rest))
    host, tail = rest[:cut].rsplit("@", 1)[-1], rest[cut:] or "/"
    name, _, port = host.partition(":")
    labels = [x for x in name.split(".") if x]
    if labels[:1] == ["www"]:
        labels = labels[1:]
    return ",".join(reversed(labels)) + (f":{port}" if port and port not in {"80", "443"} else "") + ")" + tail


def sha1_base32(text: Column) -> Column:
    """Upper-case base32 SHA-1 of a text's UTF-8 bytes."""

    @F.pandas_udf("string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([base64.b32encode(hashlib.sha1(x.encode()).digest()).decode() for x in texts])

    return digest(text)


def write(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) to WARC files under ``path``.

    Of rows with equal payloads of at least ``min_bytes`` bytes that with the smallest id becomes a response, and
    the others revisits that refer to it; smaller payloads are all responses. Rows that repeat an id count like
    any others: every row with the smallest id is a response. A null html is an empty payload, a null url leaves
    the target out, and a null id is nobody's smallest: such a row is a response only if its whole group lacks
    ids. The join that finds copies has one row per repeated payload; it is broadcast after its rows are counted.
    """
    common.small_batches(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", sha1_base32(F.col("html"))).withColumn("size", F.octet_length("html"))
    copies = (
        rows.filter(F.col("size") >= min_bytes).groupBy("digest", "size")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    )
    copies = common.store(copies, "warc-copies")
    if copies.count() <= common.BROADCAST_ROWS:
        copies = F.broadcast(copies)
    rows = rows.join(copies, ["digest", "size"], "left")
    again = F.coalesce(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))
    end = F.lit("\r\n")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit("\r\n\r\n"))
    block = F.concat(head, F.when(again, "").otherwise(F.col("html")))
    safe_url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    named = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    when = F.date_format(F.timestamp_seconds(F.lit(EPOCH) + F.coalesce(F.col("page_id"), F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(again, "revisit").otherwise("response"), end,
        F.lit("WARC-Record-ID: "), named(F.col("page_id")), end, F.lit("WARC-Date: "), when, end,
        F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), safe_url, end)).otherwise(""),
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), end,
        F.when(again, F.concat(
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
            named(F.col("first")), end)).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block), end, end,
        block, end,
    )
    # The line separator is the second half of the blank line that ends a record, so the files are plain WARC.
    out = rows.select(record.alias("value")).write.option("lineSep", "\r\n").option("maxRecordsPerFile", RECORDS_PER_FILE)
    out.text(path)


def records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, headers (lower-case names) and block of every record of an uncompressed archive."""
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        if stop < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at:stop].decode().split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        n = int(headers["content-length"])
        if data[stop + 4 + n : stop + 8 + n] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield at, headers, data[stop + 4 : stop + 4 + n]
        at = stop + 8 + n


def _capture(name: str, at: int, headers: dict[str, str], block: bytes) -> dict:
    ident = lambda x: None if x is None or x.endswith(":none>") else int(x.rpartition(":")[2].rstrip(">"))
    head, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":", 1)[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    if headers["warc-type"] == "response" and (len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"{name}: the payload at byte {at} does not match its digest")
    return {
        "page_id": ident(headers["warc-record-id"]), "payload_bytes": length, "payload_digest": digest,
        "record_type": headers["warc-type"], "refers_to": ident(headers.get("warc-refers-to")),
        "urlkey": url_key(headers.get("warc-target-uri")),
        "captured": int(pd.Timestamp(headers["warc-date"]).timestamp()), "file": name, "offset": at,
    }


def _order(x: dict) -> tuple:
    return x["urlkey"], x["captured"], x["page_id"] is not None, x["page_id"] or 0, x["file"], x["offset"]


def read(spark: SparkSession, path: str) -> DataFrame:
    """The captures of the archives under ``path``; those of a file are one run, sorted by URL key and time.

    Lengths and digests of responses are those of the payloads read, and a mismatch with the headers is an error;
    revisits carry the figures of the payload they stand for. Records that repeat keep a row each; a missing target or
    id is an empty key or a null; archives without records give an empty table.
    """
    schema = spark.createDataFrame([], CAPTURE + ", seq long").schema
    arrow = pa.schema([(f.name, pa.int64() if f.dataType.typeName() == "long" else pa.string()) for f in schema])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column("path"), b.column("content"), strict=True):
                short = name.as_py().rsplit("/", 1)[-1]
                run = sorted((_capture(short, *x) for x in records(content.as_buffer().to_pybytes())), key=_order)
                yield pa.RecordBatch.from_pylist([x | {"seq": i} for i, x in enumerate(run)], schema=arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(runs, schema)


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the winner goes up."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs, self.k = runs, max(1, len(runs))
        self.heads = [next(r, None) for r in runs] or [None]
        self.tree = [-1] * self.k
        for i in range(self.k):
            self._enter(i)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or x is not None and (x, a) < (y, b)

    def _enter(self, winner: int) -> None:
        """First fill: a run waits at the first empty node on its way up."""
        node = (winner + self.k) // 2
        while node > 0:
            if self.tree[node] < 0:
                self.tree[node] = winner
                return
            if self._beats(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while (top := self.heads[self.tree[0]]) is not None:
            yield top
            winner = self.tree[0]
            self.heads[winner] = next(self.runs[winner], None)
            node = (winner + self.k) // 2
            while node > 0:
                if self._beats(self.tree[node], winner):
                    self.tree[node], winner = winner, self.tree[node]
                node //= 2
            self.tree[0] = winner


def merge(captures: DataFrame) -> DataFrame:
    """All captures in global order of URL key and time: partitions are key ranges, merged from the runs.

    A range also covers time and id, so one URL with very many captures is split between ranges. A task holds the
    index rows of its range, not the payloads. Captures without a URL or an id come first; equal ones are ordered by
    their file and place, so that all of them stay; an empty table gives an empty one.
    """
    schema = captures.drop("seq").schema
    names = schema.names

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        rows = table.drop_columns("seq").to_pylist()
        runs: dict[str, list[int]] = {}
        for i, x in enumerate(rows):
            runs.setdefault(x["file"], []).append(i)
        tree = LoserTree([((_order(rows[i]), i) for i in own) for own in runs.values()])
        order = [i for _, i in tree]
        for b in table.select(names).take(order).to_batches(max_chunksize=10_000):
            yield b

    dealt = captures.repartitionByRange("urlkey", "captured", "page_id").sortWithinPartitions("file", "seq")
    return dealt.mapInArrow(merged, schema)
