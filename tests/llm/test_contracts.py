"""What the queries promise, row by row, against plain Python over the whole smallest tables."""

import base64
import hashlib
import re
import zlib
from pathlib import Path

import pytest
import tiktoken
from pyspark.sql import functions as F

from quillwort.llm import neardup, queries

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the driver's tables are not here")


def table(spark, name):
    return [r.asDict() for r in spark.read.parquet(f"{DATA}/{name}.parquet").collect()]


def test_fingerprints_and_edited_texts(spark):
    docs = sorted(table(spark, "documents"), key=lambda r: r["doc_id"])
    texts = [r["text"] or "" for r in docs]
    got = {r["doc_id"]: r for r in queries.op1_fingerprint(spark, str(DATA)).collect()}
    assert len(got) == len(docs)
    same = {}
    for i, r in enumerate(docs):
        own, following = texts[i], texts[(i + 1) % len(docs)]
        cut = len(own) // 4
        edited = own[: len(own) - cut] + following[:cut]
        g = got[r["doc_id"]]
        assert g["n_chars"] == len(own) and g["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= g["near_edited"] <= 1 and 0 <= g["near_next"] <= 1
        assert same.setdefault(own, g["fingerprint"]) == g["fingerprint"]
        assert (edited == own) <= (g["near_edited"] == 1.0)


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_components_of_near_duplicates(spark):
    docs = table(spark, "documents")
    sets = {r["doc_id"]: shingles(r["text"]) for r in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in queries.op3_minhash_neardup(spark, str(DATA)).collect()}
    assert got == {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_parities_bound_what_sets_share():
    for n, m, both in ((146, 146, 126), (146, 146, 136), (30, 33, 28), (1000, 900, 880), (5, 5, 5)):
        hashes = [int.from_bytes(hashlib.blake2b(f"{i}".encode(), digest_size=8).digest()) for i in range(n + m - both)]
        import numpy as np

        a, b = np.array(hashes[:n], np.uint64), np.array(hashes[n - both :], np.uint64)
        odd = sum(int(x).bit_count() for x in (neardup.parities(a) ^ neardup.parities(b)).view(np.uint64))
        assert odd <= n + m - 2 * both and len(b) == m


def test_a_crowd_of_near_copies(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        own = list(base)
        for k in range(1 + i % 3):
            own[(i * 7 + k * 19) % 60] = f"x{i}y{k}"
        rows.append((i, " ".join(own)))
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: find(i) for i in sets}


def test_tokens_of_every_text(spark):
    import public_tokenizers
    from tiktoken.load import load_tiktoken_bpe

    own = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(public_tokenizers.path(queries.RANKS)), special_tokens={})
    got = {r["doc_id"]: r for r in queries.op4_byte_bpe(spark, str(DATA)).collect()}
    for r in table(spark, "documents"):
        text = r["text"] or ""
        ids = own.encode_ordinary(text)
        g = got[r["doc_id"]]
        assert g["n_tokens"] == len(ids) and g["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert g["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_scores_have_the_base_of_the_contract(spark):
    import math
    from collections import Counter

    docs = table(spark, "documents")
    tokens = {r["doc_id"]: [w for w in re.split(rb"[\x20\x09-\x0D]+", (r["text"] or "").encode().lower()) if w] + [None] for r in docs}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    got = {r["doc_id"]: r for r in queries.op6_lm_score(spark, str(DATA)).collect()}
    for i, ws in tokens.items():
        g = got[i]
        assert (g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) == (held[i], len(ws), sum(c[w] > 0 for w in ws), n)
        assert g["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
    out = [g for g in got.values() if g["held_out"]]
    assert sum(g["score"] for g in out) > sum(g["base_score"] for g in out)


def test_records_of_every_page(spark):
    pages = table(spark, "pages")
    first = {}
    for r in sorted(pages, key=lambda r: r["page_id"]):
        first.setdefault((r["html"] or "").encode(), r["page_id"])
    want = set()
    for r in pages:
        data = (r["html"] or "").encode()
        own = first[data] == r["page_id"]
        want.add((r["page_id"], len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if own else "revisit", None if own else first[data]))
    got = queries.op7_warc(spark, str(DATA)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(pages)


def test_lines_are_kept_once(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, "documents")}
    got = {r["doc_id"]: (r["text"], r["removed_lines"]) for r in queries.op2_line_dedup(spark, str(DATA)).collect()}
    assert set(got) == set(docs)
    words = lambda line: tuple(w for w in re.split(r"[^0-9a-zªµºÀ-ÖØ-öø-ÿ]+", line.lower()) if w)
    seen = set()
    for i in sorted(docs):
        if docs[i] is None:
            assert got[i] == (None, 0)
            continue
        before, after = docs[i].split("\n"), (got[i][0] or "").split("\n")
        assert got[i][1] == (len(before) - len(after) if got[i][0] or len(before) == got[i][1] + 1 else len(before))
        for line in filter(None, map(words, after if got[i][0] else [])):
            assert line not in seen
            seen.add(line)
    lost = {w for t in docs.values() if t for w in map(words, t.split("\n")) if w} - seen
    # What is gone altogether is a near copy of a line that stays.
    near = lambda a, b: 5 * edits(a, b) <= max(len(a), len(b))
    lengths = {}
    for s in seen:
        lengths.setdefault(len(s), []).append(s)
    group = seen | lost
    for w in lost:
        assert any(x != w and abs(len(x) - len(w)) * 5 <= max(len(x), len(w)) and len(set(x) & set(w)) * 2 >= len(set(w)) and near(x, w) for x in group)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


def test_contaminated_documents_hold_their_item(spark):
    docs = {r["doc_id"]: (r["text"] or "").lower() for r in table(spark, "documents")}
    got = queries.op9_decontamination(spark, str(DATA))
    hit = {r["doc_id"] for r in got.select("doc_id").collect()}
    items = [" ".join((r["text"] or "").lower().split()) for r in table(spark, "benchmark")]
    whole = {i for i, t in docs.items() if any(x and len(x.split()) >= 5 and x in " ".join(t.split()) for x in items)}
    assert whole <= hit
    assert got.filter(F.col("doc_id").isNull()).count() == 0
