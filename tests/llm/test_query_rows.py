"""Whole rows of the registered queries on the smallest test tables, against independent versions."""

from __future__ import annotations

import hashlib
import math
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from paylater.llm import secret_scan
from paylater.llm.queries import QUERIES
from paylater.llm.vocabulary import public_path
from tests.llm.test_operators import brute_components, brute_repeats, brute_secrets, brute_top

SF = "/root/testdata/sf0.001"


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def result(spark, name):
    return QUERIES[name](spark, SF).collect()


def test_op1(spark, texts):
    want = {}
    for i, (n, kept, spans) in brute_repeats(texts, 100).items():
        want[i] = (n, n - len(kept), spans, sha(kept))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in result(spark, "op1_suffix_dedup")}
    assert got == want and any(n for _, n, _, _ in want.values())


def test_op2(spark):
    rows = {}
    for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect():
        if r.embedding is not None and all(x is not None and math.isfinite(x) for x in r.embedding):
            rows[r.vec_id] = [math.floor(1024 * x) for x in r.embedding]
    queries = {i: v for i, v in rows.items() if i % 100 == 0}
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in result(spark, "op2_topk_search")]
    assert len(got) == 10 * len(queries) and set(got) == brute_top(queries, rows, 10)


def order_min_hash(body: bytes) -> list[str]:
    """Two smallest of the occurrence-numbered 16-byte strings in each of 64 ranges of hashes, hashed in text order."""
    if not body:
        return []
    high = lambda h: h >> 26
    seen, ranges = Counter(), defaultdict(list)
    for at in range(max(1, len(body) - 15)):
        h = high(xxhash.xxh64_intdigest(body[at:at + 16], 42))
        n, seen[h] = seen[h], seen[h] + 1
        if n:
            h = high(chain(h, n))
        ranges[h >> 32].append((h, at))
    out = []
    for number, elements in sorted(ranges.items()):
        in_order = sorted(sorted(elements)[:2], key=lambda e: e[1])
        out.append(f"{number:02X}{chain(*(h for h, _ in in_order), longs=True):016X}"[:10])
    return out


def chain(first: int, second: int | None = None, longs: bool = False) -> int:
    h = xxhash.xxh64_intdigest(struct.pack("<q", first), 42)
    return h if second is None else xxhash.xxh64_intdigest(struct.pack("<q" if longs else "<i", second), h)


def test_op3(spark, texts):
    ids, want = sorted(texts), {}
    alike = lambda a, b: (math.sqrt(len(set(a) & set(b)) / len({c[:2] for c in a + b})) if a + b else 1.0)
    for i, j in zip(ids, ids[1:] + ids[:1]):
        half = len(texts[i]) // 2
        edited = texts[i][:len(texts[i]) - half] + texts[j][:half]
        mine, other, after = (order_min_hash(t.encode()) for t in (texts[i], edited, texts[j]))
        want[i] = (len(texts[i]), sha(edited), sorted(mine), sorted(other), alike(mine, other), alike(mine, after))
    cut = lambda s: sorted(s[k:k + 10] for k in range(0, len(s), 10))
    got = {r.doc_id: (r.n_chars, r.edited_sha256, cut(r.fingerprint), cut(r.edited_fingerprint),
                      r.near_edited, r.near_next) for r in result(spark, "op3_fingerprints")}
    assert set(got) == set(want)
    for i in ids:
        assert got[i][:4] == want[i][:4], i
        assert got[i][4:] == pytest.approx(want[i][4:])


def test_op5(spark, texts):
    library = Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    library.no_truncation()
    want = {}
    for i, t in texts.items():
        ids = library.encode(t, add_special_tokens=False).ids
        want[i] = (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False)))
    assert {r.doc_id: tuple(r[1:]) for r in QUERIES["op5_bpe"](spark, SF).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()} == want


def test_op6(spark, texts):
    names, want = ("assign", "access", "hex"), {}
    for i, t in texts.items():
        base = brute_secrets(t)
        count = Counter(kind for _, kind, _ in base)
        line = ",".join(f"{names[kind]}:{start}:{end}" for start, kind, end in base)
        want[i] = (count[0], count[1], count[2], sha(line), set(filter(None, line.split(","))))
    for r in result(spark, "op6_secret_scan"):
        *digest, base = want.pop(r.doc_id)
        assert [r.n_assign, r.n_access, r.n_hex, r.base_sha256] == digest
        spans = [s.split(":") for s in filter(None, r.spans.split(","))]
        assert base <= {":".join(s) for s in spans}
        assert all(kind in (*names, "value") and 0 <= int(a) < int(b) <= len(texts[r.doc_id]) for kind, a, b in spans)
        assert [int(s[1]) for s in spans] == sorted(int(s[1]) for s in spans)
    assert not want


def packed(rows, texts):
    """Holds the pieces of ``op9`` or of the pipeline against whole encodings of the texts."""
    library = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for i, t in texts.items():
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for start, length, crc, whole in sorted(pieces[i]):
            assert (start, whole, crc) == (at, len(ids), zlib.crc32(ids[at:at + length].tobytes())) and length > 0
            at += length
        assert at == len(ids)
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 4096


def test_op9(spark, texts):
    packed(result(spark, "op9_packing"), texts)


def test_op10(spark, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in result(spark, "op10_ngram_jaccard_join")}
    assert got == brute_components(texts) and any(i != c for i, (_, c) in got.items())


def test_pipeline(spark, texts):
    """Each stage on what the one before it keeps."""
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = lambda df: {r.doc_id: r.text or "" for r in df.collect()}

    docs = stages["toxicity"](spark, docs, SF)
    kept = held(docs)
    rejected = {r.doc_id for r in result(spark, "op4_toxicity") if r.predicted == 1}
    assert kept == {i: t for i, t in texts.items() if i not in rejected}

    source = {r.doc_id: r.source for r in docs.collect()}
    sites = defaultdict(set)
    for i, t in kept.items():
        for line in t.split("\n"):
            sites[line] |= {source[i]} - {None}
    docs = stages["line_dedup"](spark, docs, SF)
    cut = held(docs)
    for i, t in kept.items():
        assert cut[i] == "\n".join(x for x in t.split("\n") if not x or len(sites[x]) < 8), i

    groups = brute_components(cut)
    docs = stages["ngram_jaccard_join"](spark, docs, SF)
    single = held(docs)
    assert single == {i: t for i, t in cut.items() if groups[i][1] == i}

    docs = stages["secret_scan"](spark, docs, SF)
    masked = held(docs)
    assert set(masked) == set(single)
    for i, t in masked.items():
        assert not brute_secrets(t), i
        if not secret_scan.find(single[i]):
            assert t == single[i], i
    assert masked != single
    packed(corpus_pipeline.run(spark, SF).collect(), masked)
