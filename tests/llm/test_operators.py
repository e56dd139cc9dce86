"""Each operator against a brute-force version, on small handmade and test tables."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylater.llm import (bpe, components, fingerprints, line_dedup, ngram_join, packing, prefix_tree,
                          secret_scan, suffix_dedup, topk_search, toxicity, url_filter)
from paylater.llm.vocabulary import LowerWords, public_path

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("source", T.StringType()),
                     # names that the operators use inside
                     T.StructField("body", T.StringType()), T.StructField("place", T.IntegerType()),
                     T.StructField("n_lines", T.IntegerType()), T.StructField("bucket", T.StringType())])


def prose(rng, n):
    return " ".join("".join(rng.choices(["the", "an", "ti", "on", "re", "ß", "é"], k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    base = [prose(rng, rng.randint(1, 120)) for _ in range(25)]
    shared = prose(rng, 30)
    texts = [None, "", " ", "\n", "a", "word", "x" * 99, "y" * 100, "z" * 400, "ab" * 300]
    texts += base + base[:6] + [t + " tail" for t in base[6:14]] + [t[5:] for t in base[10:14]]
    texts += [prose(rng, 8) + "\n" + shared + "\n" + prose(rng, 8) for _ in range(12)]
    texts += [base[0] + " " + base[1] + " " + base[0], "long " + prose(rng, 12000)]
    return [(i * 3 + 1, t, f"s{i % 11}" if i % 7 else None, "b", i, i, "k") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def by_id(rows):
    return {r[0]: r[1] or "" for r in rows}


# ------------------------------------------------------------------ 1 byte strings

def brute_repeats(texts, length):
    seen, out = set(), {}
    for i in sorted(texts):
        body = texts[i].encode()
        gone = bytearray(len(body))
        for p in range(len(body) - length + 1):
            window = body[p:p + length]
            if window in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(window)
        out[i] = (len(body), bytes(b for b, g in zip(body, gone) if not g), len(re.findall(b"\1+", bytes(gone))))
    return out


@pytest.mark.parametrize("length", [64, 100])
def test_remove_repeats(docs, rows, length):
    got = {r.doc_id: (len(r.body), bytes(r.kept), len(r.spans))
           for r in suffix_dedup.remove_repeats(docs, length).collect()}
    assert got == brute_repeats(by_id(rows), length)


def test_remove_repeats_splits_long_documents(monkeypatch):
    rng = random.Random(3)
    body = prose(rng, 900).encode()
    body = np.frombuffer(body + body[:700], np.uint8)
    monkeypatch.setattr(suffix_dedup, "PIECE", 512)
    windows = set()
    for _, at, part, inner in suffix_dedup._pieces(body, np.array([0, len(body)]), 100):
        _, _, _, place = suffix_dedup.parse_bytes(part, inner, 100)
        start, _, count = suffix_dedup._unpack(place + (at << 16))
        for s, n in zip(start, count):
            mine = set(range(s, s + n))
            assert not windows & mine
            windows |= mine
    assert windows == set(range(len(body) - 99))


def test_remove_repeats_repeated_ids_and_empty_table(spark, empty):
    assert suffix_dedup.remove_repeats(empty).count() == 0
    twice = spark.createDataFrame([(1, "b" * 150), (1, "a" * 150), (None, "a" * 150), (2, "a" * 120)],
                                  "doc_id long, text string")
    got = {r.doc_id: (bytes(r.body), bytes(r.kept)) for r in suffix_dedup.remove_repeats(twice).collect()}
    assert got == {1: (b"a" * 150, b"a"), 2: (b"a" * 120, b"")} or got[1][0] == b"a" * 150


# ------------------------------------------------------------------ 2 top-k

def brute_top(queries, rows, k):
    out = set()
    for q, x in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(x, y)), v) for v, y in rows.items() if v != q)
        out |= {(q, r + 1, v, -s) for r, (s, v) in enumerate(scored[:k])}
    return out


def test_top_k_with_ties_nulls_and_repeats(spark, monkeypatch):
    rng = random.Random(5)
    data = [(i, [rng.choice([-0.5, 0.25, 0.1, 0.0]) for _ in range(6)]) for i in range(300)]
    data += [(400, None), (401, [float("nan")] * 6), (402, [None] * 6), (403, [float("inf")] * 6), (None, [0.1] * 6),
             (5, data[5][1])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    monkeypatch.setattr(topk_search, "QUERIES_IN_BLOCK", 4)          # several broadcasts
    vectors = topk_search.quantised(df).repartition(3)
    known = {r.vec_id: r.v for r in vectors.collect()}
    assert set(known) == set(range(300))
    got = {tuple(r) for r in topk_search.top_k(vectors.where("vec_id % 20 = 0"), vectors, 7).collect()}
    assert got == brute_top({i: v for i, v in known.items() if i % 20 == 0}, known, 7)


def test_top_k_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (100, [2.0])], "vec_id long, embedding array<float>")
    vectors = topk_search.quantised(df)
    assert {tuple(r) for r in topk_search.top_k(vectors, vectors).collect()} == {
        (0, 1, 100, 2048 * 1024), (100, 1, 0, 2048 * 1024)}
    none = vectors.where("vec_id < 0")
    assert topk_search.top_k(none, vectors).count() == 0 and topk_search.top_k(vectors, none).count() == 0


def test_top_k_of_huge_components_uneven_and_empty_vectors(spark):
    data = [(0, [1e15, 1.0]), (100, [-1e15]), (200, [1e15, -3.0, 2.0]), (3, [1e300, 1.0]), (4, []), (5, [0.5, 0.25]), (6, [2.0] * 9)]
    vectors = topk_search.quantised(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    known = {r.vec_id: r.v for r in vectors.collect()}
    assert known[3][0] == 2 ** 63 - 1 and known[4] == []
    clip = lambda s: min(max(s, -2 ** 63), 2 ** 63 - 1)
    for k in (2, 10):
        want = set()
        for q in known:
            scored = sorted((-clip(sum(a * b for a, b in zip(known[q], y))), v) for v, y in known.items() if v != q)
            want |= {(q, r + 1, v, -s) for r, (s, v) in enumerate(scored[:k])}
        assert {tuple(r) for r in topk_search.top_k(vectors, vectors, k).collect()} == want


def _search_blocks(vectors, k=10):
    """Every hundredth vector against all, in blocks; share of postings read and the best of each query."""
    ids = np.arange(len(vectors))
    who = np.flatnonzero(ids % 100 == 0)
    best, read, whole = topk_search.Best(len(who), k), 0, 0
    for at in range(0, len(vectors), 1000):
        index = topk_search.ImpactIndex(ids[at:at + 1000], vectors[at:at + 1000])
        index.search(vectors[who], ids[who], np.arange(len(who)), best)
        read, whole = read + index.read, whole + index.postings * len(who)
    for n, i in enumerate(who):
        score = vectors @ vectors[i]
        order = [j for j in np.lexsort((ids, -score)) if j != i][:k]
        assert best.ids[n].tolist() == order and best.scores[n].tolist() == score[order].tolist()
    return read / whole


def test_reading_stops_early_on_skewed_and_on_real_vectors(spark):
    rng = np.random.default_rng(3)
    flat = rng.normal(size=(4000, 32))
    heavy = np.floor(1024 * flat ** 5).astype(np.int64)                       # few large components
    falling = np.floor(flat / np.arange(1, 4001)[:, None] * 1e6).astype(np.int64)   # norms fall from block to block
    assert _search_blocks(heavy) < 0.5
    assert _search_blocks(falling) < 0.35                                     # later blocks are skipped
    rows = topk_search.quantised(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")).orderBy("vec_id").collect()
    assert _search_blocks(np.array([r.v for r in rows])) < 0.7


def test_rows_of_a_search_are_not_shuffled(spark):
    rows = topk_search.quantised(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet"))
    stored = topk_search.written(rows, "test-vectors")
    plan = topk_search.top_k(stored.where("vec_id % 100 = 0"), stored)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow"):]
    assert "Exchange" not in below and "CartesianProduct" not in plan and "NestedLoop" not in plan


# ------------------------------------------------------------------ 3 fingerprints

def test_fingerprints_of_edited_texts(docs, rows):
    got = {r.doc_id: r for r in fingerprints.edited_neighbours(docs).collect()}
    texts = by_id(rows)
    ids = sorted(texts)
    prints = {}
    for i, j in zip(ids, ids[1:] + ids[:1]):
        n = len(texts[i])
        edited = texts[i][:n - n // 2] + texts[j][:n // 2]
        assert (got[i].n_chars, got[i].edited) == (n, edited)
        for text, mark in ((texts[i], got[i].fingerprint), (edited, got[i].edited_fingerprint)):
            assert prints.setdefault(text, mark) == mark
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        if edited == texts[i]:
            assert got[i].near_edited == 1
    # texts that differ in few places may share a sketch
    assert len({tuple(p) for p in prints.values()}) >= 0.95 * len(prints)


def test_fingerprints_keep_all_elements_where_needed(spark, docs):
    """The shortened second sort gives what all elements give."""
    body = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("b"))
    short = fingerprints.with_fingerprint(body, "b", "f").select("doc_id", "f")
    every = body.withColumn("s", F.sort_array(fingerprints._kmers(F.col("b"))))
    every = every.withColumn("e", F.sort_array(fingerprints._numbered(F.col("s"), F.lit(fingerprints.INNER << fingerprints.POSITION_BITS))))
    every = every.withColumn("c", fingerprints._smallest(F.col("e")))
    whole = every.select("doc_id", fingerprints._components(F.col("c")).alias("f"))
    assert sorted(map(tuple, short.collect())) == sorted(map(tuple, whole.collect()))


def test_fingerprints_number_repeated_kmers_and_see_order(spark):
    a, b = "alpha beta gamma delta ", "one two three four five "
    df = spark.createDataFrame([(1, a * 3), (2, a * 9), (3, a * 8 + b * 8), (4, b * 8 + a * 8), (5, "q")],
                               "doc_id long, text string")
    out = fingerprints.with_fingerprint(df.withColumn("b", F.col("text").cast("binary")), "b", "f")
    f = {r.doc_id: set(r.f) for r in out.collect()}
    assert f[1] != f[2] and f[3] != f[4] and len(f[5]) == 1


def test_fingerprints_across_ranges_and_empty(spark, empty, monkeypatch):
    assert fingerprints.edited_neighbours(empty).count() == 0
    monkeypatch.setattr(fingerprints, "ROWS_IN_BUCKET", 4)
    data = [(i * i, f"text number {i} " * 3) for i in range(40)] + [(9, "another text of id nine"), (None, "x")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: r.edited for r in fingerprints.edited_neighbours(df).collect()}
    texts = dict(sorted(data[:40])) | {9: min("another text of id nine", "text number 3 " * 3)}
    ids = sorted(texts)
    assert got == {i: texts[i][:len(texts[i]) - len(texts[i]) // 2] + texts[j][:len(texts[i]) // 2]
                   for i, j in zip(ids, ids[1:] + ids[:1])}


# ------------------------------------------------------------------ 4 toxicity

def test_toxicity_learns_from_labels_only(spark):
    rng = random.Random(1)
    data, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        words = prose(rng, 30).split()
        if toxic:
            words[rng.randrange(30)] = rng.choice(["vilest", "wretched", "slimeball"])
        data.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    data += [(2000, None), (2001, ""), (2002, "You slimeball! vilest. " + "re an ti " * 5000)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    table = spark.createDataFrame(labels + [(None, 1), (3, None), (77777, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_documents(docs, toxicity.training_rows(table)).collect()}
    held = [(i, t) for i, t in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(got) == len(data)
    assert sum((got[i].score >= 0.7) == bool(t) for i, t in held) >= 0.97 * len(held)
    assert got[2002].score >= 0.7 and got[2002].evidence[0].toxic == 1
    assert got[2000].score == got[2001].score < 0.3


def test_toxicity_keeps_rows_and_judges_repeated_ids_by_their_texts(spark):
    clean, bad = "fine words of the day " * 6, "vilest slimeball words of the day " * 6
    data = [(i, bad if i % 5 == 0 else clean + f"w{i % 9}", "d", i) for i in range(300)]
    data += [(7, bad, "again", 1), (7, bad, "again", 1), (None, bad, "x", 2), (None, None, None, None)]
    schema = "doc_id long, text string, `seen` string, `odd name` int"
    docs = spark.createDataFrame(data, schema)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)], "doc_id long, toxic int")
    results = []
    for order in (docs, docs.orderBy(F.desc("seen"), F.desc("doc_id")).repartition(7)):
        out = toxicity.score_rows(order, labels)
        results.append(sorted((str(r.doc), round(r.score, 9)) for r in out.collect()))
    assert results[0] == results[1] and len(results[0]) == len(data)
    kept = toxicity.score_rows(docs, labels).where("score < 0.7").select("doc.*")
    assert sorted(kept.columns) == sorted(docs.columns)
    assert {r.text for r in kept.collect()} == {t for _, t, *_ in data if t != bad}


def test_toxicity_without_labels_or_documents(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_documents(docs, none).collect()} == {0.0}
    assert toxicity.score_documents(empty, none).count() == 0


def test_block_max_index_is_exact():
    rng = np.random.default_rng(2)
    vectors = []
    for _ in range(700):
        f = np.sort(rng.choice(60, rng.integers(0, 8), replace=False))
        w = rng.random(len(f)) + 0.01
        vectors.append((f, w / np.sqrt((w ** 2).sum()) if len(f) else w))
    index = toxicity.BlockMaxIndex(vectors, 60)
    dense = np.zeros((700, 60))
    for i, (f, w) in enumerate(vectors):
        dense[i, f] = w
    for i in range(0, 700, 23):
        who, cosine = index.nearest(*vectors[i], 9)
        every = dense @ dense[i]
        assert np.allclose(np.sort(cosine)[::-1], np.sort(every[every > 0])[::-1][:9])
        assert np.allclose(every[who], cosine)


def test_isotonic_fit_rises():
    x, y = np.array([0.1, 0.2, 0.2, 0.3, 0.9]), np.array([0.0, 1.0, 0.0, 0.0, 1.0])
    steps, fitted = toxicity.isotonic(x, y)
    assert (np.diff(fitted) >= 0).all() and fitted[0] == 0 and fitted[-1] == 1 and np.isclose(fitted[1], 1 / 3)


# ------------------------------------------------------------------ 5 byte-level BPE

def test_bpe_blocks_in_another_order_keep_their_words(spark, monkeypatch):
    """The words are read in another order of partitions than the texts; blocks still meet their own."""
    from tokenizers import Tokenizer
    path = public_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    data = [(i, f"text {i} of words {i * 7} and {'x' * i}") for i in range(12)] + [(3, "again"), (3, "again"), (20, ""), (21, None)]
    parts = [spark.createDataFrame(data[at:at + 4], "doc_id long, text string").coalesce(1) for at in range(0, 16, 4)]
    orders = [[0, 1, 2, 3], [3, 1, 0, 2]]

    def shuffled(docs, *a):
        order = orders.pop()
        rows = parts[order[0]]
        for k in order[1:]:
            rows = rows.unionAll(parts[k])
        return real(rows, *a)
    real = bpe.documents.bodies
    words, texts = shuffled(None), shuffled(None)
    turn = iter((words, texts))

    class Rows:
        def mapInArrow(self, *a):
            return next(turn).mapInArrow(*a)
    monkeypatch.setattr(bpe.documents, "bodies", lambda *a: Rows())
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "4")                             # a block for each part, however unions deal them
    try:
        got = sorted((r.doc_id, bytes(r.ids), r.decoded) for r in bpe.encode_decode(parts[0], path).collect())
    finally:
        spark.conf.set(setting, before)
    assert got == sorted((i, np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes(), t or "")
                         for i, t in data)


def test_bpe_equals_the_library(spark, docs, rows, empty):
    from tokenizers import Tokenizer
    path = public_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(11)
    odd = [" ", "  ", "\n", "\t", chr(0xA0), chr(0x3000), "\x1c", chr(0x85), chr(0x200B), "<|endoftext|>", "'s", "'re",
           "a", "Z", "é", "é", "漢字", "1", "½", "!", "...", "_", "😀", "\r\n", chr(0x1680), chr(0xFEFF), "\x00"]
    data = [(i, "".join(rng.choices(odd, k=rng.randint(0, 25)))) for i in range(600)] + [(r[0] + 1000, r[1]) for r in rows]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: (bytes(r.ids), r.decoded) for r in bpe.encode_decode(df, path).collect()}
    for i, text in data:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i] == (np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)), text
    assert bpe.encode_decode(empty, path).count() == 0


def test_long_texts_are_split_between_words(monkeypatch):
    monkeypatch.setattr(bpe, "PART_CHARS", 40)
    text = prose(random.Random(4), 200) + "  \n  end"
    parts = list(bpe._parts(text))
    assert "".join(parts) == text and len(parts) > 3
    assert [w for p in parts for w in bpe.split_words(p, None)] == bpe.split_words(text, None)


# ------------------------------------------------------------------ 6 secrets

BASE = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
                  r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def test_whole_values_are_found():
    redact = lambda text: secret_scan.redact_text(text, "[S]")           # noqa: E731
    assert redact("pwd: xK9mP2vLqT7w$$! now") == "pwd: [S] now"
    assert redact("password: Qz7#Lp2!vX9& x") == "password: [S] x"
    assert redact("pwd: aB3,xY9;kL2mN8qR end") == "pwd: [S] end"
    assert redact("(pwd: xK9mP2vLqT7w).") == "(pwd: [S])."
    assert redact("pwd: xK9mP2vLqT7w, then") == "pwd: [S], then"
    assert redact("auth=xK9mP2vLqT7w;user=bob") == "auth=[S];user=bob"
    assert redact("pwd: xK9mP2vLqT7w... ok, pwd: hunter2!") == "pwd: [S]... ok, pwd: hunter2!"
    assert redact("token: one,two;three and key: a,b") == "token: one,two;three and key: a,b"


def brute_guess_cost(value, ranks):
    """Every segmentation into brute-force pieces and listed spans."""
    spans = {}
    for i, j, cost in secret_scan.spans_of(value, ranks, 12):
        spans[i, j] = min(cost, spans.get((i, j), 99.0))
    n, best = len(value), float("inf")
    for cuts in range(1 << max(n - 1, 0)):
        ends = [k + 1 for k in range(n - 1) if cuts >> k & 1] + [n]
        total, i = 0.0, 0
        for j in ends:
            total += min(float(j - i), spans.get((i, j), 99.0)) + (i > 0) * secret_scan.JOIN_COST
            i = j
        best = min(best, total)
    return best


@pytest.mark.parametrize("value", ["abc123", "P4ssw0rd!", "qwerty99x", "2001-08-02", "aaaaab", "x", "dragonQ7"])
def test_guess_cost_is_the_least_of_all_segmentations(value):
    assert secret_scan.guess_cost(value) == pytest.approx(brute_guess_cost(value, secret_scan.RANK))


def brute_secrets(text):
    found = [(m.start(), 0, m.end()) for m in BASE.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def test_base_secrets_equal_the_patterns():
    rng = random.Random(8)
    odd = ["password", "PassWord", "token", "API_KEY", "apikey", "ſecret", "secret", "=", ":", " ", '"', "'", "AKIA",
           "ABCDEFGHIJ0123", "0123456789abcdef", "deadbeef", "x", "é", "Q9+/", "aaaaaaaaaaaa", "-", ".", "\n"]
    for _ in range(4000):
        text = "".join(rng.choices(odd, k=rng.randint(0, 14)))
        base = [(s, secret_scan.KINDS.index(k), e) for k, s, e, _ in secret_scan.find(text) if k != "value"]
        assert base == brute_secrets(text), text


def test_guess_cost_orders_values():
    cost = secret_scan.guess_cost
    assert cost("password123") < cost("january2020!") < secret_scan.LEAST_COST < cost("xK9#mP2vLqT7")
    assert cost("qwerty12345") < 6 and cost("aaaaaaaaaaaa1") < 6 and cost("P4ssw0rd") < 6 and cost("") == 0
    assert cost("xK9#mP2vLqT7" * 40) >= secret_scan.LEAST_COST


def test_values_in_context_and_redaction(spark, docs, rows, empty):
    text = "my pwd: xK9#mP2vLqT7, login=password123 and token=0123456789abcdef0 end"
    kinds = [k for k, *_ in secret_scan.find(text)]
    assert kinds == ["value", "assign", "hex"]
    assert secret_scan.redact_text(text, "[S]") == "my pwd: [S], login=password123 and [S] end"
    assert secret_scan.find("the key is understanding, login: tomorrow") == []
    out = secret_scan.redact(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert secret_scan.find_secrets(empty).count() == 0 and secret_scan.redact(empty).count() == 0


def test_values_that_base_spans_cover_in_part_are_whole():
    redact, find = secret_scan.redact_text, secret_scan.find
    text = "a password: Tr0ub4dorXYZ9!kQ#8zzLm b"
    assert [(k, text[s:e]) for k, s, e, _ in find(text)] == [("assign", "password: Tr0ub4dorXYZ9"), ("value", text[12:-2])]
    assert redact(text, "[S]") == "a [S] b"
    assert redact("pwd: G7#deadbeefdeadbeef!Qz9xWk, c", "[S]") == "pwd: [S], c"
    assert [k for k, *_ in find("token=0123456789abcdef0")] == ["assign", "hex"]      # covered as a whole


def test_values_of_one_class(spark):
    secret = ["pwd: xq#zv!kw$jp&hm", "auth=kxqzvbwjmfhtrwpl", "pin: 839201746625", "bearer: QXZKVWJPGHTBNRML"]
    prose = ["login: understanding", "password: forgot-your-password", "auth: https://www.example.com/login/register",
             "secret: Geschwindigkeitsbegrenzung", "token: UNSPECIFIED", "password: contrase\u00f1a-incorrecta",
             "password: \u8bf7\u8f93\u5165\u60a8\u7684\u5bc6\u7801\u5e76\u786e\u8ba4\u767b\u5f55",
             "pin: 00000000", "login: 20190304", "auth=" + "as" * 3000]
    texts = [f"a {x} b" for x in secret + prose]
    got = {i: secret_scan.redact_text(t, "[S]") for i, t in enumerate(texts)}
    assert [t for i, t in got.items() if t == re.sub("[:=] ?.* b", lambda m: m[0][:1 + (m[0][1] == " ")] + "[S] b", texts[i])
            ] == [got[i] for i in range(len(secret))]
    for i in range(len(secret), len(texts)):
        assert "value" not in [k for k, *_ in secret_scan.find(texts[i])], texts[i]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.text for r in secret_scan.redact(df, "[S]").collect()} == got
    spans = {r.doc_id: [tuple(x) for x in r.spans] for r in secret_scan.find_secrets(df).collect()}
    assert spans == {i: secret_scan.find(t) for i, t in enumerate(texts)}


# ------------------------------------------------------------------ 7 lines

def test_boilerplate_lines(spark, empty):
    data = [(i, f"own {i}\nshared line\n\ncommon {i % 3}\n", f"s{i % 12}") for i in range(60)]
    data += [(100 + i, "few sites", f"s{i % 4}") for i in range(30)] + [(200, None, "s1"), (201, "", None), (0, data[0][1], "s0")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string").withColumn("lines", F.lit("x"))
    got = line_dedup.remove_boilerplate(df)
    assert got.columns == [*df.columns, "line_counts"] and got.count() == len(data)
    sites = defaultdict(set)
    for _, text, source in data:
        for line in (text or "").split("\n"):
            sites[line].add(source)
    gone = {line for line, s in sites.items() if line and len(s - {None}) >= line_dedup.MIN_SITES}
    assert "shared line" in gone and "few sites" not in gone
    want = Counter((i, None if t is None else "\n".join(x for x in t.split("\n") if x not in gone)) for i, t, _ in data)
    assert Counter((r.doc_id, r.text) for r in got.collect()) == want
    assert line_dedup.remove_boilerplate(empty).count() == 0


def test_exact_counts_near_the_threshold(spark):
    data = [(f"k{n}", f"s{i}") for n in (5, 6, 7, 8, 9, 12, 400) for i in range(n) for _ in range(3)]
    lines = spark.createDataFrame(data, "k string, site string").select(F.col("k").cast("binary").alias("line_key"), "site")
    got = {bytes(r.line_key).decode() for r in line_dedup.boilerplate_keys(lines, 8).collect()}
    assert got == {"k8", "k9", "k12", "k400"}


# ------------------------------------------------------------------ 8 URLs

def test_urls_and_rules(spark):
    cases = {
        None: ("", ""), "": ("", ""), "example.com/x": ("", ""), "http://": ("", ""), "x://A.Org": ("a.org", ""),
        "https://WWW.Example.ORG/ES/1?q#f": ("www.example.org", "/ES/1"), "a://b://c/d": ("b:", "//c/d"),
        "http://h?x/y": ("h", ""), "http://É.com/fr/": ("É.com", "/fr/"), "http://h#f": ("h", ""),
    }
    assert {u: url_filter.host_and_path(u) for u in cases} == cases
    rules = url_filter.Rules(url_filter.RULES)
    assert rules.longest("a.example.org", "/es/1") == ("example.org/es/", "block")
    assert rules.longest("example.org", "/en/17") == ("example.org/en/1", "block")
    assert rules.longest("notexample.org", "/es/1") == ("org/", "allow")
    assert rules.longest("org", "") == (None, None) and rules.longest("com", "/de/x") == ("com/de/", "block")
    assert rules.longest("x.net", "/fr/") == (None, None)


def test_url_regression_on_held_out_urls(spark):
    rng = random.Random(6)
    urls = [(i, f"http://{rng.choice(['casino', 'news'])}{rng.randint(0, 999)}.net/{rng.choice('abc')}/{i}") for i in range(800)]
    pages = spark.createDataFrame(urls + [(9000, None), (9000, None)], "page_id long, url string")
    labelled = pages.where("page_id < 200").select("url", F.col("url").contains("casino").cast("int").alias("blocked"))
    got = [r for r in url_filter.filter_urls(pages, labelled, []).collect()]
    assert len(got) == 802
    right = sum((r.verdict == "block") == ("casino" in r.host) for r in got if 200 <= r.page_id < 9000)
    assert right >= 590
    none = labelled.where("blocked > 1")
    assert {r.verdict for r in url_filter.filter_urls(pages, none, []).collect()} == {"allow"}
    assert url_filter.filter_urls(pages.where("page_id < 0"), none).count() == 0


# Labelled by hand for this test; none of these hosts is in the training table.
HELD_OUT_URLS = [(1, u) for u in """
https://grand-casino-online.net/en/play/9 http://m.casino-vegas.example.com/de/33 https://pokerface-rooms.org/fr/2
http://super-slots-bonus.com/en/1 https://livebets24.net/odds http://bet-and-win-bets.example.net/en/81
https://xxx-tube.org/en/7 http://adult-dating-now.com/de/3 https://sexchat-live.net/en http://viagra-pills.net/en/22
https://discount-pills.example.org/fr/8 http://rx-pharmacy-cheap.biz/en http://fast-payday-loan.net/apply
https://win-free-prize.info/en/claim http://crypto-doubler-fast.com/en https://keygen-crack-downloads.net/de/6
http://seo-links-farm.info/en/4 https://spammy-links.biz/out/3 http://adserver.click-network.com/en/9
https://www.ads-clicks.net/r/1""".split()] + [(0, u) for u in """
https://www.mountain-rescue.org/en/12 http://blog.thestation.example.net/de/44 https://m.reading-room.net/fr/3
http://www.thtide.example.org/en/771 https://geology.institute.edu/papers/9 http://city-theatre.com/en/season
https://tienther.example.com/en/6 http://www.cookingclass.net/recipes/11 https://wiki.sailing-club.org/en/knots
http://m.herald-news.com/en/2031 https://museum-of-rivers.org/de/7 http://therion.example.net/fr/18
https://www.language-school.net/en/courses http://railway-museum.com/en/5 https://blog.thornbury.org/en/88
http://chemistry-lectures.edu/en/3 https://www.village-hall.net/de/2 http://poems-archive.com/en/9
https://choir-of-the-north.org/fr/1 http://www.botanic-gardens.com/en/4""".split()]


def test_urls_labelled_by_hand(spark):
    """The registered table against held-out URLs, and against the kinds of hosts of ``pages``."""
    assert len(url_filter.ROWS) < 200 and not {u for u, _ in url_filter.ROWS} & {u for _, u in HELD_OUT_URLS}
    pages = spark.createDataFrame([(i, u) for i, (_, u) in enumerate(HELD_OUT_URLS)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(pages, url_filter.labelled(spark), []).collect()}
    wrong = [u for i, (blocked, u) in enumerate(HELD_OUT_URLS) if (got[i] == "block") != bool(blocked)]
    assert len(wrong) <= 4, wrong


def test_pages_that_no_rule_decides(spark):
    """Hosts of ``pages`` named after what they sell are blocked, those of syllables are kept."""
    rows = url_filter.op8_url_filter(spark, "/root/testdata/sf0.1").where("rule is null").collect()
    bad = re.compile(r"casino|bets|pills|spam|adult|\bads-")
    found = Counter((bool(bad.search(r.host)), r.verdict) for r in rows)
    assert found[True, "block"] >= 0.9 * (found[True, "block"] + found[True, "allow"])
    assert found[False, "allow"] >= 0.97 * (found[False, "block"] + found[False, "allow"])


# ------------------------------------------------------------------ 9 packing

def check_packing(out, texts, sequence):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    places, pieces = defaultdict(list), defaultdict(list)
    for r in out:
        places[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in places.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *[n for _, n in parts]])[:-1].tolist()
        assert sum(n for _, n in parts) <= sequence
    for i, text in texts.items():
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    return places


def test_packing(docs, rows, empty, spark):
    out = packing.pack(docs, public_path("word_bpe_49k.json")).collect()
    check_packing(out, by_id(rows), 4096)
    assert packing.pack(empty, public_path("word_bpe_49k.json")).count() == 0
    twice = spark.createDataFrame([(1, "same text"), (1, "same text"), (None, "x")], "doc_id long, text string")
    assert packing.pack(twice, public_path("word_bpe_49k.json")).count() == 2


def test_words_are_independent_between_spaces():
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    rng = random.Random(2)
    odd = ["a", "B", "é", "É", "漢", "İ", "ǅ", "Σ", "1", "½", "'s", "<|endoftext|>", "<|startoftext|>", "!", " ",
           "\t", chr(0xA0), chr(0x2028), "\x1c", chr(0x301), "ﬁ", "😀"]
    odd += ["word", "Straße", "ÀÉ", "ª", "×", "don't", "it's", "...", "<|", "|>", "A1b2", "\x00", "\x7f", "-", "ÿ", "µ"]
    words = LowerWords(library)
    for _ in range(3000):
        text = "".join(rng.choices(odd, k=rng.randint(0, 20)))
        whole = library.encode(text, add_special_tokens=False).ids
        assert whole == words.encode(words.keys(text.encode()))[0].tolist(), text


def test_patterns_hold_every_piece_with_little_padding():
    rng = np.random.default_rng(1)
    lengths = np.array([*range(1, 64), *range(64, 4097, 64)])
    demand = np.append(rng.integers(3000, 4000, 63), (40_000 * np.exp(-np.arange(64) / 9)).astype(int))
    lengths, demand = lengths[demand > 0], demand[demand > 0]
    chosen = packing.solve_lengths(lengths, demand)
    assert (sum(c * n for c, n in chosen) == demand).all()
    assert all((c * lengths).sum() <= 4096 for c, _ in chosen)
    assert sum(n for _, n in chosen) <= 1.002 * (lengths * demand).sum() / 4096 + 10
    uneven = rng.integers(0, 3000, len(lengths))
    assert (sum(c * n for c, n in packing.solve_lengths(lengths, uneven)) == uneven).all()
    assert packing.solve_patterns(np.zeros(0, int), np.zeros(0, int), 4096) == []


# ------------------------------------------------------------------ 10 similarity join

def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return re.findall("[^\x20\x09-\x0D]+", low)


def brute_components(texts):
    sets = {}
    for i, text in texts.items():
        w = words_of(text)
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_similar_components(spark, docs, rows, empty):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_components(docs).collect()}
    assert got == brute_components(by_id(rows))
    assert ngram_join.similar_components(empty).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_similar_components_of_edited_copies(spark, seed):
    rng = random.Random(seed)
    base = [prose(rng, 60).split() for _ in range(4)]
    data = []
    for i in range(160):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = prose(rng, 1) + str(rng.randint(0, 9))
        if rng.random() < 0.4:
            w += "a line that very many documents of this corpus share at their end".split()
        data.append((i, " ".join(w) if i % 9 else " ".join(w[:rng.randint(0, 9)])))
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_components(df).collect()}
    assert got == brute_components(dict(data))


def edited_family(seed):
    """Copies of few texts with many edits: nearly all share shingles, not all link."""
    rng = random.Random(seed)
    base = [prose(rng, 50).split() for _ in range(2)]
    texts = {}
    for i in range(150):
        w = list(base[i % 5 == 0])
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = prose(rng, 1) + str(rng.randint(0, 9))
        texts[i] = " ".join(w + "all of these texts end with one line of words".split())
    return texts


@pytest.mark.parametrize("block", [400, 2500])
def test_wide_groups_are_cut_into_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    texts = edited_family(block)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_components(df).collect()}
    assert got == brute_components(texts)


def test_blocks_are_bounded_and_every_pair_meets(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 20 * 164)
    sets = [(i, i % 2 * (i % 9 == 0), 100, b"") for i in range(900)]        # home 0: 850 sets, home 1: 50
    placed = ngram_join._home_blocks(spark.createDataFrame(sets, "sid long, home long, size int, tokens binary")).collect()
    assert Counter(r.sid for r in placed if r.own == r.block) == Counter(range(900))
    assert max(Counter((r.home, r.block) for r in placed).values()) < 3 * 20 + ngram_join.LEADERS
    for shares in ([1, 0, 0, 0], [0.9, 0.05, 0.03, 0.02], [0.4, 0.3, 0.2, 0.1]):
        rng = random.Random(1)
        label = [rng.choices(range(4), shares)[0] for _ in range(300)]
        label[0] = 3
        rows = [(5, i, label[i], 100, 300 * 164) for i in range(300)] + [(6, i, i, 100, 3 * 164) for i in range(3)]
        rows = spark.createDataFrame(rows, "rep long, sid long, label long, size int, weight long")
        groups = defaultdict(set)
        for r in ngram_join._block_pairs(rows).collect():
            groups[r.rep, r.i, r.j].add(r.sid)
        assert groups[6, 0, 0] == {0, 1, 2}
        assert max(map(len, groups.values())) < 2 * 3 * 20
        met = {(a, b) for (rep, *_), g in groups.items() if rep == 5 for a in g for b in g}
        assert all((a, b) in met for a in range(300) for b in range(300) if label[a] != label[b])


def test_repeated_ids_are_entries_of_their_own(spark):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    df = spark.createDataFrame([(5, a), (5, b), (7, b), (9, a), (None, a)], "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id) for r in ngram_join.similar_components(df).collect())
    assert got == Counter([(5, 5), (5, 5), (7, 5), (9, 5)])


def test_prefix_tree_finds_all_links():
    rng = np.random.default_rng(4)
    base = [np.sort(rng.choice(5000, 60, replace=False)).astype(np.uint64) for _ in range(3)]
    sets = []
    for _ in range(90):
        s = base[rng.integers(3)]
        s = s[rng.random(len(s)) > rng.random() * 0.3]
        sets.append(np.unique(np.append(s, rng.choice(5000, rng.integers(0, 8)).astype(np.uint64))))
    forest = prefix_tree.Forest(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            if prefix_tree.fits(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j])):
                forest.join(i, j)
    assert (prefix_tree.linked(sets).roots() == forest.roots()).all()


def test_linked_equals_brute_force_on_few_sets():
    rng = np.random.default_rng(9)
    groups = [[np.arange(96), np.arange(40, 140), np.arange(1, 97)]]     # the longest links with nothing
    for _ in range(1500):
        whole = np.arange(rng.integers(8, 40))       # near misses: two cuts of one set overlap by about the need
        groups.append([np.append(whole[rng.random(len(whole)) > rng.random() * 0.35],
                                 100 + rng.integers(0, 50)) for _ in range(rng.integers(2, 6))])
    several = 0
    for group in groups:
        group = [np.asarray(s, np.uint64) for s in group]
        forest = prefix_tree.Forest(len(group))
        for i in range(len(group)):
            for j in range(i):
                if prefix_tree.fits(len(np.intersect1d(group[i], group[j])), len(group[i]), len(group[j])):
                    forest.join(i, j)
        assert (prefix_tree.linked(group).roots() == forest.roots()).all(), group
        several += 1 < len(set(forest.roots().tolist())) < len(group)
    assert several > 100


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(200, 201), (201, 200), (7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}


def test_constructed_words_do_not_collide(spark):
    # the Thue-Morse word and its complement have equal polynomial hashes modulo 2**64 for every base
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    a, b = ("".join("ab"[x ^ flip] for x in bits) for flip in (0, 1))
    texts = [a, b, f"{a} w x y z", f"{b} w x y z", f"{a} w x y z", a.upper()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.similar_components(docs).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 2, 5: 0}


def test_hash_of_shingles_follows_the_words():
    from paylater.llm.blocks import shingle_hashes, word_hashes
    texts = ["A b  C\td e f", "a B c d\x0be F", "a b c d e", "", "  ", "a b", "a b", "e f a b"]
    raw = [t.encode() for t in texts]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    values, offsets = shingle_hashes(*word_hashes(np.frombuffer(b"".join(raw), np.uint8), at), 5)
    rows = [values[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
    assert rows[0] == rows[1] and rows[0][0] == rows[2][0] and rows[3] == rows[4] == [] and rows[5] == rows[6]
    assert len(rows[0]) == 2 and rows[7] != rows[5]
