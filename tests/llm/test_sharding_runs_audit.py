"""Operators 11 to 13 against brute force, on handmade tables with every odd case."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylater.llm import filter_audit, periodic_runs, sharding
from paylater.llm.queries import QUERIES

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("source", T.StringType()),
                     # names that the operators use inside
                     T.StructField("h", T.StringType()), T.StructField("part", T.IntegerType()),
                     T.StructField("mask", T.StringType()), T.StructField("shard", T.StringType()),
                     T.StructField("range_id", T.StringType()), T.StructField("body", T.IntegerType()),
                     T.StructField("copies", T.StringType()), T.StructField("good", T.StringType())])
LABELS = "doc_id long, quality int, toxic int"


def prose(rng, n):
    return " ".join(rng.choice(["the", "On", "ÉT", "ba", "ca", "x"]) + rng.choice("abcdefghij$") for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base = [prose(rng, rng.randint(0, 90)) for _ in range(30)]
    texts = [None, "", " ", " a \x0b b", "A", "one two " * 9, "q " * 40, "LONG " + prose(rng, 9000)]
    texts += base + base[:12] + [base[3]] * 60 + ["a b c d e f g " * 4 + t for t in base[:6]]
    texts += ["same head " * 40 + str(i % 37) for i in range(60)]
    made = [(i * 7 % 1009, t, [None, "", "s1", "s2", "s1"][i % 5]) for i, t in enumerate(texts)]
    made += [(None, base[3], "s1"), (None, None, None), (None, "one", "s2"), made[9], made[9], (made[9][0], "other", "s9")]
    return [(*r, "h", 1, "m", "s", "r", 2, "c", "g") for r in made]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(6)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# ------------------------------------------------------------------ 11 sharding

@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_shards_hold_each_row_once_in_equal_shares(docs, rows, law):
    out = sharding.shard_documents(docs, 7, law).collect()
    sizes = [len((r[1] or "").encode()) + 1 for r in rows]
    crc = [zlib.crc32((r[1] or "").encode()) for r in rows]
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == Counter(zip((r[0] for r in rows), sizes, crc))
    slots = defaultdict(list)
    held = Counter()
    for r in out:
        slots[r.shard].append(r.slot)
        held[r.shard] += r["size"] if law == "bytes" else 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if law == "rows":
        assert max(held.values()) - min(held.values()) <= 1 and len(held) == 7
    else:
        share = sum(sizes) / 7
        assert all(abs(held[s] - share) <= max(sizes) for s in range(7))


def test_shards_of_one_repeated_row_and_of_one_text(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 50)
    same = spark.range(999).select(F.lit(5).cast("bigint").alias("doc_id"), F.lit("ab").alias("text"))
    copies = spark.range(20000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "").alias("text"))
    for df, n in ((same, 999), (copies, 20000)):
        out = sharding.shard_documents(df, 4)
        counts = {r.shard: r["count"] for r in out.groupBy("shard").count().collect()}
        assert sum(counts.values()) == n and max(counts.values()) - min(counts.values()) <= 1
        assert out.select("shard", "slot").distinct().count() == n


def test_overfull_ranges_are_divided(spark):
    # small texts carry no bytes, so the size-weighted sample leaves them in one range
    docs = spark.range(12000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 100 == 0, F.repeat(
        F.concat(F.lit("w"), F.col("id")), 900)).otherwise("").alias("text"))
    records = sharding._records(docs, "doc_id", "text").cache()
    weight = F.col("size") * F.col("copies")
    total = records.agg(F.sum(weight)).first()[0]
    _, held = sharding.splitters(records, weight, 12000, total)
    usual = 12000 // sharding.LEAST_RANGES
    assert max(v[0] for v in held.values()) <= sharding.OVERFULL * usual
    assert sum(v[0] for v in held.values()) == 12000


def test_equal_texts_are_neighbours_and_order_is_by_key(docs):
    out = sharding.shard_documents(docs, 3).orderBy("shard", "slot").collect()
    keys = [(r["size"], r.text_crc32) for r in out]
    assert len([k for i, k in enumerate(keys) if not i or keys[i - 1] != k]) == len(set(keys))


def test_shards_are_written(spark, docs, rows, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "out"), 5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r.doc_id, r.text or "") for r in back.collect()) == Counter((r[0], r[1] or "") for r in rows)
    assert back.select("shard", "slot").distinct().count() == len(rows)


def test_shards_of_small_and_empty_tables(spark, empty):
    assert sharding.shard_documents(empty).count() == 0
    one = sharding.shard_documents(spark.createDataFrame([(1, "a")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r["size"], r.slot) for r in one] == [(1, 2, 0)]
    with pytest.raises(ValueError):
        sharding.shard_documents(empty, law="none")


def test_sharding_query_is_whole(spark):
    sf = "/root/testdata/sf0.001"
    out = QUERIES["op11_sharding"](spark, sf).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in out} == {
        i: (len(t) + 1, zlib.crc32(t)) for i, t in texts.items()}
    assert len(out) == len(texts) and {r.law for r in out} == {"bytes"} and {r.grown_shard for r in out} == {None}
    held = Counter()
    for r in out:
        held[r.shard] += r["size"]
    assert max(held.values()) - min(held.values()) <= 2 * max(map(len, texts.values()))


# ------------------------------------------------------------------ 12 runs

def brute_runs(words, least=12):
    n, out = len(words), []
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            s, e = i, j + p
            if e - s >= max(least, 2 * p) and not any(words[s:e - q] == words[s + q:e] for q in range(1, p)):
                out.append((s, e - s, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_digest(doc_id, text, plant=True):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {k for s, length, p in runs for k in range(s + p, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest())


def test_cover_reaches_every_pair_of_remainders():
    m, cover = periodic_runs.MODULUS, set(periodic_runs.COVER)
    for a in range(m):
        for b in range(m):
            d = periodic_runs.STEP[a, b]
            assert (a + d) % m in cover and (b + d) % m in cover
    with pytest.raises(ValueError):
        periodic_runs._steps(7, (0, 1))


def _flat(texts):
    counts = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(counts + 1) - counts - 1
    words = np.zeros(int((counts + 1).sum()), np.int64)
    for s, t in zip(starts, texts):
        words[s:s + len(t)] = np.array(t, np.int64) + 1
    return words, starts, counts


def test_runs_match_brute_force_on_random_words(monkeypatch):
    monkeypatch.setattr(periodic_runs, "PAIRS", 300)
    rng = random.Random(3)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 6)):
            k, n = rng.choice([1, 2, 3, 5, 50]), rng.randint(0, 140)
            w = [rng.randint(0, k) for _ in range(n)]
            if rng.random() < .6 and n > 5:
                a = rng.randrange(n)
                p = 1 + (n - a) // (3 + rng.randrange(8))
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            texts.append(w)
        found = [[] for _ in texts]
        for d, *run in zip(*periodic_runs.runs_of(*_flat(texts))):
            found[d].append(tuple(map(int, run)))
        assert found == [brute_runs(t) for t in texts]


def test_common_extensions_match_direct_comparison():
    rng = random.Random(9)
    texts = [[rng.randint(0, 1) for _ in range(40)] * 6, [0] * 300, [rng.randint(0, 3) for _ in range(200)]]
    words, starts, counts = _flat(texts)
    lce = periodic_runs.CommonExtensions(words, np.repeat(np.arange(3), counts + 1))
    for d in range(3):
        a = np.array([rng.randrange(counts[d] - 1) for _ in range(500)])
        b = np.array([rng.randint(x + 1, counts[d] - 1) for x in a])
        got = lce.extend(starts[d] + a, starts[d] + b)
        for x, y, z in zip(a, b, got):
            n = 0
            while y + n < counts[d] and texts[d][x + n] == texts[d][y + n]:
                n += 1
            assert n == z


def test_long_periodic_document_has_one_run():
    words = [1 + i % 97 for i in range(60_000)]
    doc, start, length, period = periodic_runs.runs_of(*_flat([words]))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [60_000], [97])


def test_run_rows_match_brute_force(docs, rows):
    out = periodic_runs.find_runs(docs).collect()
    assert len(out) == len(rows)
    short = [r for r in rows if len(r[1] or "") < 3000]
    expected = Counter((r[0], tuple(brute_runs((r[1] or "").encode().split()))) for r in short)
    got = Counter((r.doc_id, tuple(map(tuple, r.runs))) for r in out if r.n_words < 700)
    assert got == expected


def test_run_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    short = {r.doc_id: r.text for r in rows if len((r.text or "").split()) < 900}
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, sf).collect()}
    assert len(got) == len(rows) and len(short) > 150
    assert {i: got[i] for i in short} == {i: brute_digest(i, t) for i, t in short.items()}
    assert any(g[1] for g in got.values())


def test_runs_of_an_empty_table(empty):
    assert periodic_runs.find_runs(empty).count() == 0


# ------------------------------------------------------------------ 13 filter audit

def test_trie_keeps_the_smallest_id_of_each_text():
    rng = random.Random(1)
    trie, least = filter_audit.RadixTrie(), {}
    for n in range(3000):
        text = bytes(rng.choices(b"ab", k=rng.randint(0, 12))) + b"tail" * rng.randint(0, 2)
        key = rng.randint(0, 500)
        lost = trie.insert(text, key, n)
        assert (lost is None) == (text not in least)
        least[text] = min(least.get(text, key), key)
        assert trie.smallest(text) == least[text]
    assert [(t, k) for t, k, _ in trie.terminals()] == sorted(least.items())
    assert trie.smallest(b"zz") is None and trie.smallest(b"tai") is None


def test_ranges_follow_prefixes_and_keep_equal_texts_together():
    sample = [f"{'x' * 300}{i}"[:filter_audit.PREFIX] for i in range(50)] + [f"k{i}" for i in range(50)]
    ranges = filter_audit.choose_ranges(sample, 20)
    assert ranges.extra and all(len(b) <= 4 for b in ranges.boundaries)
    texts = [f"{'x' * 300}{i}".encode() for i in range(4000)] + [f"k{i}".encode() for i in range(50)] + [b""]
    found = [ranges.of(t) for t in texts]
    assert found == [ranges.of(t) for t in texts] and 0 <= min(found) and max(found) < ranges.count
    assert max(Counter(found[:4000]).values()) < 4000 / 5


def brute_masks(rows):
    ids = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            ids[r[1] or ""].append(r[0])
    out = []
    for r in rows:
        text = r[1] or ""
        words = text.encode().split()
        mask = (len(words) < 50) + 2 * (100 * len(set(words)) < 65 * len(words))
        mask += 4 * (100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text)) + 8 * any(c in "#$%&*|" for c in text)
        mask += 16 * (r[0] is not None and min(ids[text]) < r[0])
        out.append((r[0], r[2] or "", mask))
    return out


def test_masks_match_brute_force(docs, rows, monkeypatch):
    monkeypatch.setattr(filter_audit, "TEXTS_IN_RANGE", 5)
    got = Counter(map(tuple, filter_audit.failed_filters(docs).collect()))
    assert got == Counter(brute_masks(rows))


def test_interactions_replay_every_order(spark, docs, rows):
    labels = [(r[0], i % 2, i % 3 == 0) for i, r in enumerate(rows) if i % 4] + [(1, None, None), (None, 1, 1)]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    out = filter_audit.interactions(filter_audit.failed_filters(docs), spark.createDataFrame(labels, LABELS))
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in out.collect()}
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    masks = brute_masks(rows)
    expected, shapley = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for part in {m[1] for m in masks}:
            left = [m for m in masks if m[1] == part]
            lost = []
            for step, f in enumerate(order, 1):
                bit = 1 << "ABCDE".index(f)
                gone = [m for m in left if m[2] & bit]
                redundant = sum(bool(m[2] & bit) for m in lost)
                left = [m for m in left if not m[2] & bit]
                lost += gone
                shapley[part, f] += len(gone)
                expected[part, order, step] = (
                    len(left), len(gone), redundant, sum(m[1] == part and m[2] == bit for m in masks),
                    sum(m[0] in good for m in gone), sum(m[0] in toxic for m in gone))
    assert got == {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in expected.items()}


def test_audit_of_an_empty_table(spark, empty):
    masks = filter_audit.failed_filters(empty)
    assert filter_audit.interactions(masks, spark.createDataFrame([], LABELS)).count() == 0
