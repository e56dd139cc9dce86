"""Filter interaction audit: which filter removes what, in every order of the filters.

1. **Masks.**  One pass over the texts judges each filter but the duplicate filter by itself, so an order
   of filters is never run: what any order keeps or removes follows from a document's set of failed
   filters, its mask.
2. **Local tries.**  A task inserts the texts of a block into a radix trie (compressed: an edge holds
   any number of bytes) whose terminals hold the smallest id.  A document that meets its text
   under a smaller id is a duplicate already, and its text goes no further: a block
   sends each text once, so a group of a third of all rows is one row for each block.
3. **Ranges.**  Sampled texts give quantiles; a boundary is the shortest prefix that parts two
   neighbours of the sample, so it is as long as the texts need.  A range that no
   boundary parts (its samples agree in their first ``PREFIX`` characters) is divided by a hash of the whole text.
   Equal texts always share a range.
4. **Range tries.**  Each task inserts the texts of its ranges into tries, batch by batch: a
   repeated text only lowers the id at its terminal.  At the end the terminals say which
   documents are duplicates.
5. **Reduction.**  Narrow rows meet their labels, and one row for each part and mask is left, from which
   the figures of all orders follow.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylater.llm import documents
from paylater.llm.blocks import binary_views, row_blocks

FILTERS = "ABCDE"
DUPLICATE = "E"
LEAST_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
SIGNS = b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))

PREFIX = 256             # characters of a sampled text that a boundary may use
SAMPLE = 16_384          # sampled texts, about
RANGES = 2_048           # ranges, at most; a table of fewer texts has fewer
TEXTS_IN_RANGE = 512
BLOCK_BYTES = 8 << 20


class RadixTrie:
    """Texts as paths of byte strings; a terminal holds the smallest id and what came with it.

    A node is a list ``[edge, children, value]``; ``children`` maps the first byte of an edge
    to its node, ``value`` is ``(id, rest)`` or None.
    """

    def __init__(self):
        self.root: list = [b"", {}, None]

    def insert(self, text: bytes, key: int, rest) -> tuple[int, object] | None:
        """Puts ``(key, rest)`` at the text's terminal if no smaller or equal key is there.

        Returns what loses: the greater of the two, the newcomer if they are equal, None if there is one only.
        """
        node, at, n = self.root, 0, len(text)
        while at < n:
            child = node[1].get(text[at])
            if child is None:
                node[1][text[at]] = [text[at:], {}, (key, rest)]
                return None
            edge = child[0]
            end = at + len(edge)
            if text[at:end] == edge:
                node, at = child, end
                continue
            # part the edge where the texts part
            same = _common(edge, text, at)
            upper = [edge[:same], {edge[same]: child}, None]
            child[0] = edge[same:]
            node[1][text[at]] = upper
            node, at = upper, at + same
        held = node[2]
        if held is None or key < held[0]:
            node[2] = (key, rest)
            return held
        return key, rest

    def smallest(self, text: bytes) -> int | None:
        """The id at the text's terminal."""
        node, at, n = self.root, 0, len(text)
        while at < n:
            node = node[1].get(text[at])
            if node is None or text[at:at + len(node[0])] != node[0]:
                return None
            at += len(node[0])
        return node[2][0] if node[2] else None

    def terminals(self) -> Iterator[tuple[bytes, int, object]]:
        """``text, id, rest`` of every terminal, in the order of the bytes."""
        stack = [(b"", self.root)]
        while stack:
            path, node = stack.pop()
            path += node[0]
            if node[2] is not None:
                yield path, *node[2]
            stack.extend((path, node[1][c]) for c in sorted(node[1], reverse=True))


def _common(edge: bytes, text: bytes, at: int) -> int:
    """Length of the common prefix of ``edge`` and ``text[at:]``, by halving."""
    low, high = 0, min(len(edge), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if edge[low:middle] == text[at + low:at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def text_mask(body: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = body.split()                     # ASCII white space, as the contract's word pattern
    mask = 0
    if len(words) < LEAST_WORDS:
        mask |= 1
    if 100 * len(set(words)) < DISTINCT_PERCENT * len(words):
        mask |= 2
    capitals = len(body) - len(body.translate(None, CAPITALS))
    if 100 * capitals > CAPITAL_PERCENT * len(body.decode()):
        mask |= 4
    if len(body) != len(body.translate(None, SIGNS)):
        mask |= 8
    return mask


DUPLICATE_BIT = 1 << FILTERS.index(DUPLICATE)

NARROW = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()),
                    ("range_id", pa.int32()), ("body", pa.large_binary())])
NARROW_DDL = "doc_id bigint, part string, mask int, range_id int, body binary"
FLAGGED = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32())])
FLAGGED_DDL = "doc_id bigint, part string, mask int"


class Ranges:
    """Range numbers of texts: by boundaries, and by hash inside ranges that no boundary parts."""

    def __init__(self, boundaries: list[str], extra: dict[int, int]):
        # code point order of text is byte order of UTF-8
        self.boundaries = [b.encode() for b in boundaries]
        self.extra, total = {}, len(boundaries) + 1
        for k, n in sorted(extra.items()):
            self.extra[k] = (total, n)
            total += n
        self.count = total

    def of(self, body: bytes) -> int:
        k = bisect.bisect_right(self.boundaries, body)
        if k in self.extra:
            first, n = self.extra[k]
            return first + xxhash.xxh64_intdigest(body) % n
        return k


def choose_ranges(sample: list[str], wanted: int, prefix: int = PREFIX) -> Ranges:
    """Ranges of near-equal shares of a sample of distinct texts (cut to ``prefix`` characters).

    A boundary is the shortest prefix that parts the samples on its two sides.
    """
    sample = sorted(sample)
    n, boundaries = len(sample), []
    for j in range(1, wanted):
        k = j * n // wanted
        if k and sample[k - 1] != sample[k]:
            same = _common(sample[k], sample[k - 1], 0)
            boundary = sample[k][:same + 1]
            if not boundaries or boundaries[-1] < boundary:
                boundaries.append(boundary)
    held: dict[int, int] = {}
    for text in sample:
        k = bisect.bisect_right(boundaries, text)
        held[k] = held.get(k, 0) + 1
    share = max(1.0, n / max(wanted, 1))
    return Ranges(boundaries, {k: math.ceil(m / share) for k, m in held.items() if m > 2 * share})


def _flat(batch: pa.RecordBatch) -> Iterator[tuple[list, list, list[bytes]]]:
    """Blocks of a batch as ids, parts and bodies."""
    data, at = binary_views(batch.column("body"))
    for low, high in row_blocks(at, BLOCK_BYTES):
        yield (batch.column("doc_id").slice(low, high - low).to_pylist(),
               batch.column("part").slice(low, high - low).to_pylist(),
               [data[at[i]:at[i + 1]].tobytes() for i in range(low, high)])


def _local(ranges):
    """Masks, and a trie for each block: texts of decided documents stay behind."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where: Ranges = ranges.value
        for batch in batches:
            for ids, parts, bodies in _flat(batch):
                trie, rows = RadixTrie(), []
                for i, part, body in zip(ids, parts, bodies):
                    mask = text_mask(body)
                    if i is None:                    # no id: neither a duplicate nor an original
                        rows.append((None, part, mask, -1 - len(rows), None))
                        continue
                    lost = trie.insert(body, i, [(part, mask)])
                    if lost is not None:
                        key, rest = lost
                        if key == trie.smallest(body):       # the same id again
                            _at(trie, body).extend(rest)
                        else:
                            rows += [(key, p, m | DUPLICATE_BIT, -1 - len(rows), None) for p, m in rest]
                for body, key, rest in trie.terminals():
                    k = where.of(body)
                    rows += [(key, p, m, k, body) for p, m in rest]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), NARROW)], schema=NARROW)
    return run


def _at(trie: RadixTrie, body: bytes) -> list:
    """What came with the smallest id of a text that is in the trie."""
    node, at = trie.root, 0
    while at < len(body):
        node = node[1][body[at]]
        at += len(node[0])
    return node[2][1]


def _ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Duplicate flags of the documents of one task's ranges; decided ones pass."""
    tries: dict[int, RadixTrie] = {}
    for batch in batches:
        out = []
        data, at = binary_views(batch.column("body"))
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "part", "mask", "range_id"))
        for n, (i, part, mask, k) in enumerate(zip(*columns)):
            if k < 0:
                out.append((i, part, mask))
                continue
            body = data[at[n]:at[n + 1]].tobytes()
            trie = tries.setdefault(k, RadixTrie())
            lost = trie.insert(body, i, [(part, mask)])
            if lost is not None:
                key, rest = lost
                if key == trie.smallest(body):
                    _at(trie, body).extend(rest)
                else:
                    out += [(key, p, m | DUPLICATE_BIT) for p, m in rest]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), FLAGGED)], schema=FLAGGED)
    for k in sorted(tries):
        out = [(key, p, m) for _, key, rest in tries.pop(k).terminals() for p, m in rest]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), FLAGGED)], schema=FLAGGED)


def sample_texts(rows: DataFrame, sample: int = SAMPLE, prefix: int = PREFIX) -> tuple[list[str], int]:
    """The first ``prefix`` characters of about ``sample`` distinct texts, and the number of rows.

    A text is taken by its hash: copies count once, however many there are.
    """
    total = rows.count()
    buckets = max(1, total // sample)
    text = F.col("body").cast("string")
    taken = (rows.where(F.pmod(F.xxhash64("body"), F.lit(buckets)) == 0)
             .groupBy(F.xxhash64("body").alias("h")).agg(F.min(F.substring(text, 1, prefix)).alias("head")))
    # distinct texts are at most the rows, so about ``sample`` at most are expected
    return [r["head"] for r in taken.select("head").collect()], total


def failed_filters(docs: DataFrame, part_col: str = "source", id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``doc_id, part, mask`` of every row: bit ``k`` is set if the document fails filter ``k`` of ``FILTERS``.

    Null texts are empty.  A null part is the empty string.  A row without an id is never a duplicate,
    and makes none; rows that repeat an id with the same text are not duplicates of each other.  Rows are
    kept one for one.  Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"),
                       F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"),
                       documents.text_bytes(text_col).alias("body"))
    sample, total = sample_texts(rows)
    ranges = choose_ranges(sample, max(1, min(RANGES, total // TEXTS_IN_RANGE)))
    local = rows.mapInArrow(_local(spark.sparkContext.broadcast(ranges)), NARROW_DDL)
    # decided rows (narrow, negative numbers by their place in a block) go anywhere
    return local.repartition("range_id").mapInArrow(_ranged, FLAGGED_DDL)


def orders() -> list[tuple[str, int, str, int, int]]:
    """``order, step, filter, its bit, bits of the filters before`` of every step of every order."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, f in enumerate(order, 1):
            bit = 1 << FILTERS.index(f)
            out.append(("".join(order), step, f, bit, before))
            before |= bit
    return out


def interactions(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step.

    ``masks``: ``doc_id, part, mask``.  ``labels``: ``doc_id, quality, toxic``; of a repeated id the
    greater values count, a null value is no label.  An empty table gives no rows.
    """
    known = (labels.where("doc_id is not null").groupBy("doc_id")
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                  F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    counted = (masks.join(known, "doc_id", "left").groupBy("part", "mask")
               .agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                    F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")))
    # at most 32 masks in a part
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    steps = F.from_json(F.lit(_orders_json()), "array<struct<filter_order:string,step:int,bit:int,before:int>>")
    every = parts.select("part", "masks", F.explode(steps).alias("s"))

    def total(field: str, holds) -> Column:
        return F.aggregate("masks", F.lit(0).cast("bigint"),
                           lambda a, m: a + F.when(holds(m["mask"]), m[field]).otherwise(F.lit(0)))

    bit, before = F.col("s.bit"), F.col("s.before")
    gone = lambda m: (m.bitwiseAND(bit) != 0) & (m.bitwiseAND(before) == 0)      # noqa: E731
    out = every.select(
        "part", F.col("s.filter_order").alias("filter_order"), F.col("s.step").alias("step"), bit.alias("bit"),
        total("n", lambda m: m.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total("n", gone).alias("removed"),
        total("n", lambda m: (m.bitwiseAND(bit) != 0) & (m.bitwiseAND(before) != 0)).alias("redundant"),
        total("n", lambda m: m == bit).alias("unique_fails"),
        total("good", gone).alias("good_lost"), total("toxic", gone).alias("toxic_lost"),
        _shapley(bit).alias("shapley"))
    return out.drop("bit")


def _orders_json() -> str:
    import json
    return json.dumps([{"filter_order": o, "step": s, "bit": b, "before": p} for o, s, _, b, p in orders()])


def _shapley(bit: Column) -> Column:
    """A filter's removals over all orders: of a document that fails ``k`` filters, each of these is the
    first in one of ``k`` orders."""
    everything = math.factorial(len(FILTERS))
    return F.aggregate("masks", F.lit(0).cast("bigint"), lambda a, m: a + F.when(
        m["mask"].bitwiseAND(bit) != 0, m["n"] * (F.lit(everything) / F.bit_count(m["mask"])).cast("bigint"))
        .otherwise(F.lit(0)))


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    """Figures of five filters in all 120 orders, for every source."""
    docs, labels = (documents.read(spark, sf_dir, t) for t in ("documents", "labels"))
    return interactions(failed_filters(docs), labels)


_LETTERS = ", ".join(f"('{f}', {1 << k})" for k, f in enumerate(FILTERS))
OP13_SQL = f"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
known AS (
  SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
  FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(k.good, 0) AS good, coalesce(k.toxic, 0) AS toxic,
         CASE WHEN len(words) < {LEAST_WORDS} THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < {DISTINCT_PERCENT} * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {CAPITAL_PERCENT} * length(text)
                THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
  FROM docs LEFT JOIN known k USING (doc_id)),
masks AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, mask),
letters(f, bit) AS (VALUES {_LETTERS}),
perms AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, s.step, bits[s.step] AS bit,
         CAST(coalesce(list_sum(bits[1:s.step - 1]), 0) AS INTEGER) AS before
  FROM perms, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s),
told AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM masks, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM told
"""
