"""Packing of tokenized documents into sequences, by cutting-stock patterns.

1. **Cut.**  Each document's ids are cut into full sequences, one piece of a
   multiple of ``UNIT`` ids, and a rest under ``UNIT``.  So there are only
   ``sequence / UNIT + UNIT - 1`` different piece lengths, at any input size.
2. **Patterns.**  The histogram of lengths is a cutting-stock problem: choose
   how often to use each pattern (a multiset of lengths that fits into one
   sequence) with the fewest sequences.  Its linear program is solved by column
   generation: a simplex over the patterns found so far, where a knapsack by
   dynamic programming over the room in a sequence prices new ones.  Multiples
   of ``UNIT`` (counted in units) and rests are two such problems, of 64 and 63
   lengths.  Uses are rounded down; what is left, a bounded number of pieces, is
   filled largest first.
3. **Assignment.**  Pieces are ranked within their length.  A pattern owns a
   range of ranks of each of its lengths, so rank and length give the sequence
   and the place in it.  Ranks come from buckets of hashed ids: a window ranks
   within a bucket, and the bucket counts give its start, so a length that
   holds many rows is not one task.

Only the histogram (127 lengths at 4096 ids) reaches the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylater.llm import documents
from paylater.llm.blocks import binary_views, row_blocks
from paylater.llm.tables import written
from paylater.llm.vocabulary import (LowerWords, WordTable, gather, open_tokenizer, public_path,
                                     tokenizer_text)

SEQUENCE = 4096
UNIT = 64
END_ID = 2
CLOSE = 2e-4                # share of sequences above the ids' volume at which the program may stop
WORDS_KEPT = 300_000        # distinct words that one task keeps encoded
ROWS_IN_BUCKET = 100_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut_lengths(total: int, sequence: int = SEQUENCE, unit: int = UNIT) -> list[int]:
    """Lengths of the pieces of a document of ``total`` ids, in order."""
    full, rest = divmod(total, sequence)
    whole = rest // unit * unit
    return [sequence] * full + [n for n in (whole, rest - whole) if n]


def _cutter(tokenizer, end_id: int, sequence: int, unit: int):
    """Pieces of each document.  Words are independent, so each is encoded once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = LowerWords(open_tokenizer(tokenizer.value))
        table, flat, offsets = WordTable(), np.zeros(0, np.uint32), np.zeros(1, np.int64)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            data, at = binary_views(batch.column("body"))
            raw = data.tobytes()
            out: list[list[int]] = [[], [], [], [], []]
            for first, end in row_blocks(at):
                if len(table) > WORDS_KEPT:
                    table, flat, offsets = WordTable(), np.zeros(0, np.uint32), np.zeros(1, np.int64)
                words = [encoder.keys(raw[at[i]:at[i + 1]]) for i in range(first, end)]
                known = len(table)
                places = [table.places(w) for w in words]
                if len(table) > known:
                    more, more_at = encoder.encode(list(islice(table, known, None)))
                    offsets = np.concatenate([offsets, more_at[1:] + len(flat)])
                    flat = np.concatenate([flat, more])
                for i, picks in zip(range(first, end), places):
                    tokens = np.append(gather(flat, offsets, picks), np.uint32(end_id)).astype("<u4")
                    start = 0
                    for n in cut_lengths(len(tokens), sequence, unit):
                        crc = zlib.crc32(tokens[start:start + n].tobytes())
                        for column, value in zip(out, (ids[i], start, n, crc, len(tokens))):
                            column.append(value)
                        start += n
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
    return run


def _best_pattern(value: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of greatest value."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fit = lengths <= room
        gain = np.where(fit, best[room - np.where(fit, lengths, 0)] + value, -1.0)
        k = int(np.argmax(gain))
        if gain[k] > best[room - 1]:
            best[room], last[room] = gain[k], k
        else:
            best[room] = best[room - 1]
    pattern, room = np.zeros(len(lengths), np.int64), capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
            continue
        pattern[last[room]] += 1
        room -= int(lengths[last[room]])
    return float(best[capacity]), pattern


def solve_patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int, max_columns: int = 2000
                   ) -> list[tuple[np.ndarray, int]]:
    """Patterns and whole numbers of uses that together hold every piece once."""
    if not len(lengths):
        return []
    basis = np.diag(capacity // lengths).astype(float)
    uses = demand / np.diag(basis)
    volume = (lengths * demand).sum() / capacity
    for _ in range(max_columns):
        if uses.sum() <= volume * (1 + CLOSE):      # no pattern can save more than this
            break
        duals = np.linalg.solve(basis.T, np.ones(len(lengths)))
        worth, pattern = _best_pattern(np.maximum(duals, 0), lengths, capacity)
        if worth <= 1 + 1e-7:
            break
        pattern[duals <= 0] = 0
        change = np.linalg.solve(basis, pattern.astype(float))
        ratio = np.where(change > 1e-9, uses / np.where(change > 1e-9, change, 1), np.inf)
        out = int(np.argmin(ratio))
        step = max(ratio[out], 0.0)
        uses = uses - step * change
        uses[out] = step
        uses = np.maximum(uses, 0)
        basis[:, out] = pattern
    columns = np.rint(basis).astype(np.int64).T
    left = demand.astype(np.int64).copy()
    chosen: list[tuple[np.ndarray, int]] = []
    for column, use in sorted(zip(columns, uses), key=lambda x: -x[1]):
        # whole uses only, and never more of a length than there is
        n = min(int(use + 1e-6), int((left[column > 0] // column[column > 0]).min()))
        if n > 0:
            chosen.append((column, n))
            left -= n * column
    order = np.argsort(-lengths)
    while left.any():
        column, room = np.zeros(len(lengths), np.int64), capacity
        for k in order:
            column[k] = min(left[k], room // lengths[k])
            room -= int(column[k] * lengths[k])
        n = int((left[column > 0] // column[column > 0]).min())
        chosen.append((column, n))
        left -= n * column
    return chosen


def solve_lengths(lengths: np.ndarray, demand: np.ndarray, sequence: int = SEQUENCE, unit: int = UNIT
                  ) -> list[tuple[np.ndarray, int]]:
    """Patterns over all lengths: those of multiples of the unit, with rests in the room they leave, and those of rests."""
    whole, left = lengths % unit == 0, demand.astype(np.int64).copy()
    chosen = []
    for column, n in solve_patterns(lengths[whole] // unit, demand[whole], sequence // unit):
        full = np.zeros(len(lengths), np.int64)
        full[whole] = column
        room = sequence - int((full * lengths).sum())
        for k in np.flatnonzero(~whole)[::-1]:
            full[k] = min(left[k] // n, room // lengths[k])
            room -= int(full[k] * lengths[k])
        left -= full * n
        chosen.append((full, n))
    rests = ~whole & (left > 0)
    for column, n in solve_patterns(lengths[rests], left[rests], sequence):
        full = np.zeros(len(lengths), np.int64)
        full[rests] = column
        chosen.append((full, n))
    return chosen


def _ranges(lengths: np.ndarray, chosen: list[tuple[np.ndarray, int]]) -> dict[int, np.ndarray]:
    """For each length: first rank, copies in the pattern, first sequence, place in the sequence."""
    found: dict[int, list] = {int(n): [] for n in lengths}
    ranks = dict.fromkeys(found, 0)
    sequence = 0
    for column, n in chosen:
        place = 0
        for k in np.argsort(-lengths):
            copies, length = int(column[k]), int(lengths[k])
            if copies:
                found[length].append((ranks[length], copies, sequence, place))
                ranks[length] += copies * n
                place += copies * length
        sequence += n
    return {k: np.array(v, np.int64).reshape(-1, 4) for k, v in found.items()}


def _placer(ranges: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                rows = np.flatnonzero(length == n)
                table = ranges[int(n)]
                row = table[np.searchsorted(table[:, 0], rank[rows], side="right") - 1]
                use, slot = np.divmod(rank[rows] - row[:, 0], row[:, 1])
                sequence[rows], offset[rows] = row[:, 2] + use, row[:, 3] + slot * n
            columns = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], [
                "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, unit: int = UNIT,
         end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Every row is a document: a null or empty text is the end id alone, rows
    that repeat an id are packed once each, rows without an id are left out.  Other columns are not read.  The
    tokenizer is a byte-level BPE of lower-case words that drops white space, such as ``word_bpe_49k.json``.
    """
    spark = docs.sparkSession
    tokenizer = spark.sparkContext.broadcast(tokenizer_text(tokenizer_path))
    pieces = written(documents.bodies(docs, id_col, text_col).mapInArrow(
        _cutter(tokenizer, end_id, sequence, unit), PIECES), "pieces")
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    lengths = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[int(n)] for n in lengths], np.int64)
    ranges = _ranges(lengths, solve_lengths(lengths, demand, sequence, unit))

    buckets = int(demand.sum()) // ROWS_IN_BUCKET + 1
    spread = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (spread.groupBy("length", "bucket").agg(F.count("*").alias("n"))
              .select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "doc_tokens", "ids_crc32")
    ranked = (spread.withColumn("n", F.row_number().over(inside)).join(starts, ["length", "bucket"])
              .withColumn("rank", F.col("ahead") + F.col("n") - 1))
    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(
        _placer(ranges), PIECES + ", sequence_id long, offset long")


def op9_packing(spark, sf_dir: str) -> DataFrame:
    """Every document's ids in sequences of at most 4096, with their places."""
    return pack(documents.read(spark, sf_dir, "documents"), public_path("word_bpe_49k.json"))
