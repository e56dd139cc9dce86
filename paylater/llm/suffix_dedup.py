"""Removal of repeated byte strings by prefix-free parsing.

A string of ``length`` bytes is *repeated* if it also starts earlier (in a
document of smaller id, or earlier in the same document).  Every byte that a
repeated string covers is removed.

1. **Parse.**  A rolling hash of ``TRIGGER`` bytes runs over each document.
   Every window of ``length`` bytes has one trigger: the position of the
   smallest hash inside it (the first, if equal).  Windows that start next to
   each other and share their trigger form one phrase.  The trigger depends
   on the window's bytes alone, so equal windows lie in phrases with equal
   trigger strings, at equal distance from the trigger.
2. **Dictionary.**  Phrases meet by trigger hash.  Equal phrases have equal
   windows: all but the first are repeated as a whole.  A trigger seen in one
   phrase text only needs nothing more.  Highly repetitive text leaves few
   dictionary entries.
3. **Corpus order.**  Where phrases of one trigger differ, the first
   occurrence of each is cut into cells: windows whose distance from the
   trigger falls in the same ``CELL`` values share a core of
   ``length - CELL + 1`` bytes.  Cells with equal cores are put in suffix order
   twice: by the text that follows the core (the parse) and by the reversed
   text before it (the phrase suffix in the dictionary).  Two windows are equal
   where both orders put them in one class at the window's depth, which the
   arrays of longest common prefixes show; the earliest of a class stays.

Before rows are shuffled, every block of documents settles what it can see
alone: later copies of a phrase are marked at once, and a trigger that has
several phrases in one block sends a single row.  So a trigger key gets a row
per block at most, however many documents share it.  Ranges, not texts, are
shuffled until step 3, which carries the text of differing phrases only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from paylater.llm import documents
from paylater.llm.blocks import (BASE_A, BASE_B, SpanHash, binary_views, mix, row_blocks,
                                 sliding_min)

TRIGGER = 32
CELL = 16
POSITION_BITS = 22           # of a block of text; larger documents are parsed piece by piece
PIECE = 1 << 20

# States of a row.  MARK: a repeated byte range, ``content`` to ``place``.  OPEN: first
# occurrence of a phrase, to compare with others of its trigger.  ASK: not
# settled.  TOLD: settled in its block; only shows its trigger's group that there are others.
MARK, OPEN, ASK, TOLD = 0, 1, 2, 3
PHRASE = "trigger long, content long, doc_id long, place long, state int"
CELLS = ("core_a long, core_b long, left_a long, left_b long, right_a long, right_b long, "
         "doc_id long, place long, state int")
RANGE = "doc_id long, begin long, finish long"


def _pack(start: np.ndarray, distance: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Start of the first window, its distance to the trigger, number of windows."""
    return start.astype(np.int64) << 16 | distance.astype(np.int64) << 8 | count.astype(np.int64)


def _unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 16, place >> 8 & 255, place & 255


def parse_bytes(data: np.ndarray, offsets: np.ndarray, length: int
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of the documents in one buffer: row, trigger hash, content hash, place."""
    n = len(data)
    nothing = np.zeros(0, np.int64)
    if n < length:
        return nothing, nothing.astype(np.uint64), nothing.astype(np.uint64), nothing
    rolling = SpanHash(data, BASE_A)
    hashes = rolling.windows(TRIGGER)
    low = np.uint64((1 << POSITION_BITS) - 1)
    best = sliding_min(hashes & ~low | np.arange(len(hashes), dtype=np.uint64), length - TRIGGER + 1)
    trigger = (best & low).astype(np.int64)
    row = np.searchsorted(offsets, np.arange(len(trigger)), side="right") - 1
    cut = np.ones(len(trigger), bool)
    cut[1:] = (trigger[1:] != trigger[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(cut)
    end = np.append(begin[1:], len(trigger))
    row = row[begin]
    end = np.minimum(end, offsets[row + 1] - length + 1)
    whole = end > begin
    begin, end, row = begin[whole], end[whole], row[whole]
    at = trigger[begin]
    content = SpanHash(data, BASE_B).spans(begin, end - 1 + length)
    place = _pack(begin - offsets[row], at - begin, end - begin)
    content ^= (place & 0xFFFF).astype(np.uint64) * np.uint64(BASE_B)
    return row, hashes[at], content, place


def _pieces(data: np.ndarray, offsets: np.ndarray, length: int
            ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of whole documents, and overlapping pieces of long ones: first
    row, the piece's place in it, bytes and offsets.  Each window is in one piece."""
    for first, end in row_blocks(offsets, PIECE):
        low, high = int(offsets[first]), int(offsets[end])
        if end > first + 1 or high - low < 2 * PIECE:
            yield first, 0, data[low:high], offsets[first:end + 1] - low
            continue
        for at in range(low, high - length + 1, PIECE):
            stop = min(high, at + PIECE + length - 1)
            yield first, at - low, data[at:stop], np.array([0, stop - at])


def _first_of_kind(group: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by group, then kind: which start a group, which start a kind."""
    new_group = np.ones(len(group), bool)
    new_group[1:] = group[1:] != group[:-1]
    new_kind = new_group.copy()
    new_kind[1:] |= kind[1:] != kind[:-1]
    return new_group, new_kind


def _merged(doc: np.ndarray, begin: np.ndarray, finish: np.ndarray) -> tuple[np.ndarray, ...]:
    """Union of byte ranges by document."""
    order = np.lexsort((begin, doc))
    doc, begin, finish = doc[order], begin[order], finish[order]
    if not len(doc):
        return doc, begin, finish
    row = np.cumsum(np.append(True, doc[1:] != doc[:-1])) - 1
    shift = row * (int(finish.max()) + 1)          # so that ranges of other documents never touch
    reach = np.maximum.accumulate(finish + shift)
    new = np.append(True, begin[1:] + shift[1:] > reach[:-1])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(doc) - 1)
    return doc[new], begin[new], (reach - shift)[last]


def _batch(columns: list[np.ndarray], names: str) -> pa.RecordBatch:
    kinds = {"long": np.int64, "int": np.int32}
    pairs = [x.split() for x in names.split(", ")]
    arrays = [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(kinds[k]))
              for c, (_, k) in zip(columns, pairs)]
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in pairs])


def _parser(length: int):
    """Step 1, and step 2 as far as one block of documents can tell."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            data, offsets = binary_views(batch.column("body"))
            for first, at, part, inner in _pieces(data, offsets, length):
                row, trigger, content, place = parse_bytes(part, inner, length)
                doc, place = ids[first + row], place + (at << 16)
                order = np.lexsort((place, doc, content, trigger))
                trigger, content, doc, place = trigger[order], content[order], doc[order], place[order]
                new_trigger, new_content = _first_of_kind(trigger, content)
                kinds = np.bincount(np.cumsum(new_trigger) - 1, weights=new_content)
                several = kinds[np.cumsum(new_trigger) - 1] > 1
                ask = new_content & ~several
                told = new_trigger & several
                for rows, state in ((ask, ASK), (told, TOLD)):
                    yield _batch([trigger[rows], content[rows], doc[rows], place[rows],
                                  np.full(rows.sum(), state)], PHRASE)
                # Settled rows travel under a key of their own, so that no partition gathers them.
                open_ = new_content & several
                own = mix(place[open_].astype(np.uint64) ^ trigger[open_] ^ doc[open_].astype(np.uint64))
                yield _batch([own, content[open_], doc[open_], place[open_],
                              np.full(open_.sum(), OPEN)], PHRASE)
                start, _, count = _unpack(place[~new_content])
                ranges = _merged(doc[~new_content], start, start + count - 1 + length)
                own = mix(ranges[1].astype(np.uint64) ^ mix(ranges[0].astype(np.uint64)))
                yield _batch([own, ranges[1], ranges[0], ranges[2],
                              np.full(len(own), MARK)], PHRASE)
    return parse


def _settled(phrases: DataFrame, length: int) -> DataFrame:
    """Step 2 over all documents: ``doc_id, state (MARK or OPEN), begin, finish, place``.

    A window over the rows of a trigger, which Spark sorts and spills.
    """
    order = Window.partitionBy("trigger").orderBy("content", "doc_id", "place")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    later = F.coalesce(F.lag("content").over(order) == F.col("content"), F.lit(False))
    several = ((F.min("content").over(whole) != F.max("content").over(whole))
               | (F.max("state").over(whole) == TOLD))
    state = (F.when(F.col("state") <= OPEN, F.col("state"))
             .when(F.col("state") == TOLD, F.lit(None))
             .when(F.col("later"), MARK).when(F.col("several"), OPEN))
    start = F.shiftright("place", 16)
    count = F.col("place").bitwiseAND(255)
    given = F.col("was") == MARK
    return (phrases.withColumns({"later": later, "several": several})
            .select("doc_id", F.col("state").alias("was"), state.alias("state"), "content", "place")
            .where("state is not null")
            .select("doc_id", "state", F.when(given, F.col("content")).otherwise(start).alias("begin"),
                    F.when(given, F.col("place")).otherwise(start + count + (length - 1)).alias("finish"),
                    "place")
            .repartition("doc_id"))


def _words(data: np.ndarray, at: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """``CELL - 1`` bytes from ``at`` on (backwards for step -1) as two ordered integers."""
    both = []
    for k in (range(8), range(8, CELL - 1)):
        word = np.zeros(len(at), np.uint64)
        for j in k:
            byte = data[np.clip(at + step * j, 0, len(data) - 1)].astype(np.uint64)
            word |= byte << np.uint64(56 - 8 * (j % 8))
        both.append(word)
    return both[0], both[1]


def _cells(length: int):
    """Step 3: cuts open phrases into cells, and marks later copies of a cell in one block."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            data, offsets = binary_views(batch.column("body"))
            places = batch.column("places")
            flat, at = places.flatten().to_numpy(), np.asarray(places.offsets)
            at = at - at[0]
            for first, end in row_blocks(offsets):
                part = data[offsets[first]:offsets[end]]
                row = np.repeat(np.arange(first, end), np.diff(at[first:end + 1]))
                start, distance, count = _unpack(flat[at[first]:at[end]])
                trigger = start + distance + offsets[row] - offsets[first]
                near = distance - count + 1                       # distance of the last window
                span = distance // CELL - near // CELL + 1
                pick = np.repeat(np.arange(len(row)), span)
                cell = distance[pick] // CELL - (np.arange(len(pick)) - np.repeat(np.cumsum(span) - span, span))
                far = np.minimum(distance[pick], cell * CELL + CELL - 1)
                close = np.maximum(near[pick], cell * CELL)
                core = trigger[pick] - cell * CELL
                size = length - CELL + 1
                cores = [SpanHash(part, b).spans(core, core + size) for b in (BASE_A, BASE_B)]
                cores[0] ^= cell.astype(np.uint64)
                left = _words(part, core - 1, -1)
                right = _words(part, core + size, 1)
                doc = ids[row[pick]]
                begin = start[pick] + distance[pick] - far
                place = _pack(begin, far - cell * CELL, far - close + 1)
                text = SpanHash(part, BASE_A).spans(core - far % CELL, core + size + CELL - 1 - close % CELL)
                text ^= (place & 0xFFFF).astype(np.uint64)
                order = np.lexsort((begin, doc, text, cores[1], cores[0]))
                _, new = _first_of_kind(cores[0][order], text[order])
                new |= np.append(True, cores[1][order][1:] != cores[1][order][:-1]) if len(new) else new
                keep, copy = order[new], order[~new]
                yield _batch([*(x[keep] for x in (*cores, *left, *right)), doc[keep], place[keep],
                              np.full(len(keep), OPEN)], CELLS)
                stop = begin + (far - close) + length
                ranges = _merged(doc[copy], begin[copy], stop[copy])
                own = mix(ranges[1].astype(np.uint64) ^ mix(ranges[0].astype(np.uint64)))
                yield _batch([own, ranges[1], *[ranges[2]] * 4, ranges[0], ranges[2],
                              np.full(len(own), MARK)], CELLS)
    return cut


def _classes(new_core: np.ndarray, words: tuple[np.ndarray, np.ndarray], order: np.ndarray
             ) -> list[np.ndarray]:
    """Suffix order's classes by depth: rows with equal cores and first ``depth`` bytes."""
    change = [np.append(np.uint64(0), w[order][1:] ^ w[order][:-1]) for w in words]
    start = np.append(True, new_core)
    out = []
    for depth in range(CELL):
        high = np.uint64((1 << 64) - (1 << 64 - 8 * min(depth, 8)))
        low = np.uint64((1 << 64) - (1 << 64 - 8 * max(depth - 8, 0)))
        differs = start | ((change[0] & high) != 0) | ((change[1] & low) != 0)
        of = np.empty(len(order), np.int64)
        of[order] = np.cumsum(differs)
        out.append(of)
    return out


def _repeated(core_a, core_b, left, right, doc, place) -> tuple[np.ndarray, ...]:
    """Document, start and finish (without ``length``) of the repeated windows of whole core groups."""
    start, far, count = _unpack(place)
    first = np.lexsort((start, doc))
    core_a, core_b, doc, start, far, count = (x[first] for x in (core_a, core_b, doc, start, far, count))
    left, right = ([w[first] for w in side] for side in (left, right))
    ranked = []
    for words in (left, right):
        order = np.lexsort((words[1], words[0], core_b, core_a))
        a, b = core_a[order], core_b[order]
        ranked.append(_classes((a[1:] != a[:-1]) | (b[1:] != b[:-1]), words, order))
    docs, begins = [], []
    for depth in range(CELL):
        rows = np.flatnonzero((depth <= far) & (depth > far - count))
        kind = ranked[0][depth][rows] * (len(doc) + 1) + ranked[1][CELL - 1 - depth][rows]
        order = np.argsort(kind, kind="stable")
        same = np.append(False, kind[order][1:] == kind[order][:-1]) if len(rows) else np.zeros(0, bool)
        again = rows[order[same]]
        docs.append(doc[again])
        begins.append(start[again] + far[again] - depth)
    doc, begin = np.concatenate(docs), np.concatenate(begins)
    return doc, begin


def _corpus_order(length: int, rows_at_once: int = 200_000):
    """Step 3 on a partition sorted by core: whole groups, some at a time."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        waiting: list[pa.RecordBatch] = []
        size = 0

        def flush(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, waiting, size
            columns = [np.concatenate([b.column(i).to_numpy() for b in waiting]) for i in range(9)] if waiting else None
            if held is not None:
                columns = held if columns is None else [np.concatenate(x) for x in zip(held, columns)]
            waiting, size, held = [], 0, None
            if columns is None or not len(columns[0]):
                return
            end = len(columns[0])
            if not final:
                last = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1])
                end -= int(last[::-1].argmin()) or end
                held = [c[end:] for c in columns]
            ready = [c[:end] for c in columns]
            marked = ready[8] == MARK
            given = [ready[6][marked], ready[1][marked], ready[7][marked]]
            words = [c[~marked].view(np.uint64) for c in ready[:6]]
            doc, begin = _repeated(words[0], words[1], words[2:4], words[4:6], ready[6][~marked], ready[7][~marked])
            yield _batch(list(_merged(np.append(doc, given[0]), np.append(begin, given[1]),
                                      np.append(begin + length, given[2]))), RANGE)

        for batch in batches:
            waiting.append(batch)
            size += len(batch)
            if size >= rows_at_once:
                yield from flush(False)
        yield from flush(True)
    return compare


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removes the ranges of each document: spans and the bytes left."""
    for batch in batches:
        data, offsets = binary_views(batch.column("body"))
        ranges = batch.column("ranges")
        at = np.asarray(ranges.offsets) - np.asarray(ranges.offsets)[0]
        pairs = ranges.flatten()
        begin, finish = (pairs.field(i).to_numpy() for i in range(2))
        for first, end in row_blocks(offsets):
            part = data[offsets[first]:offsets[end]]
            inner = offsets[first:end + 1] - offsets[first]
            shift = np.repeat(inner[:-1], np.diff(at[first:end + 1]))
            delta = np.zeros(len(part) + 1, np.int32)
            np.add.at(delta, begin[at[first]:at[end]] + shift, 1)
            np.add.at(delta, finish[at[first]:at[end]] + shift, -1)
            gone = np.cumsum(delta)[:-1] > 0
            left = np.concatenate([[0], np.cumsum(~gone)])[inner]
            edge = gone.copy()
            edge[1:] &= ~gone[:-1]
            row_starts = inner[:-1][np.diff(inner) > 0]
            edge[row_starts] = gone[row_starts]
            stop = gone.copy()
            stop[:-1] &= ~gone[1:]
            row_ends = inner[1:][np.diff(inner) > 0] - 1
            stop[row_ends] = gone[row_ends]
            begins, ends = np.flatnonzero(edge), np.flatnonzero(stop) + 1
            row = np.searchsorted(inner, begins, side="right") - 1
            spans = pa.StructArray.from_arrays(
                [pa.array(begins - inner[row]), pa.array(ends - inner[row])], ["begin", "finish"])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(first, end - first), batch.column("body").slice(first, end - first),
                pa.ListArray.from_arrays(pa.array(np.searchsorted(begins, inner), pa.int32()), spans),
                pa.Array.from_buffers(pa.binary(), end - first, [
                    None, pa.py_buffer(left.astype(np.int32)), pa.py_buffer(part[~gone])]),
            ], ["doc_id", "body", "spans", "kept"])


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``doc_id, body, spans, kept``: each document's bytes, the maximal ranges
    removed from it, and the bytes left.

    Null texts are empty; documents shorter than ``length`` stay whole; other
    columns are not read.  Rows without an id are left out; of rows with one
    id the smallest text counts.  ``length`` is 64 to 140.
    """
    if not 2 * TRIGGER <= length <= 140:
        raise ValueError("length must be 64 to 140")
    bodies = documents.by_id(docs, id_col, text_col)
    settled = _settled(bodies.mapInArrow(_parser(length), PHRASE), length)
    open_ = (settled.where(F.col("state") == OPEN).groupBy("doc_id")
             .agg(F.collect_list("place").alias("places")))
    compared = (bodies.join(open_, "doc_id").select("doc_id", "body", "places")
                .mapInArrow(_cells(length), CELLS)
                .repartition("core_a").sortWithinPartitions("core_a", "core_b")
                .mapInArrow(_corpus_order(length), RANGE))
    ranges = (settled.where(F.col("state") == MARK).select("doc_id", "begin", "finish")
              .unionByName(compared).groupBy("doc_id")
              .agg(F.collect_list(F.struct("begin", "finish")).alias("ranges")))
    empty = F.array().cast("array<struct<begin:bigint,finish:bigint>>")
    return (bodies.join(ranges, "doc_id", "left")
            .select("doc_id", "body", F.coalesce("ranges", empty).alias("ranges"))
            .mapInArrow(_cutter, "doc_id long, body binary, "
                                 "spans array<struct<begin:bigint,finish:bigint>>, kept binary"))


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """What is left of every document without 100-byte strings that start earlier."""
    out = remove_repeats(documents.read(spark, sf_dir, "documents"), 100)
    return out.select(
        "doc_id", F.length("body").cast("long").alias("n_bytes"),
        (F.length("body") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
