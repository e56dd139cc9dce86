"""Runs: maximal stretches of words that repeat with a period.

1. **Words.**  A task takes its documents in blocks; equal words of a block get equal
   numbers, and a zero stands behind each document, so that nothing matches across it.
2. **Harmonic grid.**  A run of period ``p`` holds a grid place ``i``, a multiple of ``p``, with
   ``i + p`` inside, too.  So all runs come from the places ``0, p, 2p, ...`` of every ``p`` up to half
   the words: ``n log n`` pairs, of which only those with equal words go on.  The longest common
   extensions (LCE) of a pair to the right and to the left give the run's ends.
3. **LCE by difference cover.**  Modulo ``MODULUS``, any two places reach sampled places by one common
   step of fewer than ``MODULUS`` words.  Those few words are compared directly, which ends most
   pairs.  For documents with pairs that are still equal then, the sampled suffixes alone are
   sorted (by doubling), and the range minimum of their common prefixes, from a
   sparse table, is the rest of the extension.  The left extension uses the reversed words.
4. **Runs.**  A stretch found with several periods has the smallest of them (the others are
   its multiples).

Documents don't meet, so nothing is shuffled.  A task holds one block, or one longer
document; pairs are made in slices of ``PAIRS``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from paylater.llm import documents
from paylater.llm.blocks import binary_views, row_blocks
from paylater.llm.vocabulary import WordTable

MODULUS = 21
COVER = (0, 1, 4, 14, 16)         # every difference modulo 21 is one of two of these
PAIRS = 1 << 21
MIN_WORDS = 12


def _steps(modulus: int, cover: tuple[int, ...]) -> np.ndarray:
    """For two remainders, the least step that takes both into the cover."""
    inside = np.isin(np.arange(modulus), cover)
    step = np.full((modulus, modulus), -1, np.int64)
    at = np.arange(modulus)
    for d in range(modulus - 1, -1, -1):
        moved = inside[(at + d) % modulus]
        step[moved[:, None] & moved[None, :]] = d
    if (step < 0).any():
        raise ValueError("not a difference cover")
    return step


STEP = _steps(MODULUS, COVER)


class CommonExtensions:
    """LCE to the right of places of one word array, in which zeros separate documents.

    ``document`` numbers the document of every place; both places of a query lie in one document.
    """

    def __init__(self, words: np.ndarray, document: np.ndarray):
        self.n = len(words)
        # beyond the end, as behind a document, nothing matches
        self.words = np.concatenate([words, np.zeros(2 * MODULUS, words.dtype)])
        self.document = document
        self._ready = None

    def extend(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal words from ``a`` and ``b`` on (``a < b``, elementwise)."""
        need = STEP[a % MODULUS, b % MODULUS]
        out = np.zeros(len(a), np.int64)
        live = np.flatnonzero(need > 0)
        equal = need == 0
        done = 0
        while len(live):
            same = self.words[a[live] + done] == self.words[b[live] + done]
            live = live[same]
            done += 1
            out[live] = done
            reached = need[live] == done
            equal[live[reached]] = True
            live = live[~reached]
        rest = np.flatnonzero(equal)
        # a sampled pair of different words needs no suffix order
        x, y = a[rest] + need[rest], b[rest] + need[rest]
        go = self.words[x] == self.words[y]
        rest, x, y = rest[go], x[go], y[go]
        if len(rest):
            out[rest] += self._sampled(x, y)
        return out

    def _sampled(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        documents_here = np.unique(self.document[x])
        if self._ready is None or not np.isin(documents_here, self._ready).all():
            known = [] if self._ready is None else [self._ready]
            self._ready = np.unique(np.concatenate([*known, documents_here]))
            self._sort(np.isin(self.document, self._ready))
        i, j = self.place[x], self.place[y]
        low, high = np.minimum(i, j) + 1, np.maximum(i, j)
        level = np.frexp((high - low + 1).astype(float))[1] - 1
        return np.minimum(self.table[level, low], self.table[level, high - (1 << level) + 1])

    def _sort(self, wanted: np.ndarray) -> None:
        """Order of the sampled suffixes of the wanted documents, and a sparse table of
        the common prefixes of neighbours."""
        at = np.flatnonzero(wanted)
        at = at[np.isin(at % MODULUS, COVER)]
        m, top = len(at), int(self.words.max()) + 1
        index = np.full(self.n + MODULUS, -1, np.int64)
        index[at] = np.arange(m)
        # blocks of MODULUS words, by columns of as many words as one integer holds
        each = max(1, 62 // max(1, (top - 1).bit_length()))
        columns = []
        for low in range(0, MODULUS, each):
            key = np.zeros(m, np.int64)
            for t in range(low, min(low + each, MODULUS)):
                key = key * top + self.words[at + t]
            columns.append(key)
        columns.insert(0, self.document[at])          # documents don't mix
        order = np.lexsort(columns[::-1])
        changed = np.zeros(m, bool)
        for c in columns:
            changed[1:] |= c[order][1:] != c[order][:-1]
        rank = np.empty(m, np.int64)
        rank[order] = np.cumsum(changed)
        # doubling: the suffix behind a block starts MODULUS words on, at a sampled place again
        nexts = np.where(at + MODULUS < self.n, index[np.minimum(at + MODULUS, self.n - 1)], -1)
        nexts = np.where((nexts >= 0) & (self.document[at] == self.document[at[nexts]]), nexts, -1)
        levels = [(rank, nexts)]
        while rank.max(initial=0) < m - 1:
            key = (rank << 32) + np.where(nexts >= 0, rank[nexts] + 1, 0)
            order = np.argsort(key, kind="stable")
            rank = np.empty(m, np.int64)
            rank[order] = np.cumsum(np.concatenate([[False], np.diff(key[order]) != 0]))
            nexts = np.where(nexts >= 0, nexts[nexts], -1)
            levels.append((rank, nexts))
        # neighbours' common prefixes: whole blocks by falling level, then single words
        common = np.zeros(m, np.int64)
        first, second = order[:-1].copy(), order[1:].copy()
        live = np.flatnonzero(self.document[at[first]] == self.document[at[second]])
        for k in range(len(levels) - 1, -1, -1):
            rank_k, next_k = levels[k]
            same = live[rank_k[first[live]] == rank_k[second[live]]]
            # equal whole blocks go on in both suffixes: else a zero would stand at two places
            same = same[(next_k[first[same]] >= 0) & (next_k[second[same]] >= 0)]
            common[same + 1] += MODULUS << k
            first[same], second[same] = next_k[first[same]], next_k[second[same]]
        left, right = at[first], at[second]
        for _ in range(MODULUS):
            live = live[self.words[left[live]] == self.words[right[live]]]
            common[live + 1] += 1
            left[live] += 1
            right[live] += 1
        self.place = np.full(self.n + MODULUS, -1, np.int64)
        self.place[at[order]] = np.arange(m)
        table = [common]
        while 2 << (len(table) - 1) <= m:
            half = 1 << (len(table) - 1)
            table.append(np.concatenate([np.minimum(table[-1][:-half], table[-1][half:]), table[-1][-half:]]))
        self.table = np.array(table)


def _grid(starts: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods of the harmonic grid of all documents, in slices of about ``PAIRS``."""
    halves = counts // 2
    doc = np.repeat(np.arange(len(counts)), halves)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(halves) - halves, halves) + 1
    size = -(-(counts[doc] - period) // period)       # places i = 0, p, ... with i + p < n
    ends = np.cumsum(size)
    low = 0
    while low < len(doc):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + PAIRS, side="right")))
        n = size[low:high]
        p = np.repeat(period[low:high], n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(starts[doc[low:high]], n) + k * p, p
        low = high


def runs_of(words: np.ndarray, starts: np.ndarray, counts: np.ndarray, least: int = MIN_WORDS
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``document, start, length, period`` of every run of ``least`` words and two periods or more, by
    document, start and period.

    ``words`` holds the numbers (from 1) of all documents' words, with one zero behind each document;
    document ``d`` has ``counts[d]`` words from ``starts[d]`` on.
    """
    document = np.repeat(np.arange(len(counts)), counts + 1)
    forward = CommonExtensions(words, document)
    # reversed, with a zero behind each document again: place x is now at len(words) - 2 - x
    backward = CommonExtensions(np.append(words[:-1][::-1], 0),
                                np.repeat(np.arange(len(counts))[::-1], counts[::-1] + 1))
    found = []
    for i, p in _grid(starts, np.where(counts >= least, counts, 0)):
        keep = words[i] == words[i + p]
        i, p = i[keep], p[keep]
        right = forward.extend(i, i + p)
        # to the left of i and i + p
        left = np.zeros(len(i), np.int64)
        inner = np.flatnonzero(i > starts[document[i]])
        left[inner] = backward.extend(len(words) - 1 - i[inner] - p[inner], len(words) - 1 - i[inner])
        keep = right + left >= np.maximum(p, least - p)
        i, p, right, left = i[keep], p[keep], right[keep], left[keep]
        found.append(np.unique(np.stack([i - left, i + p + right, p], 1), axis=0))
    whole = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    whole = whole[np.lexsort((whole[:, 2], whole[:, 1], whole[:, 0]))]
    first = np.ones(len(whole), bool)                 # the smallest period of a stretch
    first[1:] = (whole[1:, :2] != whole[:-1, :2]).any(axis=1)
    start, end, period = whole[first].T
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    doc = document[start]
    return doc, start - starts[doc], end - start, period


# Word places of a document after an edit: (doc_id, number of words) -> the original place of each word.
Edit = Callable[[int, int], np.ndarray]

RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
    ("collapsed", pa.binary())])
RESULT_DDL = ("doc_id bigint, n_words bigint, "
              "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary")


def _block(ids: list, bodies: list[bytes], edit: Edit | None, least: int) -> pa.RecordBatch:
    texts = [b.split() for b in bodies]              # ASCII white space separates words
    if edit is not None:
        texts = [_edited(i, t, edit) for i, t in zip(ids, texts)]
    table = WordTable()
    counts = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(counts + 1) - counts - 1
    words = np.zeros(int((counts + 1).sum()), np.int64)
    for s, t in zip(starts, texts):
        if t:
            words[s:s + len(t)] = table.places(t)
            words[s:s + len(t)] += 1
    doc, start, length, period = runs_of(words, starts, counts, least)
    at = np.searchsorted(doc, np.arange(len(texts) + 1))
    kept = []
    for d, t in enumerate(texts):
        low, high = at[d], at[d + 1]
        if low == high:
            kept.append(b" ".join(t))
            continue
        change = np.zeros(len(t) + 1, np.int64)
        np.add.at(change, start[low:high] + period[low:high], 1)
        np.add.at(change, start[low:high] + length[low:high], -1)
        kept.append(b" ".join([t[k] for k in np.flatnonzero(np.cumsum(change)[:-1] == 0)]))
    runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)],
                                      ["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(counts), pa.ListArray.from_arrays(pa.array(at, pa.int32()), runs),
         pa.array(kept, pa.binary())], schema=RESULT)


def _edited(doc_id, words: list[bytes], edit: Edit) -> list[bytes]:
    return [words[k] for k in edit(doc_id, len(words))] if doc_id is not None and words else words


def _finder(edit: Edit | None, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = binary_views(batch.column("body"))
            for low, high in row_blocks(at):
                yield _block(batch.column("doc_id").slice(low, high - low).to_pylist(),
                             [data[at[i]:at[i + 1]].tobytes() for i in range(low, high)], edit, least)
    return run


def find_runs(docs: DataFrame, least: int = MIN_WORDS, edit: Edit | None = None, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row of ``docs``, one for one.

    Words are what ASCII white space separates.  ``runs`` holds ``(start, length, period)`` by start,
    then period; ``collapsed`` is the text (as UTF-8) with single spaces and without the words that a run
    holds behind its first period.  Null, empty and blank texts have no words and no run.  Rows with a
    null id stay (with a null id, and without ``edit``), repeated ids and rows, too.  Other columns
    are not read.
    """
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), documents.text_bytes(text_col).alias("body"))
    return rows.mapInArrow(_finder(edit, least), RESULT_DDL)


def planted_tail(doc_id: int, n: int) -> np.ndarray:
    """The edit of the registered query: a tenth of all documents gets a periodic tail."""
    h = zlib.crc32(str(doc_id).encode())
    places = np.arange(n)
    if h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        places[a:] = a + (places[a:] - a) % p
    return places


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns of the registered query from ``find_runs``."""
    for batch in batches:
        out: dict[str, list] = {k: [] for k in DIGEST.names}
        for doc_id, runs, kept in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "runs", "collapsed"))):
            listed = [(r["start"], r["length"], r["period"]) for r in runs]
            best = min(listed, key=lambda r: (-r[1], r[0], r[2]), default=None)
            text = "".join(f"{s},{n},{p}\n" for s, n, p in listed)
            values = (doc_id, len(listed), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                      hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())
            for column, value in zip(out.values(), values):
                column.append(value)
        yield pa.RecordBatch.from_pydict(out, schema=DIGEST)


DIGEST = pa.schema([("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()),
                    ("collapsed_sha256", pa.string())])
DIGEST_DDL = ("doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
              "runs_sha256 string, collapsed_sha256 string")


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of every document, a tenth of which has a planted periodic tail."""
    found = find_runs(documents.read(spark, sf_dir, "documents"), edit=planted_tail)
    return found.mapInArrow(_digests, DIGEST_DDL)
