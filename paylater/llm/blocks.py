"""Numpy helpers on blocks of documents: byte buffers, rolling hashes, shingles.

A task never holds more than one block of text as arrays: Arrow batches are
cut into blocks of about ``BLOCK_BYTES``; a longer document is a block alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

# Odd multipliers of the polynomial hashes modulo 2**64.
BASE_A = 0x9E3779B97F4A7C15
BASE_B = 0xD6E8FEB86659FD93
BASE_WORDS = 0xC2B2AE3D27D4EB4F


def binary_views(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a binary or string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or
                                  pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32,
                            len(column) + 1 + column.offset)[column.offset:].astype(np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole, offsets


def row_blocks(offsets: np.ndarray, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes stay near ``block_bytes`` (one row at least)."""
    n, start = len(offsets) - 1, 0
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + block_bytes, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield start, end
        start = end


class Powers:
    """Powers of a base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self._p = self._i = np.ones(1, np.uint64)

    @staticmethod
    def _table(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.cumprod(out)

    def up_to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._p) < n:
            size = 1 << int(n).bit_length()
            self._p, self._i = self._table(self.base, size), self._table(self.inverse, size)
        return self._p[:n], self._i[:n]


_POWERS = {b: Powers(b) for b in (BASE_A, BASE_B)}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads polynomial hashes evenly."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class SpanHash:
    """64-bit hashes of any byte spans of one buffer, from prefix sums."""

    def __init__(self, data: np.ndarray, base: int = BASE_A):
        n = len(data)
        up, self._down = _POWERS[base].up_to(n + 1)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=self._sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._down[start])

    def windows(self, size: int) -> np.ndarray:
        """Hash of every span of ``size`` bytes, by start."""
        n = len(self._sums) - size
        return mix((self._sums[size:] - self._sums[:-size]) * self._down[:n])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    size, out = 1, values
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


# ASCII bytes that separate words (space, tab to carriage return).
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

KNOWN_WORDS = 200_000
SHORT = 7                 # bytes of a word that are its hash, but for mixing
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(SHORT + 1)], np.uint64)
_TOP = 1 << 63


class LongWords(dict):
    """63 bits of the BLAKE2b digests of words, computed once while the table is small."""

    def __missing__(self, word: bytes) -> int:
        found = int.from_bytes(blake2b(word, digest_size=8).digest(), "little") & _TOP - 1
        if len(self) < KNOWN_WORDS and len(word) <= 64:
            self[word] = found
        return found


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of each document (ASCII lower case), and word offsets by document.

    ``offsets`` are the documents' byte offsets in ``data``; words never cross them.  Words of ``SHORT`` bytes never
    collide; longer ones have a cryptographic hash, as a polynomial modulo 2**64 collides on
    words that anyone can construct (Thue-Morse), whatever its base.
    """
    low = np.concatenate([_LOWER[data], np.zeros(8, np.uint8)])
    inside = ~_SPACE[low[:-8]]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edges[1:] - 1] = inside[edges[1:] - 1]
    ends = np.flatnonzero(last) + 1
    size = ends - starts
    loads = np.ndarray((len(low) - 7,), np.dtype("<u8"), low, strides=(1,))
    value = (loads[starts] & _MASKS[np.minimum(size, SHORT)]) | np.uint64(_TOP)
    # a zero byte could not be told from the end of a short word
    other = size > SHORT
    if (low[:-8] == 0).any():
        held = np.cumsum(np.concatenate([[0], low[:-8] == 0]))
        other |= held[ends] > held[starts]
    rest = np.flatnonzero(other)
    if len(rest):
        raw = low.tobytes()
        words = [raw[a:b] for a, b in zip(starts[rest].tolist(), ends[rest].tolist())]
        value[rest] = np.fromiter(map(_LONG.__getitem__, words), np.uint64, len(rest))
    return mix(value), np.searchsorted(starts, offsets)


_LONG = LongWords()


def shingle_hashes(words: np.ndarray, word_offsets: np.ndarray, size: int
                   ) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``size``-word shingle by document; a document with fewer
    words (one at least) gives its whole sequence as one shingle."""
    counts = np.diff(word_offsets)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(made)])
    out = np.empty(offsets[-1], np.uint64)
    doc = np.repeat(np.arange(len(counts)), made)
    at = np.arange(offsets[-1]) - offsets[doc] + word_offsets[doc]
    full = counts[doc] >= size
    total = np.zeros(len(at), np.uint64)
    factor = 1
    for j in range(size):
        here = full | (j < counts[doc])
        step = words[np.minimum(at + j, max(len(words) - 1, 0))] * np.uint64(factor) if len(words) else total
        total = total + np.where(here, step, np.uint64(0))
        factor = factor * BASE_WORDS & (1 << 64) - 1
    out[:] = mix(total + np.minimum(counts[doc], size).astype(np.uint64))
    return out, offsets


def distinct_by_row(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, flat, with new offsets."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    values, row = values[keep], row[keep]
    return values, np.searchsorted(row, np.arange(len(offsets)))


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
