"""Vectorised text primitives for Arrow batches: byte buffers, words, word
hashes and windows of word hashes, for all documents of a slice at once.

A slice holds at most ``SLICE_BYTES`` of text, or one longer document; the
working memory is about 60 bytes per byte of the slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18

_MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_MULT), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _MULT)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words between blanks: anything but 0x20 and 0x09-0x0D.
BLANK_WORDS = np.ones(256, bool)
BLANK_WORDS[[0x20, 9, 10, 11, 12, 13]] = False

#: Words of letters and digits after lower-casing, and of all non-ASCII bytes.
ALNUM_WORDS = np.zeros(256, bool)
ALNUM_WORDS[0x30:0x3A] = True
ALNUM_WORDS[0x61:0x7B] = True
ALNUM_WORDS[0x80:] = True

_POW: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    have = _POW.get(int(base))
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 16 * SLICE_BYTES:
            _POW[int(base)] = have
    return have[:n]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Consecutive row ranges of the batch with their bytes and offsets."""
    data, offsets = buffers(batch.column(batch.schema.get_field_index(text)))
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield batch.slice(i, j - i), data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


class Words:
    """The words of a slice: byte ranges, 64-bit hashes and, per document, the
    range of its words.  A word never crosses a document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, alphabet: np.ndarray):
        n = len(data)
        self.data = low = LOWER[data]
        inside = np.zeros(n + 2, bool)
        inside[1:n + 1] = alphabet[low]
        cut = np.zeros(n + 2, bool)
        cut[offsets] = True  # cut[i]: a document begins at byte i
        mark = inside[1:n + 1]
        self.start = np.flatnonzero(mark & (~inside[:n] | cut[:n]))
        self.end = np.flatnonzero(mark & (~inside[2:] | cut[1:n + 1])) + 1
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODE[low] * _powers(_MULT, n), out=total[1:])
        back = _powers(_INV, n)
        self._total, self._back = total, back
        self.hash = self._hash(self.end)
        self.first = np.searchsorted(self.start, offsets)  # words of document d: first[d]:first[d + 1]
        self.count = np.diff(self.first)

    def _hash(self, end: np.ndarray) -> np.ndarray:
        return mix((self._total[end] - self._total[self.start]) * self._back[self.start]
                   + (end - self.start).astype(np.uint64) * _MULT)

    def prefix_hash(self, size: int) -> np.ndarray:
        """Hash of each word's first ``size`` bytes, or of the whole word."""
        return self._hash(np.minimum(self.start + size, self.end))

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def windows(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``k`` consecutive words inside a document, and
    the index of the first word of each."""
    at = np.arange(len(words.hash))
    last = np.repeat(words.first[1:], words.count)
    at = at[at + k <= last]
    return hash_runs(words.hash, at, k), at


def hash_runs(hashes: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    out = np.full(len(at), k * int(_MULT) % 2 ** 64, np.uint64)
    for j in range(k):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[at + j]
    return mix(out)
