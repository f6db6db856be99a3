"""Words of whole Arrow batches as numpy arrays, without a Python loop over rows.

A word is a maximal run of ASCII letters, digits and characters beyond ASCII,
but for the Latin-1, general and CJK punctuation blocks. Callers lower the text
in Spark. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_BASE = np.uint64(0x100000001B3)
_GRAM = np.uint64(0x9E3779B97F4A7C15)


class Words(NamedTuple):
    """`hash`, `start` and `end` (bytes in `data`) of each word; row r has the words
    first[r] to first[r + 1]."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    data: np.ndarray

    def text(self, i: int) -> str:
        return self.data[self.start[i]:self.end[i]].tobytes().decode("utf-8", "replace")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offset of each, nulls as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


_LOWERED = np.array([i + 32 if 65 <= i <= 90 else i for i in range(256)], np.uint8)


def ascii_lower(texts: pa.Array) -> pa.Array:
    """All texts with A-Z lowered and nothing else, nulls as empty. (Arrow's kernel misreads slices of a batch.)"""
    data, offsets = text_buffers(texts)
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(_LOWERED[data]))


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of `batch` with about `size` bytes of text each, one row at least."""
    _, offsets = text_buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


_ASCII_WORD = np.array([chr(i).isalnum() if i < 128 else True for i in range(256)])


def _word_bytes(data: np.ndarray) -> np.ndarray:
    word = _ASCII_WORD[data]
    for lead, seconds, width in ((0xC2, range(0x80, 0xC0), 2), (0xE2, (0x80, 0x81), 3), (0xE3, (0x80,), 3)):
        at = np.flatnonzero(data == lead)
        at = at[at + width <= len(data)]
        at = at[np.isin(data[at + 1], list(seconds))]
        for i in range(width):
            word[at + i] = False
    return word


def not_space(data: np.ndarray) -> np.ndarray:
    return (data != 32) & ((data < 9) | (data > 13))


def split_words(texts: pa.Array, word_bytes: Callable[[np.ndarray], np.ndarray] | None = None) -> Words:
    """Words of all texts; `word_bytes` marks the bytes of words, in place of the rule above."""
    data, offsets = text_buffers(texts)
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint64), none, none, np.zeros(len(offsets), np.int64), data)
    word = (word_bytes or _word_bytes)(data)
    breaks = np.zeros(len(data) + 1, bool)
    breaks[offsets] = True
    starts = word.copy()
    starts[1:] &= ~word[:-1] | breaks[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | breaks[1:-1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    if not len(start):
        return Words(np.zeros(0, np.uint64), start, end, first, data)
    size = end - start
    power = np.ones(int(size.max()), np.uint64)
    power[1:] = _BASE
    power = np.cumprod(power)
    begin = np.cumsum(size) - size
    inside = np.arange(int(size.sum())) - np.repeat(begin, size)
    value = (data[word].astype(np.uint64) + np.uint64(1)) * power[inside]
    return Words(mix(np.add.reduceat(value, begin) + size.astype(np.uint64)), start, end, first, data)


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of each element."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def grams(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of `k` words in each row, and the first run of each row.

    A row with fewer words has one run, of all its words; a row without words
    has none.
    """
    count = np.diff(first)
    runs = np.where(count >= k, count - k + 1, (count > 0).astype(count.dtype))
    to = np.concatenate(([0], np.cumsum(runs)))
    at = np.arange(to[-1]) - np.repeat(to[:-1] - first[:-1], runs)
    size = np.repeat(np.minimum(count, k), runs)
    out = np.zeros(len(at), np.uint64)
    for j in range(k):
        more = size > j
        out[more] = out[more] * _GRAM + hashes[at[more] + j]
    return mix(out + size.astype(np.uint64)), to
