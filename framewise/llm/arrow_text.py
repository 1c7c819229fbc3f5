"""Texts of Arrow batches as numpy arrays: bytes, words and their hashes.

A chunk holds whole documents of about ``CHUNK_BYTES`` (one longer document is a chunk by
itself), which bounds what a Python worker needs whatever the size of a batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
_MUL = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def given_back(read: Callable) -> Callable:
    """``read`` for ``mapInArrow``, after which the worker gives free memory back: Arrow's pool and the C
    library's heap otherwise stay with a reused worker at the most that any of its tasks needed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from read(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
            if trim is not None:
                trim(0)
    return run


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows end to end, offsets); NULL is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole rows."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def is_word_byte() -> np.ndarray:
    """Bytes of words ``[^\\x20\\x09-\\x0D]+``."""
    return ~_SPACE


def is_alnum_byte() -> np.ndarray:
    """Bytes of words of letters and digits, punctuation left out; all beyond ASCII count as letters."""
    out = np.zeros(256, bool)
    out[48:58] = out[65:91] = out[97:123] = out[128:] = True
    return out


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of the words, and each document's first word as an index (one more entry)."""
    word = inside[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = word
    before[offsets] = False  # a document's edge ends a word
    starts = np.flatnonzero(word & ~before[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = word
    after[offsets] = False
    ends = np.flatnonzero(word & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class Powers:
    """Powers of the hash's base and of its inverse, as many as were needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            steps = np.full(size, _MUL, np.uint64), np.full(size, _INV, np.uint64)
            for s in steps:
                s[0] = 1
            self.up, self.down = (np.multiply.accumulate(s) for s in steps)
        return self.up[:n], self.down[:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """64-bit hash of each word: a polynomial of its bytes (from one running sum over all bytes), mixed with its length."""
    up, down = powers.get(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    poly = (total[ends] - total[starts]) * down[starts]
    return mix64(poly + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of the n-grams of words that lie within a document, in order of their first words."""
    size = len(words) - n + 1
    counts = np.maximum(np.diff(first) - n + 1, 0)
    docs = np.repeat(np.arange(len(counts)), counts)
    if size <= 0 or not len(docs):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sums = np.zeros(size, np.uint64)
    for k in range(n):
        sums = sums * _MUL + words[k:k + size]
    at = np.arange(len(docs)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first[:-1], counts)
    return mix64(sums[at] + np.uint64(n)), docs
