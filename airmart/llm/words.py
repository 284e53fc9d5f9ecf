"""Words and word shingles of an Arrow column of texts, hashed in numpy.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return; A-Z count as a-z. Hashes have 64 bits and are the same
in every process. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_SHINGLE = 0xC2B2AE3D27D4EB4F


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    space = np.zeros(256, bool)
    space[[32, 9, 10, 11, 12, 13]] = True
    codes = mixed(np.arange(1, 257, dtype=np.uint64))
    return lower, space, codes[lower]


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n of each."""
    def row(base: int) -> np.ndarray:
        x = np.full(n, base, np.uint64)
        x[0] = 1
        return np.multiply.accumulate(x)

    return row(_BASE), row(pow(_BASE, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins (one more for the end)."""
    texts = texts.fill_null("") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if offsets is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


class Spans:
    """Hashes of byte ranges of a block of texts, after a table of 64-bit codes per byte."""

    def __init__(self, data: np.ndarray, codes: np.ndarray):
        size = BLOCK_BYTES
        while size < len(data):
            size *= 2
        self.down = _powers(size)[1]
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(codes[data] * _powers(size)[0][: len(data)], out=self.total[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.total[end] - self.total[start]) * self.down[start])


class Words:
    """The words of a block of texts: hash, first and last byte, and of each text its first word."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        _, space, codes = _tables()
        self.data, self.off = data, off
        n = len(data)
        if not n:
            self.start = self.end = np.zeros(0, np.int64)
            self.hash = np.zeros(0, np.uint64)
            self.first = np.zeros(len(off), np.int64)
            return
        inside = ~space[data]
        cut = np.zeros(n + 1, bool)  # a text begins here
        cut[off] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | cut[1:n]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | cut[1:n]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.hash = Spans(data, codes).hash(self.start, self.end)
        self.first = np.searchsorted(self.start, off)

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, k: int) -> np.ndarray:
        """Hashes of the words of text k, in order."""
        return self.hash[self.first[k] : self.first[k + 1]]


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, Words]]:
    """Words of consecutive texts of up to `most` bytes together (a longer text is alone), with the place of the first text."""
    data, off = text_bytes(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, side="right")) - 1)
        yield at, Words(data[off[at] : off[to]], off[at : to + 1] - off[at])
        at = to


def runs(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` word hashes, by its first word."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total, factor = words[:n].copy(), 1
    for j in range(1, width):
        factor = factor * _SHINGLE & MASK
        total += words[j : j + n] * np.uint64(factor)
    return mixed(total + np.uint64(width))


def shingles(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Hashes of all word shingles in order; a shorter text is one shingle, an empty one has none."""
    return runs(words, min(width, len(words))) if len(words) else np.zeros(0, np.uint64)
