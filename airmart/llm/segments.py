"""Texts cut into segments that a SentencePiece model encodes apart, and the distinct segments of a batch.

The cut is a single space between two other characters, neither of them the
marker U+2581; the space belongs to no segment. With `apart` False each text is
one segment. Null counts as an empty text; an empty text is one empty segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from airmart.llm.words import BLOCK_BYTES, Spans, mixed, text_bytes

MARK = "▁"
_CODES = mixed(np.arange(1, 257, dtype=np.uint64))
_MARK = MARK.encode()


class Segments:
    """Of each segment of a batch, in order, which of the distinct ones it is; their hashes, ascending; and where those of each text begin."""

    def __init__(self, texts: pa.Array, apart: bool):
        data, off = text_bytes(texts)
        starts, ends, hashes, counts = [], [], [], []
        at, n = 0, len(texts)
        while at < n:  # hashed block by block, as that takes 8 bytes for each byte of text
            to = max(at + 1, int(np.searchsorted(off, off[at] + BLOCK_BYTES, side="right")) - 1)
            block, own = data[off[at] : off[to]], off[at : to + 1] - off[at]
            cut = cuts(block, own) if apart else np.zeros(0, np.int64)
            where = np.searchsorted(cut, own)
            start = np.sort(np.concatenate([own[:-1], cut + 1]), kind="stable")
            end = np.sort(np.concatenate([own[1:], cut]), kind="stable")
            hashes.append(Spans(block, _CODES).hash(start, end))
            starts.append(start + off[at])
            ends.append(end + off[at])
            counts.append(np.diff(where) + 1)
            at = to
        join = lambda x, kind=np.int64: np.concatenate(x) if x else np.zeros(0, kind)
        start, end = join(starts), join(ends)
        self.keys, one, self.code = np.unique(join(hashes, np.uint64), return_index=True, return_inverse=True)
        self.first = np.append(0, np.cumsum(join(counts)))
        raw = data.tobytes()
        self.distinct = [raw[a:b].decode() for a, b in zip(start[one].tolist(), end[one].tolist())]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Of each text, the sum over its segments of the values of the distinct ones."""
        total = np.append(0, np.cumsum(values[self.code]))
        return total[self.first[1:]] - total[self.first[:-1]]


def cuts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Places of the spaces at which the texts are cut."""
    space = data == 32
    at = np.flatnonzero(space)
    if not len(at):
        return at
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    at = at[~edge[at] & ~edge[at + 1]]  # neither first nor last of its text
    at = at[~space[at - 1] & ~space[at + 1]]
    near = np.zeros(len(at), bool)
    for side in (-3, 1):  # the marker before or after
        same = np.ones(len(at), bool)
        for k, byte in enumerate(_MARK):
            place = np.clip(at + side + k, 0, len(data) - 1)
            same &= data[place] == byte
        near |= same
    return at[~near]


def slices(texts: pa.Array, most: int = 4 << 20) -> Iterator[pa.Array]:
    """Consecutive parts of a batch of up to `most` bytes each (a longer text is alone), to bound what is held at once."""
    _, off = text_bytes(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, side="right")) - 1)
        yield texts.slice(at, to - at)
        at = to


def balanced(texts: list[str], most: int) -> Iterator[list[str]]:
    """Consecutive texts, up to `most` characters a batch; a longer one is alone."""
    batch: list[str] = []
    size = 0
    for text in texts:
        if batch and size + len(text) > most:
            yield batch
            batch, size = [], 0
        batch.append(text)
        size += len(text)
    if batch:
        yield batch
