"""Token ids in one compressed file: a wavelet matrix of succinct bit-planes.

Plane 0 holds the highest bit of every id in order. Each further plane holds the
next bit after ids were put in order of the bit before, zeros first, stably. The
number of ones before a place (rank) and the place of the k-th one or zero
(select) lead from plane to plane, so one file serves

- `ids(a, b)`, the ids from place a up to b, and `all_ids()`;
- `count(id, a, b)`, how often an id occurs there, in a rank for each plane;
- `positions(id, a, b)`, where it occurs, by selects back up.

Planes are cut into blocks of `BLOCK_BITS`, each a Zstandard frame. A directory has
the frames' places and the ones before each block, so that access reads one block
a plane. A table of documents (id, ids before it) lies beside them, and a footer of
fixed length at the end points to both:

    frames of planes | documents | directory | footer

Ids may have up to 32 bits; an empty file has no planes.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

BLOCK_BITS = 1 << 19
LEVEL = 3
MAGIC = b"IDWM0001"
_FOOTER = struct.Struct("<QQIIQIQI8s")  # ids, documents, planes, bits a block, place and size of documents and directory
_FRAME = np.dtype([("place", "<u8"), ("size", "<u4"), ("ones", "<u8")])


def matrix(ids: np.ndarray, n_planes: int):
    """Bits of each plane, in its order."""
    row = ids.astype(np.uint16 if n_planes <= 16 else np.uint32)
    for bit in range(n_planes - 1, -1, -1):
        ones = (row & row.dtype.type(1 << bit)) != 0
        yield ones
        # Places taken by number are much faster than a mask.
        row = np.concatenate([row.take(np.flatnonzero(~ones)), row.take(np.flatnonzero(ones))])


def ordered_back(planes: list[np.ndarray], n: int) -> np.ndarray:
    """The ids of a matrix, from its last plane up."""
    row = np.zeros(n, np.uint16 if len(planes) <= 16 else np.uint32)
    for k, ones in enumerate(reversed(planes)):
        zero, one = np.flatnonzero(~ones), np.flatnonzero(ones)
        above = np.empty_like(row)
        above[zero] = row[: len(zero)]
        above[one] = row[len(zero) :] | row.dtype.type(1 << k)
        row = above
    return row.astype(np.uint32)


def write_ids(out, ids: np.ndarray, doc_ids: list[int | None], starts: np.ndarray) -> int:
    """Writes ids (unsigned) of documents that begin at `starts` to a binary file; returns its bytes."""
    import zstandard

    press = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
    n_planes = int(ids.max()).bit_length() if len(ids) else 0
    at, frames = 0, []

    def put(data: bytes) -> tuple[int, int]:
        nonlocal at
        packed = press.compress(data)
        out.write(packed)
        at += len(packed)
        return at - len(packed), len(packed)

    for ones in matrix(ids, n_planes):
        before = 0
        for a in range(0, len(ones), BLOCK_BITS):
            part = ones[a : a + BLOCK_BITS]
            frames.append((*put(np.packbits(part, bitorder="little").tobytes()), before))
            before += int(np.count_nonzero(part))
        frames.append((at, 0, before))  # the ones of the whole plane
    known = np.array([i is not None for i in doc_ids], np.uint8)
    numbers = np.array([0 if i is None else i for i in doc_ids], "<i8")
    documents = put(known.tobytes() + numbers.tobytes() + starts.astype("<i8").tobytes())
    directory = put(np.array(frames, _FRAME).tobytes())
    out.write(_FOOTER.pack(len(ids), len(doc_ids), n_planes, BLOCK_BITS, *documents, *directory, MAGIC))
    return at + _FOOTER.size


@dataclass
class Documents:
    ids: list[int | None]
    starts: np.ndarray  # one more, for the end


class WaveletFile:
    """Reads an open seekable binary file that `write_ids` wrote."""

    def __init__(self, file, size: int):
        self.file = file
        file.seek(size - _FOOTER.size)
        self.n, self.n_docs, self.n_planes, self.block_bits, *places, magic = _FOOTER.unpack(file.read(_FOOTER.size))
        if magic != MAGIC:
            raise ValueError("no wavelet matrix ends here")
        self._documents = places[:2]
        blocks = -(-self.n // self.block_bits) + 1 if self.n else 1
        self.directory = np.frombuffer(self._frame(*places[2:]), _FRAME).reshape(self.n_planes, blocks) if self.n_planes else np.zeros((0, blocks), _FRAME)
        self._block = lru_cache(maxsize=4 * max(1, self.n_planes))(self._read_block)

    def _frame(self, place: int, size: int) -> bytes:
        import zstandard

        self.file.seek(place)
        return zstandard.ZstdDecompressor().decompress(self.file.read(size))

    def _read_block(self, plane: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Bits of a block, and the ones before each of its places."""
        frame = self.directory[plane, block]
        n = min(self.block_bits, self.n - block * self.block_bits)
        ones = np.unpackbits(np.frombuffer(self._frame(int(frame["place"]), int(frame["size"])), np.uint8), count=n, bitorder="little").view(bool)
        return ones, np.append(0, np.cumsum(ones, dtype=np.int64)) + int(frame["ones"])

    def documents(self) -> Documents:
        data = self._frame(*self._documents)
        known = np.frombuffer(data, np.uint8, self.n_docs)
        numbers = np.frombuffer(data, "<i8", self.n_docs, self.n_docs).tolist()
        starts = np.frombuffer(data, "<i8", self.n_docs, 9 * self.n_docs)
        return Documents([i if k else None for i, k in zip(numbers, known.tolist())], np.append(starts, self.n))

    # -- rank and select -------------------------------------------------

    def zeros(self, plane: int) -> int:
        return self.n - int(self.directory[plane, -1]["ones"])

    def rank(self, plane: int, places: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        out = np.empty(len(places), np.int64)
        block = np.minimum(places, self.n - 1) // self.block_bits
        for b in np.unique(block).tolist():
            own = block == b
            out[own] = self._block(plane, b)[1][places[own] - b * self.block_bits]
        return out

    def bits(self, plane: int, places: np.ndarray) -> np.ndarray:
        out = np.empty(len(places), bool)
        block = places // self.block_bits
        for b in np.unique(block).tolist():
            own = block == b
            out[own] = self._block(plane, b)[0][places[own] - b * self.block_bits]
        return out

    def select(self, plane: int, one: bool, ranks: np.ndarray) -> np.ndarray:
        """Places of the ones (or zeros) of these ranks, from 0."""
        ones = self.directory[plane]["ones"].astype(np.int64)
        before = ones if one else np.minimum(np.arange(len(ones)) * self.block_bits, self.n) - ones
        block = np.searchsorted(before, ranks, side="right") - 1
        out = np.empty(len(ranks), np.int64)
        for b in np.unique(block).tolist():
            own = block == b
            out[own] = np.flatnonzero(self._block(plane, b)[0] == one)[ranks[own] - before[b]] + b * self.block_bits
        return out

    # -- queries ---------------------------------------------------------

    def all_ids(self) -> np.ndarray:
        planes = []
        for p in range(self.n_planes):
            packed = b"".join(self._frame(int(f["place"]), int(f["size"])) for f in self.directory[p, :-1])
            planes.append(np.unpackbits(np.frombuffer(packed, np.uint8), count=self.n, bitorder="little").view(bool))
        return ordered_back(planes, self.n)

    def ids(self, a: int, b: int) -> np.ndarray:
        """Ids from place a up to b; of each plane only the blocks they lie in are read."""
        at, out = np.arange(max(a, 0), min(b, self.n)), np.zeros(max(0, min(b, self.n) - max(a, 0)), np.uint32)
        for p in range(self.n_planes):
            ones, rank = self.bits(p, at), self.rank(p, at)
            out = out << np.uint32(1) | ones
            at = np.where(ones, self.zeros(p) + rank, at - rank)
        return out

    def _range(self, token: int, a: int, b: int) -> np.ndarray:
        ends = np.array([max(a, 0), min(b, self.n)])
        if token >> self.n_planes or ends[0] >= ends[1]:
            return np.zeros(2, np.int64)
        for p in range(self.n_planes):
            rank = self.rank(p, ends)
            ends = self.zeros(p) + rank if token >> (self.n_planes - 1 - p) & 1 else ends - rank
        return ends

    def count(self, token: int, a: int = 0, b: int = 1 << 62) -> int:
        """Occurrences of an id from place a up to b."""
        first, end = self._range(token, a, b)
        return int(end - first)

    def positions(self, token: int, a: int = 0, b: int = 1 << 62) -> np.ndarray:
        """Places of an id from place a up to b, ascending."""
        at = np.arange(*self._range(token, a, b))
        for p in range(self.n_planes - 1, -1, -1):
            if not len(at):
                break
            one = bool(token >> (self.n_planes - 1 - p) & 1)
            at = self.select(p, one, at - self.zeros(p) if one else at)
        return at
