"""Reads a SentencePiece model file: the wire format of its message, and the fields that encoding needs."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

MARK = "▁"
# Fixed values of the file format: model types and piece types.
UNIGRAM, BPE, WORD, CHAR = 1, 2, 3, 4
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


@dataclass
class Piece:
    text: str
    score: float = 0.0
    kind: int = NORMAL


@dataclass
class Model:
    pieces: list[Piece] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    suffix_space: bool = False
    unknown_surface: str = " ⁇ "
    charsmap: bytes = b""
    dummy_prefix: bool = True
    strip_spaces: bool = True
    escape_spaces: bool = True

    def unknown_id(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p.kind == UNKNOWN)

    def splits_at_spaces(self) -> bool:
        """No token reaches from another character over the space that follows it."""
        return not self.charsmap and self.dummy_prefix and not self.strip_spaces and self.escape_spaces and not self.suffix_space and not any(
            MARK in p.text.lstrip(MARK) or p.kind == USER_DEFINED for p in self.pieces
        )


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of one message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7)
        if key & 7 == 2:
            size = varint()
        if size is None or at + size > len(data):
            raise ValueError("not a SentencePiece model: unknown or cut field")
        yield key >> 3, data[at : at + size]
        at += size


def read_model(path: str) -> Model:
    with open(path, "rb") as f:
        return parse_model(f.read())


def parse_model(data: bytes) -> Model:
    model = Model()
    for number, value in fields(data):
        if number == 1:
            piece = Piece("")
            for n, v in fields(value):
                if n == 1:
                    piece.text = v.decode()
                elif n == 2:
                    piece.score = struct.unpack("<f", v)[0]
                elif n == 3:
                    piece.kind = v
            model.pieces.append(piece)
        elif number == 2:
            for n, v in fields(value):
                if n == 3:
                    model.kind = v
                elif n == 24:
                    model.suffix_space = bool(v)
                elif n == 35:
                    model.byte_fallback = bool(v)
                elif n == 44:
                    model.unknown_surface = v.decode()
        elif number == 3:
            for n, v in fields(value):
                if n == 2:
                    model.charsmap = v
                elif n == 3:
                    model.dummy_prefix = bool(v)
                elif n == 4:
                    model.strip_spaces = bool(v)
                elif n == 5:
                    model.escape_spaces = bool(v)
    return model
