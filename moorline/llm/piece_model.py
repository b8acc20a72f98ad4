"""Reader of a sentence-piece model file: a protobuf of pieces, trainer and normaliser settings."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

# Field numbers and piece types of the public model format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MODEL_TYPE, BYTE_FALLBACK = 3, 35
UNIGRAM, BPE = 1, 2
CHARSMAP, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE_SPACES = 2, 3, 4, 5

MARKER = "▁"


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _varint(data, at)
            value = data[at:at + size]
            at += size
        yield tag >> 3, value


@dataclass
class PieceModel:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    extra_spaces_go: bool = True
    escape_spaces: bool = True

    @property
    def unknown(self) -> int:
        return self.types.index(UNKNOWN)

    def usable(self) -> list[int]:
        """Numbers of the pieces that text can turn into."""
        return [i for i, kind in enumerate(self.types) if kind in (NORMAL, USER_DEFINED)]


def read_model(path: str) -> PieceModel:
    with open(path, "rb") as file:
        data = file.read()
    model = PieceModel()
    for number, value in _fields(data):
        if number == PIECES:
            piece = dict(_fields(value))
            model.pieces.append(piece[PIECE_TEXT].decode())
            model.scores.append(struct.unpack("<f", piece.get(PIECE_SCORE, bytes(4)))[0])
            model.types.append(piece.get(PIECE_TYPE, NORMAL))
        elif number == TRAINER:
            settings = dict(_fields(value))
            model.kind = settings.get(MODEL_TYPE, UNIGRAM)
            model.byte_fallback = bool(settings.get(BYTE_FALLBACK, 0))
        elif number == NORMALIZER:
            settings = dict(_fields(value))
            model.charsmap = settings.get(CHARSMAP, b"")
            model.dummy_prefix = bool(settings.get(DUMMY_PREFIX, 1))
            model.extra_spaces_go = bool(settings.get(EXTRA_SPACES, 1))
            model.escape_spaces = bool(settings.get(ESCAPE_SPACES, 1))
    return model
