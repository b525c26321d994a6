"""A piece vocabulary read from a SentencePiece model file.

Only the parts of the file that encoding needs are read: pieces with scores
and types, the model's kind, and the normaliser's switches.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # piece types of the file format
UNIGRAM, BPE = 1, 2  # model kinds of the file format
SPACE = "▁"


def _varint(buf: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = buf[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def _fields(buf: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a message."""
    at = 0
    while at < len(buf):
        tag, at = _varint(buf, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(buf, at)
        elif kind == 2:
            size, at = _varint(buf, at)
            value, at = buf[at:at + size], at + size
        else:
            size = 4 if kind == 5 else 8
            value, at = buf[at:at + size], at + size
        yield tag >> 3, value


class Lexicon:
    """Pieces by id with scores and types."""

    def __init__(self, pieces: list[str], scores: list[float], types: list[int] | None = None,
                 kind: int = UNIGRAM, dummy_prefix: bool = True, squeeze: bool = False,
                 byte_fallback: bool = False):
        types = types or [NORMAL] * len(pieces)
        self.pieces, self.scores, self.types, self.kind = pieces, scores, types, kind
        self.dummy_prefix, self.squeeze = dummy_prefix, squeeze
        self.ids = {p: i for i, (p, t) in enumerate(zip(pieces, types)) if t in (NORMAL, USER_DEFINED, UNUSED)}
        self.unknown = types.index(UNKNOWN) if UNKNOWN in types else None
        found = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(pieces, types)) if t == BYTE}
        self.bytes = [found[b] for b in range(256)] if byte_fallback and len(found) == 256 else None
        self.longest = max(map(len, self.ids), default=1)
        #: no piece goes on after a non-space with a space, so texts may be cut there
        self.cuts_at_space = not any(a != SPACE and b == SPACE for p in self.ids for a, b in zip(p, p[1:]))
        joined = {c for p in self.ids if len(p) > 1 for c in p}
        #: characters that no longer piece has: texts may be cut around them
        self.lone = "".join(c for c in "\n\r\t" if c not in joined)

    @classmethod
    def read(cls, model: bytes) -> "Lexicon":
        pieces, scores, types = [], [], []
        kind, fallback, dummy, squeeze = UNIGRAM, False, True, True
        for number, value in _fields(model):
            if number == 1:
                own = dict(_fields(value))
                pieces.append(own.get(1, b"").decode())
                scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                types.append(own.get(3, NORMAL))
            elif number == 2:
                own = dict(_fields(value))
                kind, fallback = own.get(3, UNIGRAM), bool(own.get(35, 0))
                if own.get(24):
                    raise ValueError("models with white space as suffix are not supported")
            elif number == 3:
                own = dict(_fields(value))
                if own.get(2):
                    raise ValueError("models with a character map are not supported")
                if not own.get(5, 1):
                    raise ValueError("models without white space escaping are not supported")
                dummy, squeeze = bool(own.get(3, 1)), bool(own.get(4, 1))
        if kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        return cls(pieces, scores, types, kind, dummy, squeeze, fallback)

    def spaced(self, text: str) -> str:
        """The normaliser's work but for the escaping of spaces."""
        text = text.replace(SPACE, " ")
        if self.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        return " " + text if self.dummy_prefix and text else text

    def unknown_ids(self, char: str) -> list[int]:
        if self.bytes is not None:
            return [self.bytes[b] for b in char.encode()]
        if self.unknown is None:
            raise ValueError(f"no piece for {char!r}")
        return [self.unknown]
