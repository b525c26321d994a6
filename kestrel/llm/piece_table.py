"""Fill-in-middle transformation with piece tables.

A document is a list of descriptors (buffer, start, length) over two immutable
buffers: its UTF-8 text and the sentinels.  Cutting splits a descriptor in two,
an arrangement is a permutation of descriptors with sentinels put between, and
nothing is copied until the output is written; digests are fed descriptor by
descriptor.  Restoring makes a table over the *output*, cuts it at its
sentinels, drops these and applies the inverse permutation.

Cuts fall between tokens (``[A-Za-z]+|[^A-Za-z]``, by code point), at places
drawn from the SHA-256 of ``1:`` and the id, so a row's result depends on
nothing but itself.  An output is unambiguous since only texts without sentinels
are rearranged, and no end of a text and start of a sentinel make up another.

Defined cases: a null text is empty; an empty text, or one that holds a
sentinel, is plain; a null id draws from ``1:`` alone; equal rows give equal
rows; other columns, whatever their names, don't matter; an empty table gives
an empty result.

Plan: one pass without a shuffle; a task holds one run of rows (or one row).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import runs, utf8

TEXT, MARKS = 0, 1
SENTINELS = b"<P><S><M>"
PREFIX, SUFFIX, MIDDLE = (MARKS, 0, 3), (MARKS, 3, 3), (MARKS, 6, 3)
#: Order of the parts (0 prefix, 1 middle, 2 suffix) and the sentinel before each.
ARRANGEMENTS = {"psm": ((0, 2, 1), (PREFIX, SUFFIX, MIDDLE)), "spm": ((2, 0, 1), (SUFFIX, PREFIX, MIDDLE))}
FIM_PERCENT = 90
SPM_PERCENT = 20

Piece = tuple[int, int, int]


@dataclass(frozen=True)
class Table:
    """Descriptors over a text buffer and the sentinel buffer."""

    text: memoryview
    pieces: tuple[Piece, ...]

    @classmethod
    def of(cls, text) -> "Table":
        return cls(memoryview(text), ((TEXT, 0, len(text)),))

    def cut(self, *places: int) -> "Table":
        """The same bytes, cut after each of ``places`` (ascending): the descriptors
        between places, one each (of no length where places are equal)."""
        out, piece, done = [], 0, 0
        for at, upto in zip((0, *places), (*places, sum(p[2] for p in self.pieces))):
            while piece < len(self.pieces) - 1 and at >= done + self.pieces[piece][2]:
                done += self.pieces[piece][2]
                piece += 1
            buffer, start, length = self.pieces[piece]
            if upto > done + length:
                raise ValueError("a part spans several descriptors")
            out.append((buffer, start + at - done, upto - at))
        return Table(self.text, tuple(out))

    def arrange(self, order: Iterable[int], marks: Iterable[Piece] = ()) -> "Table":
        """Descriptors by ``order``, each after its sentinel."""
        moved = [self.pieces[k] for k in order]
        marks = tuple(marks)
        return Table(self.text, tuple(p for pair in zip(marks, moved) for p in pair) if marks else tuple(moved))

    def chunks(self) -> Iterator[memoryview]:
        marks = memoryview(SENTINELS)
        for buffer, start, length in self.pieces:
            yield (marks if buffer == MARKS else self.text)[start:start + length]

    def digest(self) -> str:
        h = hashlib.sha256()
        for c in self.chunks():
            h.update(c)
        return h.hexdigest()

    def bytes(self) -> bytes:
        return b"".join(self.chunks())


def transform(text, form: str, a: int = 0, b: int = 0) -> Table:
    """The output's table."""
    whole = Table.of(text)
    return whole if form == "plain" else whole.cut(a, b).arrange(*ARRANGEMENTS[form])


def restore(output: bytes, form: str) -> Table:
    """The text's table over the output's bytes."""
    if form == "plain":
        return Table.of(output)
    order, marks = ARRANGEMENTS[form]
    at, places = 0, []
    for _, start, length in marks:
        at = output.index(SENTINELS[start:start + length], at)
        places += [at, at + length]
        at += length
    parts = Table.of(output).cut(*places)  # (nothing), then a sentinel and a part in turn
    return parts.arrange([2, 4, 6]).arrange(np.argsort(order).tolist())


def draws(doc_id) -> tuple[int, ...]:
    """The four numbers that a row's id gives."""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(h[k:k + 8], 16) for k in (0, 8, 16, 24))


_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def token_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each token of a run's texts, and each row's first token (n + 1)."""
    letter = _LETTER[data]
    start = (data & 0xC0) != 0x80
    inner = np.zeros(len(data), bool)
    inner[1:] = letter[1:] & letter[:-1]
    inner[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(start & ~inner)
    return starts, np.searchsorted(starts, offsets)


def _chars(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def _transform(fim_percent: int, spm_percent: int, with_output: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = utf8(batch.column("text"))
            ids = batch.column("id")
            for lo, hi in runs(offsets):
                off = offsets[lo:hi + 1] - offsets[lo]
                raw = data[offsets[lo]:offsets[hi]]
                starts, first = token_starts(raw, off)
                edges = np.append(starts, len(raw))
                rows = []
                for k, doc_id in enumerate(ids.slice(lo, hi - lo).to_pylist()):
                    text = raw[off[k]:off[k + 1]].tobytes()
                    n = int(first[k + 1] - first[k])
                    h1, h2, h3, h4 = draws(doc_id)
                    if not text or h3 % 100 >= fim_percent or any(s in text for s in (b"<P>", b"<S>", b"<M>")):
                        form, a, b, pre, mid = "plain", 0, 0, None, None
                    else:
                        form = "spm" if h4 % 100 < spm_percent else "psm"
                        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
                        a, b = (int(edges[first[k] + x] - off[k]) for x in (a, b))
                        mine = raw[off[k]:off[k + 1]]
                        pre, mid = _chars(mine[:a]), _chars(mine[a:b])
                    table = transform(text, form, a, b)
                    output = table.bytes()
                    rows.append((n, form, pre, mid, table.pieces, table.digest(), restore(output, form).digest(),
                                 output.decode() if with_output else None))
                cols = list(zip(*rows))
                pieces = pa.array([[dict(zip(("buffer", "start", "length"), p)) for p in t] for t in cols[4]],
                                  pa.list_(_PIECE))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                     pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pieces,
                     pa.array(cols[5], pa.string()), pa.array(cols[6], pa.string()),
                     *([pa.array(cols[7], pa.string())] if with_output else [])],
                    names=["id", "n", "form", "prefix_chars", "middle_chars", "pieces", "output_sha256",
                           "restored_sha256", *(["output"] if with_output else [])])
    return run


_PIECE = pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())])


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fim_percent: int = FIM_PERCENT,
                   spm_percent: int = SPM_PERCENT, with_output: bool = True) -> DataFrame:
    """One row per row of ``docs``: id, n (tokens), form, prefix_chars, middle_chars,
    pieces (the output's descriptors, in bytes), output_sha256, restored_sha256
    and, ``with_output``, the output text."""
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    return plain.mapInArrow(
        _transform(fim_percent, spm_percent, with_output),
        f"id {kind}, n long, form string, prefix_chars long, middle_chars long, "
        "pieces array<struct<buffer: int, start: bigint, length: bigint>>, output_sha256 string, "
        "restored_sha256 string" + (", output string" if with_output else ""))


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [restore((o or "").encode(), f).bytes().decode()
                 for o, f in zip(batch.column("output").to_pylist(), batch.column("form").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=["id", "text"])


def restored(outputs: DataFrame) -> DataFrame:
    """(id, text) of rows with id, output and form."""
    kind = outputs.schema["id"].dataType.simpleString()
    return outputs.select("id", "output", "form").mapInArrow(_restore, f"id {kind}, text string")
