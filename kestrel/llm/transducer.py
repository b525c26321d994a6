"""SentencePiece encoding and decoding as shortest paths in a weighted transducer.

The transducer is the composition of the normaliser (spaces to the space mark,
dummy prefix), the closure of the pieces (a trie of arcs that reads characters
and writes a piece id at its end), and byte fallback (a character that no
piece holds writes its bytes' ids).  A text is composed with it lazily: states are
text positions, arcs the pieces that end there, and the path of least weight in
the tropical semiring (sum along a path, minimum over paths) gives the ids.

* Unigram models: an arc weighs minus the piece's score.
* BPE models: the state also holds the last piece, and an arc weighs 0 if merging
  leaves the two pieces as they are when their texts are merged alone, else
  infinity.  Merging a text in order of scores never crosses a border
  of its result at any step, so its pieces are pairwise such pairs; and a
  sequence of such pairs is what merging gives, because the first merge
  across a border would also happen in the pair alone.  So exactly one path has finite
  weight, every position has one state, and the search stops at the first arc.

Texts are cut where no piece can reach across (before a space after a non-space,
around characters that no longer piece has), and paths of recent cuts are kept.

Decoding is the inverse: ids write their pieces' text (bytes for byte pieces).
Encoding then decoding gives the text back but for what the normaliser changes (the
space mark itself reads as a space).

Defined cases: null encodes as the empty text, which has no ids; very long
texts are streams of cuts; equal rows give equal results.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from sys import getsizeof

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.common import runs, utf8
from kestrel.llm.lexicon import BPE, BYTE, CONTROL, SPACE, UNKNOWN, USER_DEFINED, Lexicon

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
_KEPT = 300_000  # cuts, and pairs, that a process remembers (twice that at most)
_KEPT_BYTES = 64 << 20  # and their bytes (twice that at most)
_ENTRY_BYTES = 100  # what an entry takes beside its key and value
_RUN_BYTES = 4 << 20
_UNKNOWN_PENALTY = 10.0


class _Recent(dict):
    """A mapping of a bounded size and number of bytes: what was not used since the last
    full generation goes."""

    def __init__(self, size: int, limit: int = _KEPT_BYTES):
        super().__init__()
        self.size, self.limit, self.held, self.old = size, limit, 0, {}

    def keep(self, key, value):
        own = getsizeof(key) + getsizeof(value) + _ENTRY_BYTES
        if own > self.limit // 4:  # not worth a generation
            return value
        if len(self) >= self.size or self.held + own > self.limit:
            self.old, self.held = dict(self), 0
            self.clear()
        self.held += own
        self[key] = value
        return value

    def __missing__(self, key):
        value = self.old.get(key)
        return None if value is None else self.keep(key, value)


class Transducer:
    """Compiled normaliser, pieces and byte fallback of a lexicon."""

    def __init__(self, lexicon: Lexicon):
        if any(t == USER_DEFINED for t in lexicon.types):
            raise ValueError("models with user-defined symbols are not supported")
        self.lexicon, self.cost = lexicon, [-s for s in lexicon.scores]
        self.unknown_cost = max(self.cost, default=0.0) + _UNKNOWN_PENALTY
        self.pairs, self.paths = _Recent(_KEPT), _Recent(_KEPT)
        cut = r" +[^ {0}]*|[^ {0}]+|[{0}]" if lexicon.lone else r" +[^ ]*|[^ ]+"
        self.cut = re.compile(cut.format(lexicon.lone)) if lexicon.cuts_at_space else None
        #: trie of the pieces read from their ends; a piece's id is under ""
        self.endings: dict = {}
        for piece, i in lexicon.ids.items():
            node = self.endings
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[""] = i
        self.states = len(lexicon.pieces) + 0x110000  # pieces, and lone characters
        self.surface = [self._surface(p, t) for p, t in zip(lexicon.pieces, lexicon.types)]

    @staticmethod
    def _surface(piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        return " ⁇ ".encode() if kind == UNKNOWN else piece.replace(SPACE, " ").encode()

    # ------------------------------------------------------------- BPE arcs

    def merged(self, text: str) -> list[str]:
        """What merging makes of ``text``: always the pair whose joined piece
        scores best, the leftmost of equal ones."""
        parts, ids, score = list(text), self.lexicon.ids, self.lexicon.scores
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = ids.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or score[piece] > best):
                    best, at = score[piece], i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _name(self, state: int) -> str:
        """The piece of a state, or the lone character that no piece is."""
        size = len(self.lexicon.pieces)
        return "" if state < 0 else self.lexicon.pieces[state] if state < size else chr(state - size)

    def _stay(self, key: int) -> bool:
        """Whether merging leaves two pieces side by side (``key``: both states)."""
        a, b = (self._name(x) for x in (key // self.states - 1, key % self.states))
        return self.pairs.keep(key, self.merged(a + b) == ([a, b] if a else [b]))

    def _bpe_paths(self, texts: list[str]) -> list[tuple[int, ...]]:
        """States of the path of each of the sorted ``texts``; the positions of the
        beginning that a text shares with the one before keep theirs."""
        size, states, pairs, root = len(self.lexicon.pieces), self.states, self.pairs, self.endings
        last, length = [-1], [0]  # of each position: its one state, and that piece's length
        before, out = "", []
        for text in texts:
            shared, most = 0, min(len(before), len(text))
            while shared < most and before[shared] == text[shared]:
                shared += 1
            del last[shared + 1:], length[shared + 1:]
            for end in range(shared + 1, len(text) + 1):
                # pieces that end here, shortest first
                node, begin, found = root, end, []
                while begin:
                    node = node.get(text[begin - 1])
                    if node is None:
                        break
                    begin -= 1
                    piece = node.get("")
                    if piece is not None:
                        found.append((begin, piece))
                if not found or found[0][0] != end - 1:
                    found.insert(0, (end - 1, size + ord(text[end - 1])))
                for begin, piece in reversed(found):
                    key = (last[begin] + 1) * states + piece
                    known = pairs[key]
                    if known or known is None and self._stay(key):
                        break
                last.append(piece)
                length.append(end - begin)
            path, at = [], len(text)
            while at:
                path.append(last[at])
                at -= length[at]
            out.append(tuple(reversed(path)))
            before = text
        return out

    # --------------------------------------------------------- unigram arcs

    def _unigram_path(self, text: str) -> list[str]:
        ids, longest, cost = self.lexicon.ids, self.lexicon.longest, self.cost
        best, back = [0.0], [0]
        for end in range(1, len(text) + 1):
            least, place = best[end - 1] + self.unknown_cost, end - 1
            for begin in range(max(0, end - longest), end):
                piece = ids.get(text[begin:end])
                if piece is not None and best[begin] + cost[piece] < least:
                    least, place = best[begin] + cost[piece], begin
            best.append(least)
            back.append(place)
        out, at = [], len(text)
        while at:
            out.append(text[back[at]:at])
            at = back[at]
        return out[::-1]

    # ------------------------------------------------------------- in, out

    def _pack(self, path: list[str] | tuple[int, ...]) -> bytes:
        out, lexicon, size = array("i"), self.lexicon, len(self.lexicon.pieces)
        for x in path:
            own = lexicon.ids.get(x) if isinstance(x, str) else x if x < size else None
            out.extend(lexicon.unknown_ids(x if isinstance(x, str) else chr(x - size)) if own is None else (own,))
        return out.tobytes()

    def _find(self, cuts: set[str]) -> Iterator[tuple[str, bytes]]:
        """Finds, keeps and gives the paths of new cuts."""
        texts = sorted(c.replace(" ", SPACE) for c in cuts)
        found = self._bpe_paths(texts) if self.lexicon.kind == BPE else map(self._unigram_path, texts)
        for text, path in zip(texts, found):
            cut = text.replace(SPACE, " ")
            yield cut, self.paths.keep(cut, self._pack(path))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as native 32-bit integers."""
        spaced = [self.lexicon.spaced(t) for t in texts]
        cuts = [self.cut.findall(t) if self.cut else [t] if t else [] for t in spaced]
        new = {c for own in cuts for c in own}
        kept = {c: path for c in new if (path := self.paths[c]) is not None}
        kept.update(self._find(new.difference(kept)))
        return [b"".join(map(kept.__getitem__, own)) for own in cuts]

    def encode_packed(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def encode(self, text: str) -> list[int]:
        return array("i", self.encode_packed(text)).tolist()

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.surface.__getitem__, ids))
        if self.lexicon.dummy_prefix and raw.startswith(b" "):
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


_compiled: dict[str, Transducer] = {}


def compiled(model: bytes) -> Transducer:
    """The transducer of a model file's content, made once per process."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _compiled:
        _compiled[key] = Transducer(Lexicon.read(model))
    return _compiled[key]


def _encoder(model: bytes, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = compiled(model)
        for batch in batches:
            offsets, _ = utf8(batch.column("__text"))
            names = [f for f in batch.schema.names if f != "__text"]
            for lo, hi in runs(offsets, _RUN_BYTES):
                rows = batch.slice(lo, hi - lo)
                texts = [t or "" for t in rows.column("__text").to_pylist()]
                packed = fst.encode_many(texts)
                back = [fst.decode(array("i", p)) for p in packed]
                cols = [pa.array([len(p) // 4 for p in packed], pa.int64()),
                        pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                        pa.array([a == b.replace(SPACE, " ") for a, b in zip(back, texts)], pa.bool_())]
                if with_ids:
                    ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32))))
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(n) for n in names), *cols],
                    names=[*names, "n_pieces", "ids_sha256", "round_trip", *["ids"] * with_ids])
    return run


def encode(docs: DataFrame, keep: list[str], text_col: str = "text", model_path: str = MODEL_PATH,
           with_ids: bool = True) -> DataFrame:
    """Per row: the columns ``keep``, n_pieces, ids_sha256 (of the ids as
    little-endian 32-bit integers), round_trip (the ids decode to the text), and ids.

    The model file is read on the driver and sent with the tasks (its size is
    fixed, about 0.5 MB).
    """
    with open(model_path, "rb") as f:
        model = f.read()
    rows = docs.select(*keep, F.col(text_col).alias("__text"))
    own = rows.select(*keep).schema
    ddl = own.add("n_pieces", "long").add("ids_sha256", "string").add("round_trip", "boolean")
    if with_ids:
        ddl = ddl.add("ids", T.ArrayType(T.IntegerType()))
    return rows.mapInArrow(_encoder(model, with_ids), ddl)
