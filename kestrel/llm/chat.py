"""Chat formatting: a finite-state machine over roles and a declarative template.

Turns of a conversation, in order of (turn, role, text), nulls first, run
through the machine, which tells the turns that its order doesn't allow; each
turn gives three segments: the opening mark with the role, the text, and the
closing mark.  Only the texts of the template's loss roles carry the loss flag.
Inside roles and texts the template's escape character goes before itself and into
every start of a control string, so that marks are found by plain search and
all of it can be read back.

Defined cases: null roles and texts are empty; null conversation ids form one
conversation; every row is a turn, equal rows and equal turn numbers too; after
a turn out of order the machine goes on from that turn's role, or from the
start if no rule knows it; an empty table gives no segments.

A conversation's rows are sorted within one partition and streamed: a task
holds one turn and a hash state, never a conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks around a turn, the loss roles, and the order of roles."""

    begin: str = "<|im_start|>"
    role_end: str = "\n"
    end: str = "<|im_end|>\n"
    control: str = "<|"  # the start of every control string
    escape: str = "\\"
    loss_roles: frozenset = frozenset({"assistant"})
    start: str = "start"
    final: frozenset = frozenset({"assistant"})
    moves: dict = field(default_factory=lambda: {
        ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user",
        ("assistant", "tool"): "tool", ("tool", "assistant"): "assistant"})

    def quoted(self, text: str) -> str:
        """``text`` without control strings."""
        text = text.replace(self.escape, self.escape * 2)
        return text.replace(self.control, self.control[0] + self.escape + self.control[1:])

    def quoted_role(self, role: str) -> str:
        return self.quoted(role).replace("\n", self.escape + "n")

    def plain(self, text: str) -> str:
        """What :meth:`quoted` was given."""
        return re.sub(re.escape(self.escape) + "(.)", r"\1", text, flags=re.S)

    def plain_role(self, role: str) -> str:
        return re.sub(re.escape(self.escape) + "(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.S)

    def step(self, state: str, role: str) -> tuple[str, bool]:
        """The next state, and whether the machine allows the role here."""
        after = self.moves.get((state, role))
        if after is not None:
            return after, True
        known = {to for (_, r), to in self.moves.items() if r == role}
        return (min(known) if known else self.start), False

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        return [(self.begin + self.quoted_role(role) + self.role_end, False),
                (self.quoted(text), role in self.loss_roles), (self.end, False)]


CHAT = Template()


def _rows(batch: pa.RecordBatch, *names: str):
    return zip(*(batch.column(n).to_pylist() for n in names))


def _format(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state, segment = object(), template.start, 0
        for batch in batches:
            out = []
            for conv, role, text in _rows(batch, "conv_id", "role", "text"):
                if conv != here or type(conv) is not type(here):
                    here, state, segment = conv, template.start, 0
                role, text = role or "", text or ""
                state, allowed = template.step(state, role)
                for part, loss in template.segments(role, text):
                    out.append((conv, segment, part, loss, allowed, state in template.final))
                    segment += 1
            cols = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], batch.column("conv_id").type), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.string()), *(pa.array(c, pa.bool_()) for c in cols[3:])],
                names=["conv_id", "segment", "text", "loss", "allowed", "final"])
    return run


def segments(conversations: DataFrame, template: Template = CHAT, conv_col: str = "conv_id",
             turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows (conv_id, segment, text, loss, allowed, final), each conversation's
    in order within one partition.

    ``allowed``: the machine allows this segment's turn; ``final``: a
    conversation may end after this turn.
    """
    turns = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                                 F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    kind = turns.schema["conv_id"].dataType.simpleString()
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text") \
        .mapInArrow(_format(template), f"conv_id {kind}, segment long, text string, loss boolean, "
                                       "allowed boolean, final boolean")


class _Reader:
    """Reads one conversation back from its formatted text, piece by piece."""

    def __init__(self, template: Template, conv):
        self.t, self.conv, self.rest = template, conv, ""
        self.turns, self.chars, self.loss_chars = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()
        self.valid, self.complete = True, False

    def feed(self, text: str, loss: bool, allowed: bool, final: bool) -> None:
        self.chars += len(text)
        self.valid &= allowed
        self.complete = final
        if loss:
            plain = self.t.plain(text)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode())
        self.rest += text
        while (at := self.rest.find(self.t.end)) >= 0:
            turn, self.rest = self.rest[:at], self.rest[at + len(self.t.end):]
            role, _, said = turn[len(self.t.begin):].partition(self.t.role_end)
            self.turns += 1
            self.all.update(f"{self.t.plain_role(role)}\n{self.t.plain(said)}\n".encode())

    def row(self) -> tuple:
        return (self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(),
                self.chars, self.valid, self.valid and self.complete)


def _read(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, kind = None, None

        def made(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows))
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
                       "valid", "complete"])

        for batch in batches:
            kind, out = batch.column("conv_id").type, []
            for conv, segment, *rest in _rows(batch, "conv_id", "segment", "text", "loss", "allowed", "final"):
                if segment == 0:
                    if reader is not None:
                        out.append(reader.row())
                    reader = _Reader(template, conv)
                reader.feed(*rest)
            if out:
                yield made(out)
        if reader is not None:
            yield made([reader.row()])
    return run


def read_back(formatted: DataFrame, template: Template = CHAT) -> DataFrame:
    """One row per conversation, from :func:`segments` rows in their own order:
    what the formatted text holds when it is parsed again, and the digests."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.mapInArrow(
        _read(template), f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                         "loss_sha256 string, formatted_chars long, valid boolean, complete boolean")
