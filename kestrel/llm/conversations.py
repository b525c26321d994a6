"""Conversation structure repair by rank-convergence parallel Viterbi.

A conversation's rows, by turn, are kept, given another role, deleted, or have
empty turns put before them, so that the roles' initials read ``(s?(ua)+)?`` at
the least cost.  The costs still to come from each state of that pattern (start, after
s, after u, after a) make up a vector of four; a row maps the vector behind it to
the one before it (min-plus algebra).  Only differences inside a vector matter,
and after some rows they no longer depend on where one began: the product of the
rows' maps has rank one.

1. All rows are sorted and dealt out by range, so a long conversation lies over
   many tasks, and cut into chunks of at most ``CHUNK`` rows.
2. Each chunk that has a successor starts from a speculative vector.
3. Fix-up passes: a chunk whose successor found another vector than the one that the chunk
   started from runs both in step from its end, until they differ only by a
   constant; then its own first vector stands.  Passes end when no chunk has a new vector to
   start from.  Some rows (a long stretch of roles that fit nowhere) never lose
   the difference; chunks that still change after ``PASSES`` passes get
   their whole map, and maps are joined by pointer doubling: exact, in log2(chunks) passes.
4. Each conversation is streamed forward; a chunk's vectors, from its
   stitched end, tell at each state which edits are cheapest, and the least letter
   of these is taken.

Defined cases: a null role or text is one space; null conversation ids form one
conversation, null turns come first; rows of one turn go by role, the
text's first 32 characters and its digest, equal rows side by side; a conversation
without rows (all ``missing``) has zeros and an empty audit; other columns
don't matter; an empty table gives an empty result.

Memory: a task holds a chunk's codes (a byte a row), one row and a hash state; the audit is
a letter an edit, one cell of the result.  The driver sees the first and the last
chunk of each range partition (ids only), a number that grows with the partitions, not the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import stored

CHUNK = 16_384
PASSES = 4
INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3

OK, CUT_OFF, BLANK, DUPLICATE = range(4)
#: States: start, after s, after u, after a.  Where a kept initial leads, and where the one
#: role that fits (put in or given) leads.
MOVES = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
FIT = (2, 2, 3, 2)
FIT_ROLE = ("user", "user", "assistant", "user")
INITIALS = "sua"
FAR = 1 << 20  # more than any difference inside a vector

Vector = tuple[int, int, int, int]


def _relaxed(v: list[int]) -> tuple[Vector, int]:
    """With empty turns put in, less its least value, and that value."""
    for _ in range(3):
        v = [min(c, INSERT + v[FIT[s]]) for s, c in enumerate(v)]
    low = min(v)
    return tuple(min(c - low, FAR) for c in v), low


TERMINAL = _relaxed([0, FAR, FAR, 0])[0]
_STEPS: dict[tuple[Vector, int], tuple[Vector, int]] = {}


def edits(after: Vector, code: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that use up a row, letters ascending."""
    fault, initial = code & 3, INITIALS[(code >> 2) - 1] if code >> 2 else ""
    out = [("D", DELETE, state)]
    if fault < BLANK:
        more = TRUNCATED if fault == CUT_OFF else 0
        kept = MOVES.get(initial, {}).get(state)
        if kept is not None:
            out.append(("K", more, kept))
        out.append(("R", more + REROLE, FIT[state]))
    return out


def step(after: Vector, code: int) -> tuple[Vector, int]:
    """The vector before a row, and the constant taken off.  Few different vectors
    occur, so each (vector, row) is worked out once."""
    found = _STEPS.get((after, code))
    if found is None:
        found = _STEPS[after, code] = _relaxed(
            [min(c + after[to] for _, c, to in edits(after, code, s)) for s in range(4)])
    return found


def run_back(codes: bytes, v: Vector) -> tuple[Vector, int]:
    total = 0
    for c in reversed(codes):
        v, low = step(v, c)
        total += low
    return v, total


def fix_up(codes: bytes, old: Vector, new: Vector, left: Vector) -> Vector:
    """The first vector when the chunk starts from ``new``, given that ``old`` led to ``left``."""
    for c in reversed(codes):
        if old == new:
            return left
        old, new = step(old, c)[0], step(new, c)[0]
    return new


def matrix(codes: bytes) -> list[int]:
    """Cost from each state before a chunk to each state behind it, row by row."""
    ends = [run_back(codes, tuple(0 if s == k else FAR for s in range(4))) for k in range(4)]
    return [min(v[s] + low, FAR << 8) if v[s] < FAR else FAR << 8 for s in range(4) for v, low in ends]


def product(a: list[int], b: list[int]) -> list[int]:
    """Min-plus product, less its least value."""
    c = [min(a[4 * s + k] + b[4 * k + t] for k in range(4)) for s in range(4) for t in range(4)]
    return [min(x - min(c), FAR << 8) for x in c]


def applied(m: list[int], v: Vector) -> Vector:
    c = [min(m[4 * s + k] + v[k] for k in range(4)) for s in range(4)]
    return tuple(min(x - min(c), FAR) for x in c)


def trace(codes: bytes, right: Vector) -> list[Vector]:
    """The vector behind each row of a chunk."""
    out = [right]
    for c in reversed(codes[1:]):
        out.append(step(out[-1], c)[0])
    return out[::-1]


_PATHS: dict[tuple[Vector, int, int], tuple[str, int, int]] = {}


def path(after: Vector, code: int, state: int) -> tuple[str, int, int]:
    """Least letters among the cheapest edits up to and with a row, their cost, the next state."""
    key = (after, code, state)
    if key not in _PATHS:
        before, low = step(after, code)
        letters, cost, s = "", 0, state
        while True:
            best = before[s] + low
            for letter, c, to in sorted([*edits(after, code, s), ("I", INSERT, FIT[s])]):
                if c + (before[to] + low if letter == "I" else after[to]) == best:
                    break
            letters, cost, s = letters + letter, cost + c, to
            if letter != "I":
                break
        _PATHS[key] = letters, cost, s
    return _PATHS[key]


# ------------------------------------------------------------------ chunks

_KEY = ["conv_id", "turn", "role", "head", "key", "rid"]


def _cut(size: int):
    """Chunks of a sorted partition: the first row's key, id, codes, nxt (the next
    chunk of the conversation in this partition), tail (last chunk here)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        seq, open_, codes, schema = 0, None, bytearray(), None

        def made(rows):
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [*(pa.array([k[i] for k in cols[0]], schema.field(n).type) for i, n in enumerate(_KEY)),
                 pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.int64()),
                 pa.array(cols[4], pa.bool_())], names=[*_KEY, "id", "codes", "nxt", "tail"])

        for batch in batches:
            schema, out = batch.schema, []
            for row in zip(*(batch.column(n).to_pylist() for n in [*_KEY, "code"])):
                same = open_ is not None and open_[0] == row[0]
                if not same or len(codes) == size:
                    if open_ is not None:
                        out.append((open_, part + seq, bytes(codes), part + seq + 1 if same else None, False))
                        seq += 1
                    open_, codes = row[:-1], bytearray()
                codes.append(row[-1])
            if out:
                yield made(out)
        if open_ is not None:
            yield made([(open_, part + seq, bytes(codes), None, True)])
    return run


def _links(chunks: DataFrame) -> list[tuple[int, int]]:
    """(last chunk of a partition, first chunk of the next one) of one conversation;
    at most one for each range partition."""
    seen = sorted((r["id"], r["tail"], r["conv_id"]) for r in
                  chunks.filter("tail or (id & 4294967295) = 0").select("id", "tail", "conv_id").toLocalIterator())
    return [(a[0], b[0]) for a, b in zip(seen, seen[1:]) if a[1] and a[2] == b[2] and a[0] >> 32 != b[0] >> 32]


def _each(fn, schema: str, out: list[str]):
    """mapInArrow over rows of small columns: ``fn(row dict) -> row tuple``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = list(zip(*(fn(r) for r in batch.to_pylist()))) or [[]] * len(out)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kinds)], names=out)
    return run


def _mapped(df: DataFrame, fn, schema: str) -> DataFrame:
    return df.mapInArrow(_each(fn, schema, [c.split()[0] for c in schema.split(", ")]), schema)


def _stitched(chain: DataFrame, passes: int) -> DataFrame:
    """(id, right): the vector behind each chunk that others follow or precede."""
    schema = "id long, nxt long, codes binary, right array<int>, left array<int>, changed boolean"

    def first(r):
        return r["id"], r["nxt"], r["codes"], TERMINAL, run_back(r["codes"], TERMINAL)[0], True

    def again(r):
        right, left = tuple(r["right"]), tuple(r["left"])
        fresh = right if r["fresh"] is None else tuple(r["fresh"])
        if fresh == right:
            return r["id"], r["nxt"], r["codes"], right, left, False
        return r["id"], r["nxt"], r["codes"], fresh, fix_up(r["codes"], right, fresh, left), True

    now = stored(_mapped(chain, first, schema), "viterbi")
    for _ in range(passes):
        near = now.select(F.col("id").alias("nxt"), F.col("left").alias("fresh"))
        now = stored(_mapped(now.drop("changed").join(near, "nxt", "left"), again, schema), "viterbi")
        if now.filter("changed").isEmpty():
            return now.select("id", "right")
    # whole maps, joined by pointer doubling
    kinds = "id long, nxt long, m array<int>"
    maps = stored(_mapped(chain, lambda r: (r["id"], r["nxt"], matrix(r["codes"])), kinds), "maps")
    while not maps.filter("nxt is not null").isEmpty():
        near = maps.select(F.col("id").alias("nxt"), F.col("nxt").alias("far"), F.col("m").alias("b"))
        maps = stored(_mapped(maps.join(near, "nxt", "left"), lambda r: (
            r["id"], r["far"], r["m"] if r["b"] is None else product(r["m"], r["b"])), kinds), "maps")
    near = maps.select(F.col("id").alias("nxt"), "m")
    return stored(_mapped(chain.select("id", "nxt").join(near, "nxt", "left"), lambda r: (
        r["id"], TERMINAL if r["m"] is None else applied(r["m"], TERMINAL)), "id long, right array<int>"), "stitched")


def _coded(rows: DataFrame) -> DataFrame:
    """Key and code of each row, without its text."""
    tail = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    light = rows.filter("not missing").select(
        "conv_id", "turn", "role", F.substring("text", 1, 32).alias("head"), F.md5("text").alias("key"), "rid",
        F.coalesce(*[F.when(F.startswith("role", F.lit(c)), 4 * k) for k, c in enumerate(INITIALS, 1)], F.lit(0))
        .alias("initial"),
        F.when(tail == "", BLANK).when(F.substring(tail, -1, 1).isin(".", "!", "?"), OK).otherwise(CUT_OFF)
        .alias("fault"))
    light = stored(light, "coded")
    firsts = light.filter(F.col("fault") != BLANK).groupBy("conv_id", "role", "key") \
        .agg(F.min(F.struct("turn", "rid")).alias("first")).select(F.col("first.rid").alias("rid"), F.lit(1).alias("one"))
    fault = F.when((F.col("fault") == BLANK) | F.col("one").isNotNull(), F.col("fault")).otherwise(DUPLICATE)
    return light.join(firsts, "rid", "left").select(*_KEY, (F.col("initial") + fault).cast("int").alias("code"))


def chunked(rows: DataFrame, size: int = CHUNK, passes: int = PASSES) -> DataFrame:
    """Chunks of all conversations (key of the first row, codes, right: the vector
    behind them, null: the terminal one)."""
    spark = rows.sparkSession
    coded = stored(_coded(rows), "codes")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kinds = {f.name: f.dataType.simpleString() for f in coded.schema}
    chunks = stored(coded.repartitionByRange(parts, *_KEY).sortWithinPartitions(*_KEY).mapInArrow(
        _cut(size), ", ".join(f"{n} {kinds[n]}" for n in _KEY) + ", id long, codes binary, nxt long, tail boolean"),
        "chunks")
    across = _links(chunks)
    if not across and chunks.filter("nxt is not null").isEmpty():
        return chunks.select(*_KEY, "codes", F.lit(None).cast("array<int>").alias("right"))
    # one link a range partition at most
    over = spark.createDataFrame(across, "id long, over long")
    linked = chunks.join(F.broadcast(over), "id", "left").select("id", F.coalesce("nxt", "over").alias("nxt"), "codes")
    behind = linked.filter("nxt is not null").select(F.col("nxt").alias("id"), F.lit(True).alias("behind"))
    chain = stored(linked.join(behind, "id", "left").filter("behind or nxt is not null").drop("behind"), "chain")
    return chunks.join(_stitched(chain, passes), "id", "left").select(*_KEY, "codes", "right")


# ------------------------------------------------------------------ streams

def _walk(batches: Iterator[pa.RecordBatch]):
    """Per conversation in the stream: ("begin", id), ("row", turn, role, text, code, letters,
    cost, state before), ..., ("end", letters, cost)."""
    here, state, plan = None, 0, iter(())
    for batch in batches:
        for conv, kind, turn, role, text, codes, right in zip(*(
                batch.column(n).to_pylist() for n in ("conv_id", "kind", "turn", "role", "text", "codes", "right"))):
            if here is None or here[0] != conv:
                if here is not None:
                    yield ("end", "I" if state in (1, 2) else "", INSERT if state in (1, 2) else 0, state)
                here, state = (conv,), 0
                yield ("begin", conv)
            if kind == 0:
                plan = iter(zip(codes, trace(codes, tuple(right) if right else TERMINAL)))
            elif kind == 1:
                code, after = next(plan)
                letters, cost, to = path(after, code, state)
                yield ("row", turn, role, text, code, letters, cost, state)
                state = to
        yield ("batch",)
    if here is not None:
        yield ("end", "I" if state in (1, 2) else "", INSERT if state in (1, 2) else 0, state)


def _turns(letters: str, role: str, text: str, state: int) -> list[tuple[str, str, str]]:
    """(letter, role, text) of each turn that edits leave."""
    out = []
    for e in letters:
        if e == "I":
            out.append((e, FIT_ROLE[state], ""))
            state = FIT[state]
        elif e != "D":
            out.append((e, role if e == "K" else FIT_ROLE[state], text))
    return out


def _judge(kind):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, conv = [], None

        def made(rows):
            types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for event in _walk(batches):
            if event[0] == "row":
                _, turn, role, text, code, letters, cost, state = event
                if turn is not None and turn != high:
                    low, high, turns = turn if low is None else low, turn, turns + 1
                count[code & 3] += 1
                illegal += before is not None and before + role[:1] not in ("su", "ua", "au")
                before = role[:1]
            elif event[0] == "begin":
                conv, low, high, turns, count, illegal, before = event[1], None, None, 0, [0] * 4, 0, None
                total, audit, digest, sep = 0, [], hashlib.sha256(), b""
                continue
            elif event[0] == "end":
                _, letters, cost, state = event
                role = text = ""
            else:
                if done:
                    yield made(done)
                    done = []
                continue
            total += cost
            audit.append(letters)
            for _, r, t in _turns(letters, role, text, state):
                digest.update(sep + f"{r}:{t}".encode())
                sep = b"\n"
            if event[0] == "end":
                gaps = 0 if low is None else high - low + 1 - turns
                done.append((conv, gaps, count[BLANK], count[DUPLICATE], count[CUT_OFF], illegal, total,
                             "".join(audit), digest.hexdigest()))
        if done:
            yield made(done)
    return run


def _repaired(kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, conv, place = [], None, 0
        for event in _walk(batches):
            if event[0] == "begin":
                conv, place = event[1], 0
            elif event[0] == "batch":
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                    out = []
            else:
                letters, role, text, state = (event[5], event[2], event[3], event[7]) if event[0] == "row" \
                    else (event[1], "", "", event[3])
                for e, r, t in _turns(letters, role, text, state):
                    out.append((conv, place, r, t, e))
                    place += 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    names, types = ["conv_id", "place", "role", "text", "edit"], [kind, pa.int64(), *[pa.string()] * 3]
    return run


def _streams(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str,
             missing: Column | None, size: int, passes: int) -> tuple[DataFrame, str]:
    space = F.lit(" ")
    rows = stored(conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), space).alias("role"), F.coalesce(F.col(text_col), space).alias("text"),
        (F.lit(False) if missing is None else F.coalesce(missing, F.lit(False))).alias("missing"),
        F.monotonically_increasing_id().alias("rid")), "turns")
    chunks = chunked(rows, size, passes)
    texts = rows.select(
        "conv_id", "turn", "role", F.substring("text", 1, 32).alias("head"), F.md5("text").alias("key"), "rid",
        F.when(F.col("missing"), 2).otherwise(1).alias("kind"), F.when(~F.col("missing"), F.col("text")).alias("text"),
        F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("array<int>").alias("right"))
    plans = chunks.select(*_KEY, F.lit(0).alias("kind"), F.lit(None).cast("string").alias("text"), "codes", "right")
    stream = texts.unionByName(plans).repartition("conv_id").sortWithinPartitions(*_KEY, "kind")
    return stream, rows.schema["conv_id"].dataType


def _arrow(kind) -> tuple[pa.DataType, str]:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind), kind.simpleString()


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", missing: Column | None = None, size: int = CHUNK,
           passes: int = PASSES) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256.  ``missing``: rows that only name their conversation."""
    stream, kind = _streams(conversations, conv_col, turn_col, role_col, text_col, missing, size, passes)
    arrow, name = _arrow(kind)
    return stream.mapInArrow(_judge(arrow), f"conv_id {name}, gaps long, blank long, duplicate long, truncated long, "
                                            "illegal long, cost long, audit string, repaired_sha256 string")


def repaired(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text", missing: Column | None = None, size: int = CHUNK,
             passes: int = PASSES) -> DataFrame:
    """The repaired conversations: conv_id, place, role, text, edit (K, R or I)."""
    stream, kind = _streams(conversations, conv_col, turn_col, role_col, text_col, missing, size, passes)
    arrow, name = _arrow(kind)
    return stream.mapInArrow(_repaired(arrow), f"conv_id {name}, place long, role string, text string, edit string")


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, missing: rows damaged by the CRC-32 of their id and
    turn, modulo 20 (0 missing, 1 text emptied, 2 without ``.!?``, 3 twice, 4 role user)."""
    space = F.lit(" ")
    hit = F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space),
                              F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    text = F.coalesce("text", space)
    return conversations.select("conv_id", "turn", "role", "text", hit.alias("hit")).select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (F.col("hit") == 0).alias("missing"),
        F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")) \
        .drop("copy")
