"""Quality rules: cross-document line frequency.

Lines are normalised (words joined by one space, A-Z lower-cased, each digit
read as ``0``) and hashed; for each (host, line) the distinct documents that
hold the line are counted, exact copies of a text counting once.  A line is
removed when that count is above ``min_docs`` and above ``share`` of the host's
distinct documents.  A document is rejected as depleted when fewer than
``keep_percent`` of its words are left, or when it fails the base rules.

Defined cases: a null text is an empty document (no words, base_failed); a
null host is a host of its own; blank lines are never counted or removed;
equal rows are judged alike and each gives its own result row; an empty table
gives an empty result.

Plan: one Python pass over the texts gives a compact row per document (the
measures, and each distinct line's key with its words), written once.  The rest
is JVM work on that table: a distinct count per line with partial aggregation
(a hot host or line meets as one partial row per task), a join with the few
frequent lines (both sides are plain scans, so AQE may split a hot line), and
a sum per row id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm import common
from kestrel.llm.common import ASCII_SPACE, WORD_SPACE, row_sums, runs, stored, utf8, word_bounds

MIN_DOCS = 10
SHARE = 0.1
KEEP_PERCENT = 50
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_NORMAL = bytes(range(256)).translate(bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000"))

_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SCHEMA = ("doc_id {id}, host_key long, text_key long, n_words long, word_chars long, "
           "n_symbols long, n_dup_lines long, n_repeat_words long, "
           "lines array<long>, line_words array<long>")


def normal_line(line: bytes) -> bytes:
    """A line's normal form; empty for a line without words."""
    return b" ".join(line.split()).translate(_NORMAL)


def repeated_words(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per word, whether it lies in a 3-word window that its row holds twice or more.

    ``codes``: exact word codes of a run of rows; ``first``: each row's first
    word (n + 1).
    """
    n = len(codes)
    hit = np.zeros(n, bool)
    if n < 3:
        return hit
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(row[:-2] == row[2:])  # windows within one row
    if not len(at):
        return hit
    size = int(codes.max()) + 1
    pair = codes[at] * size + codes[at + 1]
    if size >= 1 << 21:  # three codes don't fit 63 bits: number the pairs first
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair * size + codes[at + 2]
    order = np.argsort(key, kind="stable")  # rows stay in order among equal keys
    key, at = key[order], at[order]
    twin = (key[1:] == key[:-1]) & (row[at[1:]] == row[at[:-1]])
    found = np.zeros(len(at), bool)
    found[1:] |= twin
    found[:-1] |= twin
    at = at[found]
    for d in range(3):
        hit[at + d] = True
    return hit


def _lines(text: bytes) -> tuple[int, list[int], list[int]]:
    """Lines equal to an earlier one, and the distinct normal lines' keys and words."""
    seen: set[bytes] = set()
    words: dict[int, int] = {}
    dup = 0
    for line in text.split(b"\n"):
        parts = line.split()
        if not parts:
            continue
        if line in seen:
            dup += 1
        else:
            seen.add(line)
        key = xxhash.xxh64_intdigest(b" ".join(parts).translate(_NORMAL))
        words[key] = words.get(key, 0) + len(parts)
    return dup, list(words), list(words.values())


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = utf8(batch.column("text"))
        for lo, hi in runs(offsets):
            off = offsets[lo:hi + 1] - offsets[lo]
            raw = data[offsets[lo]:offsets[hi]]
            starts, ends, first = word_bounds(raw, off, WORD_SPACE)
            letters = ((raw & 0xC0) != 0x80) & ~ASCII_SPACE[raw]
            hit = repeated_words(common.word_codes(raw, starts, ends), first)
            buf = raw.tobytes()
            found = [_lines(buf[a:b]) for a, b in zip(off[:-1], off[1:])]
            keys = [np.array(x[1], np.uint64).view(np.int64) for x in found]
            rows = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([
                rows.column("doc_id"), rows.column("host_key"), rows.column("text_key"),
                pa.array(np.diff(first)), pa.array(row_sums(letters, off)),
                pa.array(row_sums(_SYMBOL[raw], off)),
                pa.array([x[0] for x in found], pa.int64()),
                pa.array(row_sums(hit, first)),
                pa.array(keys, pa.list_(pa.int64())),
                pa.array([x[2] for x in found], pa.list_(pa.int64())),
            ], names=["doc_id", "host_key", "text_key", *_MEASURES, "lines", "line_words"])


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             host_col: str = "source") -> DataFrame:
    """Compact row per document, stored: ids, base measures, distinct lines."""
    plain = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(host_col)).alias("host_key"),
                        common.text_key(text_col).alias("text_key"), F.col(text_col).alias("text"))
    schema = _SCHEMA.format(id=plain.schema["doc_id"].dataType.simpleString())
    made = plain.mapInArrow(_measure, schema)
    return stored(made.withColumn("rid", F.monotonically_increasing_id()), "quality")


def frequent_lines(compact: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """(host_key, line, n_docs) of the lines above the limits, stored."""
    per_line = compact.select("host_key", "text_key", F.explode("lines").alias("line")) \
        .groupBy("host_key", "line").agg(F.countDistinct("text_key").alias("n_docs")) \
        .filter(F.col("n_docs") > min_docs)
    hosts = compact.groupBy("host_key").agg(F.countDistinct("text_key").alias("host_docs"))
    return stored(per_line.join(hosts, "host_key")
                  .filter(F.col("n_docs") > F.lit(share) * F.col("host_docs"))
                  .select("host_key", "line", "n_docs"), "frequent-lines")


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def _verdicts(compact: DataFrame, frequent: DataFrame, keep_percent: int) -> DataFrame:
    lines = compact.select("rid", "host_key",
                           F.explode(F.arrays_zip("lines", "line_words")).alias("x")) \
        .select("rid", "host_key", F.col("x.lines").alias("line"), F.col("x.line_words").alias("w"))
    gone = lines.join(frequent, ["host_key", "line"]).groupBy("rid") \
        .agg(F.sum("w").alias("removed"), F.collect_set("line").alias("removed_lines"))
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    left = F.col("n_words") - F.coalesce("removed", F.lit(0))
    return compact.drop("lines", "line_words").join(gone, "rid", "left") \
        .withColumn("n_kept_words", left).withColumn("base_failed", failed) \
        .withColumn("kept", ~failed & (100 * left >= keep_percent * F.col("n_words")))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          host_col: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE,
          keep_percent: int = KEEP_PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base measures, n_kept_words
    (words outside removed lines), base_failed, kept."""
    compact = measures(docs, id_col, text_col, host_col)
    out = _verdicts(compact, frequent_lines(compact, min_docs, share), keep_percent)
    return out.select("doc_id", *_MEASURES, "n_kept_words", "base_failed", "kept")


def _cleaned(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = batch.column("__removed_lines")
            batch = batch.drop_columns(["__removed_lines"])
            if gone.null_count < len(gone):
                at = batch.schema.get_field_index(text_col)
                texts = batch.column(at).to_pylist()
                for i, lines in enumerate(gone.to_pylist()):
                    if lines is not None:
                        drop = {x & 0xFFFFFFFFFFFFFFFF for x in lines}
                        texts[i] = b"\n".join(
                            line for line in texts[i].encode().split(b"\n") if not line.split()
                            or xxhash.xxh64_intdigest(normal_line(line)) not in drop).decode()
                batch = batch.set_column(at, batch.schema.field(at),
                                         pa.array(texts, batch.column(at).type))
            yield batch
    return run


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          chars_col: str | None = "n_chars", min_docs: int = MIN_DOCS, share: float = SHARE,
          keep_percent: int = KEEP_PERCENT) -> DataFrame:
    """``docs`` without rejected documents and without removed lines, same columns.

    ``chars_col``, if the table has it, is set anew where lines went.  The
    decisions are found by (id, host, text), on which they depend, so null
    and repeated ids are safe; the texts are dealt at most once.
    """
    compact = measures(docs, id_col, text_col, host_col)
    judged = _verdicts(compact, frequent_lines(compact, min_docs, share), keep_percent)
    judged = stored(judged.filter("not kept or removed_lines is not null")
                    .select("doc_id", "host_key", "text_key", "kept", "removed_lines")
                    .dropDuplicates(["doc_id", "host_key", "text_key"]), "judged")
    keys = {"doc_id": F.col(id_col), "host_key": F.xxhash64(F.col(host_col)),
            "text_key": common.text_key(text_col)}
    left = common.look_up(docs, judged, keys, ["kept", "removed_lines"]) \
        .filter("coalesce(__kept, true)").drop("__kept")
    if chars_col in docs.columns:
        lost = F.col("__removed_lines").isNotNull()
        left = left.withColumn("__lost", lost)
    out = left.mapInArrow(_cleaned(text_col), left.drop("__removed_lines").schema)
    if chars_col in docs.columns:
        fresh = F.length(text_col).cast(docs.schema[chars_col].dataType)
        out = out.withColumn(chars_col, F.when(F.col("__lost"), fresh).otherwise(F.col(chars_col)))
    return out.select(*docs.columns)
