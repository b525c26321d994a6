"""Benchmark decontamination by winnowing.

Words are lower-cased (A-Z) runs of letters, digits and non-ASCII characters.
Every ``K`` consecutive words (a k-gram) have a hash; of each window of
``WINDOW - K + 1`` consecutive k-grams the rightmost smallest hash is kept, on
both sides.  So two texts that share ``WINDOW`` consecutive words share a kept
k-gram within them.  Fingerprints are joined, and each hit is extended to both
sides word by word; a shared span of ``WINDOW`` words or more is a match.  An
item of fewer words is matched whole: its single gram against all grams of
that length.

Defined cases: a null text has no words, and neither hits nor is hit; an item
with a null id counts for hit words but is not listed; repeated item rows are
one item by id; each row of the documents is judged by itself, so equal rows
give equal results; empty tables give empty results or no hits.

Plan: the benchmark's fingerprints go into a table and into a bitmap of fixed
size (``1 << BITS`` bits, whatever the benchmark's size) that each task gets.
One Python pass over the documents yields a row per document with those
fingerprints that the bitmap lets through, each with the few words around it,
so that extending a hit needs neither text again.  A full bitmap would only
let more rows into the exact join.  All later steps are JVM joins and
aggregates over those few rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import (LOWER, WORD_ALNUM, look_up, mix, runs, stored, text_key, utf8,
                                word_bounds)

WINDOW = 13
K = 8
BITS = 23
SHARE = 20  # contaminated: SHARE * n_hit >= n_words

_B = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_C = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n - 1 modulo 2 ** 64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        step = np.full(max(n, 1), base, np.uint64)
        step[0] = 1
        have = _powers[base] = np.cumprod(step)
    return have[:n]


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word, from prefix sums over the bytes."""
    total = np.zeros(len(low) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _power(_B, len(low)), out=total[1:])
    back = _power(pow(_B, -1, 1 << 64), len(low) + 1)
    return mix((total[ends] - total[starts]) * back[starts])


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on (of all but the last k - 1)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _C + words[j:j + n]
    return mix(out + np.uint64(k))


def winnow(grams: np.ndarray, first: np.ndarray, k: int, window: int) -> np.ndarray:
    """Positions kept of a run of rows; ``first``: each row's first word (n + 1)."""
    w, n = window - k + 1, int(first[-1])
    spans = n - window + 1
    if spans <= 0:
        return np.zeros(0, np.int64)
    least, at = grams[:spans].copy(), np.arange(spans)
    for j in range(1, w):
        later = grams[j:j + spans]
        better = later <= least  # the rightmost of equal hashes
        least = np.where(better, later, least)
        at[better] = np.flatnonzero(better) + j
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = row[:spans] == row[window - 1:window - 1 + spans]
    return np.unique(at[whole])


def _fingerprints(offsets: np.ndarray, data: np.ndarray, k: int, window: int, lengths: list[int],
                  bitmap: np.ndarray | None, bits: int):
    """For each run of rows: (lo, hi, words per row, row, position, gram length,
    hash, words before, words after) of the kept grams.

    ``lengths``: of short items, whose grams all count; with no bitmap (the
    benchmark's side) a row yields its one gram if it is shorter than the window.
    """
    for lo, hi in runs(offsets):
        off = offsets[lo:hi + 1] - offsets[lo]
        low = LOWER[data[offsets[lo]:offsets[hi]]]
        starts, ends, first = word_bounds(low, off, WORD_ALNUM)
        words, count = word_hashes(low, starts, ends), np.diff(first)
        grams = gram_hashes(words, k)
        at = winnow(grams, first, k, window)
        found = [(at, np.full(len(at), k), grams[at])]
        for size in lengths if bitmap is not None else sorted(set(count[(count > 0) & (count < window)])):
            size = int(size)
            if bitmap is not None:
                begin = np.arange(max(len(words) - size + 1, 0))
                row = np.searchsorted(first, begin, side="right") - 1
                begin = begin[begin + size <= first[row + 1]]
            else:
                begin = first[:-1][count == size]
            # short grams and k-grams of equal length must not meet
            found.append((begin, np.full(len(begin), -size), mix(gram_hashes(words, size)[begin] ^ np.uint64(0x5BD1))))
        at, size, value = (np.concatenate(x) for x in zip(*found))
        if bitmap is not None:
            slot = (value >> np.uint64(64 - bits)).astype(np.int64)
            through = (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0
            at, size, value = at[through], size[through], value[through]
        row = np.searchsorted(first, at, side="right") - 1
        order = np.lexsort((at, row))
        at, size, value, row = at[order], size[order], value[order], row[order]
        buf, ctx = low.tobytes(), window - k

        def around(a: int, b: int) -> list[str]:
            return [buf[s:e].decode() for s, e in zip(starts[a:b], ends[a:b])]

        before = [around(max(a - ctx, first[r]), a)[::-1] if s > 0 else [] for a, s, r in zip(at, size, row)]
        gram = [around(a, a + abs(s)) for a, s in zip(at, size)]
        after = [around(a + s, min(a + s + ctx, first[r + 1])) if s > 0 else [] for a, s, r in zip(at, size, row)]
        yield lo, hi, count, row, at - first[row], size, value.view(np.int64), before, gram, after


_HIT = pa.struct([("pos", pa.int64()), ("size", pa.int64()), ("fp", pa.int64()),
                  ("before", pa.list_(pa.string())), ("gram", pa.list_(pa.string())),
                  ("after", pa.list_(pa.string()))])
_HIT_DDL = ("array<struct<pos: long, size: long, fp: long, before: array<string>, "
            "gram: array<string>, after: array<string>>>")


def _mapper(k: int, window: int, lengths: list[int], bitmap: bytes | None, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits_set = None if bitmap is None else np.frombuffer(bitmap, np.uint8)
        for batch in batches:
            offsets, data = utf8(batch.column("text"))
            for lo, hi, count, row, pos, size, fp, before, gram, after in _fingerprints(
                    offsets, data, k, window, lengths, bits_set, bits):
                cut = np.searchsorted(row, np.arange(hi - lo + 1))
                hits = pa.StructArray.from_arrays(
                    [pa.array(pos, pa.int64()), pa.array(size, pa.int64()), pa.array(fp, pa.int64()),
                     pa.array(before, pa.list_(pa.string())), pa.array(gram, pa.list_(pa.string())),
                     pa.array(after, pa.list_(pa.string()))], fields=list(_HIT))
                rows = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("text_key"), pa.array(count, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(cut, pa.int32()), hits)],
                    names=["id", "text_key", "n_words", "hits"])
    return run


def _fingerprint_rows(df: DataFrame, id_col: str, text_col: str, k: int, window: int,
                      lengths: list[int], bitmap: bytes | None, bits: int) -> DataFrame:
    plain = df.select(F.col(id_col).alias("id"), text_key(text_col).alias("text_key"),
                      F.col(text_col).alias("text"))
    schema = (f"id {plain.schema['id'].dataType.simpleString()}, text_key long, n_words long, "
              f"hits {_HIT_DDL}")
    return plain.mapInArrow(_mapper(k, window, lengths, bitmap, bits), schema)


def item_fingerprints(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                      k: int = K, window: int = WINDOW) -> DataFrame:
    """One row per distinct fingerprint of an item with the words around it, stored."""
    rows = _fingerprint_rows(benchmark, id_col, text_col, k, window, [], None, 0)
    return stored(rows.select(F.col("id").alias("item_id"), F.explode("hits").alias("h"))
                  .select("item_id", "h.size", "h.fp", "h.before", "h.gram", "h.after")
                  .distinct(), "items")


def _bitmap(fps: DataFrame, bits: int) -> bytes:
    """Bitmap of the fingerprints' first ``bits`` bits, of a size that does not
    depend on the data: at most ``1 << (bits - 15)`` rows of 4 KB, made with
    partial aggregation, come to the driver."""
    slot = F.shiftrightunsigned("fp", 64 - bits) + 1  # bucket numbers and positions count from 1
    rows = fps.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("at")) \
        .groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits")).collect()
    size = 1 << max(bits - 15, 0)  # buckets of 2 ** 15 bits
    held = {row["bucket"]: bytes(row["bits"]) for row in rows}
    return b"".join(held.get(i + 1, bytes(4096)) for i in range(size))


def _agree(a: str, b: str):
    """Number of leading words that two arrays share."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differ == 0, F.least(F.size(a), F.size(b))).otherwise(differ - 1)


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text", k: int = K, window: int = WINDOW,
         bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(documents, spans).

    documents: a stored row per row of ``docs``: rid, id, text_key, n_words.
    spans: rid, item_id, start, end (in words) of every maximal match within
    the reach of a fingerprint; together they cover exactly the words that
    lie in an occurrence of a window of an item.
    """
    items = item_fingerprints(benchmark, item_col, item_text, k, window)
    lengths = sorted(-r[0] for r in items.filter("size < 0").select("size").distinct().collect())  # < window
    found = stored(_fingerprint_rows(docs, id_col, text_col, k, window, lengths, _bitmap(items, bits), bits)
                   .withColumn("rid", F.monotonically_increasing_id()), "prints")
    d = found.select("rid", F.explode("hits").alias("h")) \
        .select("rid", "h.pos", "h.fp", F.col("h.size").alias("d_size"), F.col("h.before").alias("d_before"),
                F.col("h.gram").alias("d_gram"), F.col("h.after").alias("d_after"))
    # many items may share a fingerprint and the words around it: extend once, then name the items
    shapes = items.select("fp", "size", "before", "gram", "after").distinct()
    reach = d.join(shapes, "fp").filter((F.col("d_size") == F.col("size")) & (F.col("d_gram") == F.col("gram"))) \
        .withColumn("l", _agree("d_before", "before")).withColumn("r", _agree("d_after", "after")) \
        .withColumn("start", F.col("pos") - F.col("l")) \
        .withColumn("end", F.col("pos") + F.abs("size") + F.col("r")) \
        .filter((F.col("size") < 0) | (F.col("end") - F.col("start") >= window))
    spans = reach.select("rid", "start", "end", "fp", "size", "before", "gram", "after") \
        .join(items, ["fp", "size", "before", "gram", "after"]).select("rid", "item_id", "start", "end")
    return found.drop("hits"), spans


def judge(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text", share: int = SHARE, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_words, n_hit, items
    (sorted as strings), contaminated (n_hit > 0 and share * n_hit >= n_words)."""
    rows, spans = hits(docs, benchmark, id_col, text_col, item_col, item_text, **options)
    per_doc = spans.groupBy("rid").agg(
        F.collect_set(F.struct("start", "end")).alias("spans"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    covered = F.array_distinct(F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["start"], s["end"] - 1))))
    per_doc = per_doc.select("rid", "items", F.size(covered).cast("long").alias("n_hit"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.join(per_doc, "rid", "left").select(
        F.col("id").alias("doc_id"), "text_key", "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"))


def remove(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           **options) -> DataFrame:
    """``docs`` without the contaminated rows, same columns."""
    found = stored(judge(docs, benchmark, id_col, text_col, **options).filter("contaminated")
                   .select("doc_id", "text_key", "contaminated").distinct(), "contaminated")
    keys = {"doc_id": F.col(id_col), "text_key": text_key(text_col)}
    return look_up(docs, found, keys, ["contaminated"]) \
        .filter(F.col("__contaminated").isNull()).select(*docs.columns)
