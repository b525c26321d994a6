"""Helpers that the operators of this package share.

Python tasks here work on Arrow batches.  A batch's texts are looked at as one
byte buffer with row offsets, cut into runs of rows of a bounded number of
bytes, so that a task's memory is bounded by ``RUN_BYTES`` (or one row), not
by its partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.session import scratch_path

RUN_BYTES = 2 << 20

#: Bytes that separate words of the classes used by the contracts:
#: ASCII white space, and everything ASCII but letters and digits.
ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = True
WORD_SPACE = ~ASCII_SPACE
_b = np.arange(256)
WORD_ALNUM = (_b >= 0x80) | ((_b >= 0x30) & (_b <= 0x39)) | ((_b >= 0x41) & (_b <= 0x5A)) | \
    ((_b >= 0x61) & (_b <= 0x7A))
LOWER = _b.astype(np.uint8)
LOWER[0x41:0x5B] += 0x20


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet into the shared scratch folder and read back.

    Later branches see one fixed result, the lineage is cut, losing an
    executor loses nothing, and the planner knows the table's real size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def same(a: Column, b: Column) -> Column:
    """Null-safe equality (an equi-join key for Spark)."""
    return a.eqNullSafe(b)


def text_key(text: str = "text") -> Column:
    """64-bit key of a text; null and the empty text differ."""
    return F.xxhash64(F.col(text))


def look_up(docs: DataFrame, found: DataFrame, keys: dict[str, Column], values: list[str]) -> DataFrame:
    """``docs`` with ``values`` of ``found`` as columns ``__<value>`` (null where
    no row matches).

    ``keys``: column of ``found`` -> expression over ``docs``; null matches null.
    ``found`` is a stored table with one row per key at most.  Both sides are dealt
    out by the keys at every size, so that the plan for a small table is the
    one for a large one; the texts are hashed, not sorted, and AQE may split a
    key that many rows of ``docs`` share.
    """
    right = found.select(*[F.col(k).alias(f"__k_{k}") for k in keys],
                         *[F.col(v).alias(f"__{v}") for v in values]).hint("shuffle_hash")
    cond = None
    for k, expr in keys.items():
        c = expr.eqNullSafe(right[f"__k_{k}"])
        cond = c if cond is None else cond & c
    return docs.join(right, cond, "left").drop(*[f"__k_{k}" for k in keys])


def bitmap(df: DataFrame, col: str, bits: int) -> DataFrame:
    """(bucket, held): a bitmap of the first ``bits`` bits of the 64-bit values of
    ``col``, stored: at most ``1 << (bits - 15)`` rows of 4 KB, however many values."""
    slot = F.shiftrightunsigned(col, 64 - bits) + 1  # bucket numbers and positions count from 1
    return stored(df.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("__at"))
                  .groupBy("bucket").agg(F.bitmap_construct_agg("__at").alias("held")), "bitmap")


def bitmap_bytes(held: DataFrame, bits: int) -> bytes:
    """A :func:`bitmap` as ``1 << (bits - 3)`` bytes at the driver."""
    parts = {row["bucket"]: bytes(row["held"]) for row in held.collect()}
    return b"".join(parts.get(i + 1, bytes(4096)) for i in range(1 << max(bits - 15, 0)))


def marked(df: DataFrame, value: Column, held: DataFrame, bits: int) -> DataFrame:
    """``df`` with the flag ``__marked``: the bitmap holds ``value``'s slot.  Never
    false for a value that was put in.  The broadcast side is of a fixed size."""
    slot = F.shiftrightunsigned(value, 64 - bits) + 1
    right = F.broadcast(held.select(F.col("bucket").alias("__bucket"), F.col("held").alias("__held")))
    at = F.bitmap_bit_position(slot).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("__held"), F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    found = df.join(right, F.bitmap_bucket_number(slot) == F.col("__bucket"), "left")
    return found.withColumn("__marked", F.coalesce(
        F.getbit(byte, at % 8) == 1, F.lit(False))).drop("__bucket", "__held")


def look_up_few(docs: DataFrame, found: DataFrame, keys: dict[str, Column], values: list[str],
                bits: int = 23) -> DataFrame:
    """Rows of ``docs`` that have a row in ``found``, with its ``values`` as columns
    ``__<value>``.  ``keys`` as in :func:`look_up`.  Rows that a bitmap of the
    keys rules out never move; the others meet ``found`` in a sort-merge join."""
    held = bitmap(found.select(F.xxhash64(*keys).alias("__hash")), "__hash", bits)
    near = marked(docs, F.xxhash64(*keys.values()), held, bits).filter("__marked").drop("__marked")
    right = found.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[F.col(v).alias(f"__{v}") for v in values])
    cond = None
    for k, expr in keys.items():
        c = expr.eqNullSafe(right[f"__k_{k}"])
        cond = c if cond is None else cond & c
    return near.join(right, cond).drop(*[f"__k_{k}" for k in keys])


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row offsets (n + 1) and bytes of a string column; null reads as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = pc.fill_null(array.cast(pa.large_string()), "")
    _, offsets, data = array.buffers()
    n = len(array)
    if n == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(offsets, np.int64)[array.offset:array.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return off - off[0], raw[off[0]:off[-1]]


def runs(offsets: np.ndarray, limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold at most ``limit`` bytes, or one row."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def word_bounds(data: np.ndarray, offsets: np.ndarray,
                is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and each row's first word (n + 1).

    Words never cross rows.  ``offsets`` start at 0.
    """
    n = len(data)
    inside = is_word[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    if n:
        before[0] = False
        before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty(n, bool)
    if n:
        after[-1] = False
        after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def row_sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per row, the sum of ``flags`` over its range."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[offsets])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Exact codes of the words of one run: equal words, equal code (from 0)."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    # the words' bytes without what lies between them
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    packed = data[np.cumsum(edge[:-1]).astype(bool)] if len(data) else data
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(packed))])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
