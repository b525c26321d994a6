"""Removal of long repeated passages by recompression.

A text's words (cut at ASCII white space) are symbols.  A round names maximal
runs of one symbol, then pairs of a left and a right symbol; which side a
symbol is on is a bit of its name, drawn anew each round.  A name is a 64-bit
hash of what it stands for, so equal substrings get the same name wherever they
are, in every task, and naming them globally takes no exchange.

What a symbol is depends on a range of words, its context: its own words and
those neighbours that decided how far it goes.  Every symbol whose context lies
in a window of ``WINDOW`` words is therefore found at the same place in every
copy of that window.  A window's anchor is, of such symbols of the last round
that has any, the one of the smallest hash (round 0, the single words, always
has some).  So equal windows have equal anchors, and neighbouring windows mostly
share theirs.  ``ROUNDS`` trades the two: each round makes anchors longer and so
rarer by chance, but their contexts outgrow the window and fewer windows share one
(measured on the check's texts: 11 words of context and 10 words per anchor
after three rounds, 26 and 4 after five).

1. Reveal: anchors, each with its context's words, are counted; one that stands
   only once can't be part of a repeat.
2. Verify: of the rest, all windows of an anchor's occurrence are hashed as one
   passage.  An equal passage elsewhere makes all of them repeats.  An anchor
   in several passages (the edges of repeats, common phrases), or again and again
   in one (loops), has one occurrence per passage taken apart into windows, and
   these are counted.
3. Words in a repeated window go.

A verified window agrees in 128 bits: the anchor's hash and the window's.

Defined cases: a null text has no words; a text of fewer words than the window
loses nothing and is no copy; windows never cross texts; copies of a text
remove each other wholly, equal rows too; other columns don't matter; an empty
table gives an empty result.

Plan: counts combine map-side, nothing is collected but bitmaps of a fixed size
(a full one only lets more rows into the exact steps), hot anchors and
passages meet in joins of stored tables, which AQE splits, and texts move only
where words go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import (WORD_SPACE, bitmap, bitmap_bytes, look_up_few, marked, mix, runs, stored,
                                text_key, utf8, word_bounds)
from kestrel.llm.decontaminate import _power, word_hashes

WINDOW = 35
BITS = 26
ROUNDS = 3

_RUN = np.uint64(0xA0761D6478BD642F)
_LEFT = np.uint64(0xE7037ED1A0B428DB)
_RIGHT = np.uint64(0x8EBC6AF09C88C6E3)
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_PIECE = 4 << 20


def _names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit name per word; long buffers are looked at in pieces."""
    out, lo = np.empty(len(starts), np.uint64), 0
    while lo < len(starts):
        hi = max(int(np.searchsorted(ends, starts[lo] + _PIECE, side="right")), lo + 1)
        a, b = starts[lo], ends[hi - 1]
        out[lo:hi] = word_hashes(data[a:b], starts[lo:hi] - a, ends[lo:hi] - a)
        lo = hi
    return out


def _beside(values: np.ndarray, at: np.ndarray, row: np.ndarray, step: int, edge: np.ndarray) -> np.ndarray:
    """``values`` of the symbols next to ``at`` in the same row, else ``edge``."""
    near = np.clip(at + step, 0, len(values) - 1)
    here = (near == at + step) & (row[near] == row[at])
    return np.where(here, values[near], edge)


def levels(words: np.ndarray, first: np.ndarray, rounds: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(name, context start, context end) of each symbol: the words, then after each round.

    ``first``: each row's first word (n + 1).  A decision that needs to know
    that the row ends has a context beyond the row, which fits no window.
    """
    n = len(words)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    before, after = (first[:-1] - 1).astype(np.int64), (first[1:] + 1).astype(np.int64)
    name, begin, end = words, np.arange(n), np.arange(1, n + 1)
    yield name, begin, end
    for k in range(rounds):
        # runs: their neighbours tell how long they are
        fresh = np.ones(len(name), bool)
        fresh[1:] = (name[1:] != name[:-1]) | (row[1:] != row[:-1])
        head = np.flatnonzero(fresh)
        size = np.diff(np.append(head, len(name)))
        tail, own = head + size - 1, row[head]
        begin, end = (_beside(begin, head, row, -1, before[own]), _beside(end, tail, row, 1, after[own]))
        name = np.where(size > 1, mix(name[head] * _RUN + size.astype(np.uint64)), name[head])
        row = own
        # pairs: a left symbol looks to its right, a right one to its left
        left = mix(name + np.uint64(2 * k + 1)) & np.uint64(1) == 0
        joined = np.zeros(len(name), bool)
        joined[:-1] = left[:-1] & ~left[1:] & (row[:-1] == row[1:])
        keep = np.ones(len(name), bool)
        keep[1:] = ~joined[:-1]
        at = np.flatnonzero(keep)
        own = row[at]
        new_end = np.where(left[at], _beside(end, at, row, 1, after[own]), end[at])
        new_begin = np.where(left[at], begin[at], _beside(begin, at, row, -1, before[own]))
        both = at[joined[at]]
        made = name.copy()
        made[both] = mix(name[both] * _LEFT + mix(name[both + 1] + _RIGHT))
        name, begin, end, row = made[at], new_begin, new_end, own
        yield name, begin, end


def _least(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Smallest key of each range lo .. hi (included), from minima over powers of two."""
    power = np.frexp(hi - lo + 1)[1] - 1
    out = np.empty(len(lo), keys.dtype)
    for k in range(int(power.max(initial=-1)) + 1):
        here = power == k
        out[here] = np.minimum(keys[lo[here]], keys[hi[here] - (1 << k) + 1])
        step = min(1 << k, len(keys))
        keys = np.minimum(keys, np.append(keys[step:], np.full(step, keys.max(initial=0))))
    return out


def _each(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (``size`` of them), for all starts in turn."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def anchors(words: np.ndarray, first: np.ndarray, window: int,
            rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, "_Ranges"]:
    """(hash, first window, number of windows, loop) per run of neighbouring windows
    with equal anchors, and the hashes of word ranges.  Windows are numbered by their
    first word; loop: the anchors are not all one, so windows of the run may be equal."""
    ranges = _Ranges(words)
    left = _each(first[:-1], np.maximum(np.diff(first) - window + 1, 0))
    owner = np.zeros(len(words), np.uint64)
    place = np.zeros(len(words), np.int64)
    owned = np.zeros(len(words) + 1, bool)
    owned[left] = True
    for name, begin, end in reversed(list(levels(words, first, rounds))):
        lo = np.searchsorted(begin, left)
        hi = np.searchsorted(end, left + window, side="right") - 1
        some = hi >= lo
        # 32 bits of hash, then the leftmost
        keys = (mix(name) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(name), dtype=np.uint64)
        at = (_least(keys, lo[some], hi[some]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        owner[left[some]] = mix(name[at] + ranges(begin[at], end[at]))
        place[left[some]] = begin[at]
        left = left[~some]
    change = np.append(True, (owner[1:] != owner[:-1]) | (owned[1:-1] != owned[:-2])) if len(words) else owned[:0]
    change = np.flatnonzero(change)
    size = np.diff(np.append(change, len(words)))
    real = owned[change]
    change, size = change[real], size[real]
    moved = np.zeros(len(words), np.int64)
    np.cumsum(place[1:] != place[:-1], out=moved[1:])
    return owner[change], change, size, moved[change + size - 1] > moved[change], ranges


class _Ranges:
    """Hashes of ranges of a run's words, from prefix sums."""

    def __init__(self, words: np.ndarray):
        self.total = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(mix(words) * _power(_BASE, len(words)), out=self.total[1:])
        self.back = _power(pow(_BASE, -1, 1 << 64), len(words) + 1)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix(((self.total[b] - self.total[a]) * self.back[a]) ^ (b - a).astype(np.uint64))


def _runs_of(batch: pa.RecordBatch, window: int, rounds: int):
    """For each run of rows: (lo, hi, buffer, row offsets, first words, names, first
    windows, numbers of windows, range hashes)."""
    offsets, data = utf8(batch.column("text"))
    for lo, hi in runs(offsets):
        off = offsets[lo:hi + 1] - offsets[lo]
        raw = data[offsets[lo]:offsets[hi]]
        starts, ends, first = word_bounds(raw, off, WORD_SPACE)
        yield lo, hi, raw, off, first, *anchors(_names(raw, starts, ends), first, window, rounds)


_OCC = pa.struct([("sig", pa.int64()), ("h", pa.int64()), ("a", pa.int32()), ("m", pa.int32()),
                  ("loop", pa.bool_())])


def _reveal(window: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, off, first, sig, a, m, loop, ranges in _runs_of(batch, window, rounds):
                row = np.searchsorted(first, a, side="right") - 1
                occ = pa.StructArray.from_arrays(
                    [pa.array(sig.view(np.int64)), pa.array(ranges(a, a + m - 1 + window).view(np.int64)),
                     pa.array((a - first[row]).astype(np.int32)), pa.array(m.astype(np.int32)),
                     pa.array(loop)], fields=list(_OCC))
                cut = np.searchsorted(row, np.arange(hi - lo + 1))
                buf, rows = raw.tobytes(), batch.slice(lo, hi - lo)
                digests = [hashlib.sha256(b" ".join(buf[s:e].split())).hexdigest() for s, e in zip(off[:-1], off[1:])]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("text_key"), pa.array(np.diff(first)), pa.array(digests),
                     pa.ListArray.from_arrays(pa.array(cut, pa.int32()), occ)],
                    names=["id", "text_key", "n_words", "sha256", "occ"])
    return run


def _windows(window: int, rounds: int, wanted: bytes, bits: int):
    """Passages of the anchors in the bitmap, with the hashes of their windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(wanted, np.uint8)
        for batch in batches:
            for *_, sig, a, m, _, ranges in _runs_of(batch, window, rounds):
                slot = (sig >> np.uint64(64 - bits)).astype(np.int64)
                take = (held[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0
                sig, a, m = sig[take], a[take], m[take]
                ends = np.cumsum(m)
                p = np.arange(m.sum()) + np.repeat(a - (ends - m), m)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig.view(np.int64)), pa.array(ranges(a, a + m - 1 + window).view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()),
                                              pa.array(ranges(p, p + window).view(np.int64)))],
                    names=["sig", "h", "windows"])
    return run


def _verdicts(docs: DataFrame, close: DataFrame, window: int, rounds: int, bits: int) -> DataFrame:
    """(sig, h, js): passages with repeated windows, stored; ``js`` null: all of them."""
    passages = stored(close.groupBy("sig", "h").agg(F.count(F.lit(1)).alias("n"), F.max("loop").alias("loop"),
                                                      F.min("text_key").alias("at")), "passages")
    several = passages.groupBy("sig").agg(F.count(F.lit(1)).alias("c"), F.max("loop").alias("loop")) \
        .filter("c > 1 or loop")
    # one text of each of their passages is read again
    held = bitmap(several, "sig", bits)
    again = marked(passages, F.col("sig"), held, bits).filter("__marked").select("at")
    texts = marked(docs, F.col("text_key"), bitmap(again, "at", bits), bits).filter("__marked").select("text")
    taken = texts.mapInArrow(_windows(window, rounds, bitmap_bytes(held, bits), bits), "sig long, h long, windows array<long>")
    taken = taken.groupBy("sig", "h").agg(F.any_value("windows").alias("windows"))
    parts = stored(taken.join(passages.select("sig", "h", "n"), ["sig", "h"])
                   .select("sig", "h", "n", F.posexplode("windows").alias("j", "w")), "windows")
    often = stored(parts.groupBy("sig", "w").agg(F.sum("n").alias("t")).filter("t > 1").select("sig", "w"), "often")
    some = parts.filter("n = 1").join(often, ["sig", "w"]).groupBy("sig", "h").agg(F.collect_list("j").alias("js"))
    every = passages.filter("n > 1").select("sig", "h", F.lit(None).cast("array<int>").alias("js"))
    return stored(every.unionByName(some), "verdicts")


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
          rounds: int = ROUNDS, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(rows, spans), both stored.

    rows: a row per row of ``docs``: rid, id, text_key, n_words, sha256 (of its
    words, joined by one space).  spans: rid, id, text_key, and ``spans``, an
    array of (a, m, js): of the ``m`` windows from word ``a`` on all (``js``
    null), or those in ``js``, are repeated; only rows that have any.
    """
    plain = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("text_key"), F.col(text_col).alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    rows = stored(plain.mapInArrow(
        _reveal(window, rounds), f"id {kind}, text_key long, n_words long, sha256 string, "
                         "occ array<struct<sig: long, h: long, a: int, m: int, loop: boolean>>")
        .withColumn("rid", F.monotonically_increasing_id()), "anchors")
    occ = rows.select("rid", "text_key", F.inline("occ"))
    shared = occ.groupBy("sig").agg(F.count(F.lit(1)).alias("n"), F.max("loop").alias("loop")).filter("n > 1 or loop")
    close = stored(marked(occ, F.col("sig"), bitmap(shared, "sig", bits), bits).filter("__marked").drop("__marked"),
                   "shared")
    verdicts = _verdicts(plain, close, window, rounds, bits)
    found = close.join(verdicts, ["sig", "h"]).groupBy("rid") \
        .agg(F.collect_list(F.struct("a", "m", "js")).alias("spans"))
    return rows.drop("occ"), stored(rows.select("rid", "id", "text_key").join(found, "rid"), "spans")


def _covered(spans: list[dict], n: int, window: int) -> np.ndarray:
    """Which of ``n`` words lie in a repeated window."""
    step = np.zeros(n + 1, np.int32)
    for s in spans:
        if s["js"] is None:
            step[s["a"]] += 1
            step[s["a"] + s["m"] - 1 + window] -= 1
        else:
            at = s["a"] + np.array(s["js"], np.int64)
            np.add.at(step, at, 1)
            np.add.at(step, at + window, -1)
    return np.cumsum(step[:-1]) > 0


def _kept(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                one = batch.slice(row, 1)
                words = (one.column("text")[0].as_py() or "").encode().split()
                gone = _covered(one.column("__spans")[0].as_py() or [], len(words), window)
                text = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                yield pa.RecordBatch.from_arrays(
                    [one.column("id"), pa.array([len(words)]), pa.array([int(gone.sum())]),
                     pa.array([text.decode()]), pa.array([hashlib.sha256(text).hexdigest()])],
                    names=["id", "n_words", "n_removed", "kept_text", "kept_sha256"])
    return run


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
           rounds: int = ROUNDS, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(untouched, cut): rows whose texts stay (rid, id, text_key, n_words, sha256),
    and rows that lose words: id, n_words, n_removed, kept_text (kept words, joined
    by one space), kept_sha256."""
    rows, found = spans(docs, id_col, text_col, window, rounds, bits)
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    cut = look_up_few(plain, found.dropDuplicates(["id", "text_key"]),
                      {"id": F.col("id"), "text_key": text_key("text")}, ["spans"])
    cut = cut.mapInArrow(_kept(window), f"id {kind}, n_words long, n_removed long, kept_text string, "
                                        "kept_sha256 string")
    return rows.join(found.select("rid"), "rid", "left_anti"), cut


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
          rounds: int = ROUNDS, bits: int = BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256."""
    same, cut = remove(docs, id_col, text_col, window, rounds, bits)
    same = same.select("id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha256").alias("kept_sha256"))
    return same.unionByName(cut.drop("kept_text")).withColumnRenamed("id", "doc_id")
