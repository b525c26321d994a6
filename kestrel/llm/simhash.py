"""SimHash near-duplicates by tiled exact comparison.

Fingerprints: a text's A-Z lower-cased words (cut at ASCII white space) give
word shingles (repeats count; fewer words than the shingle length: the whole
sequence; none: fingerprint 0); a bit of the fingerprint is 1 if more than
half of the shingles' XXH64 values have it.

Links: distinct fingerprints within ``radius`` bits of each other.  They lie
in tiles by the population counts of their parts (halves, or quarters when
there are many).  Two tiles are only compared if these counts differ by at most
the radius in sum, because each differing bit changes one count by one.  Within
a task the rows are sorted by finer counts and cut into blocks, and pairs of
blocks are skipped by the same test; the rest are compared exactly with numpy
exclusive-or and bit counts.  A task gives a spanning forest of its links,
which keeps every component and stays linear in its rows.

Defined cases: a null text has no words; a null id takes no part in the choice
of a component's smallest id (a component of null ids only has a null one);
equal rows and exact copies meet as one fingerprint; an empty table gives an
empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm import components
from kestrel.llm.common import look_up, stored, text_key, utf8

SHINGLE = 3
RADIUS = 3
SEED = 42
BITS = 64
_PIECE = 1 << 17  # shingles whose bits are counted at once


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    line, n = b" ".join(words), max(len(words) - shingle + 1, 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[-n:] - 1).tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for lo in range(0, n, _PIECE):
        h = np.array([digest(line[a:b], SEED) for a, b in zip(starts[lo:lo + _PIECE], stops[lo:lo + _PIECE])],
                     np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _printer(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = utf8(batch.column("text"))
            prints = np.fromiter((fingerprint(data[a:b].tobytes(), shingle)
                                  for a, b in zip(offsets[:-1], offsets[1:])), np.uint64, len(offsets) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(prints.view(np.int64))],
                names=["doc_id", "text_key", "fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, fp as a signed long) per row of ``docs``, stored."""
    plain = docs.select(F.col(id_col).alias("doc_id"), text_key(text_col).alias("text_key"),
                        F.col(text_col).alias("text"))
    schema = f"doc_id {plain.schema['doc_id'].dataType.simpleString()}, text_key long, fp long"
    return stored(plain.mapInArrow(_printer(shingle), schema), "simhash")


def _counts(fps: np.ndarray, parts: int) -> np.ndarray:
    """Population counts of the equal parts of each fingerprint, (n, parts)."""
    width = BITS // parts
    shift = (np.arange(parts) * width).astype(np.uint64)
    part = (fps[:, None] >> shift) & np.uint64((1 << width) - 1)
    return np.bitwise_count(part).astype(np.int16)


def _blocks(fps: np.ndarray, size: int) -> tuple[np.ndarray, list[tuple[int, int]], np.ndarray, np.ndarray]:
    """Sorted rows, their blocks, and per block the least and largest counts."""
    counts = _counts(fps, 8)
    order = np.lexsort(counts.T[::-1])
    fps, counts = fps[order], counts[order]
    cuts = [(a, min(a + size, len(fps))) for a in range(0, len(fps), size)]
    return (fps, cuts, np.array([counts[a:b].min(axis=0) for a, b in cuts]),
            np.array([counts[a:b].max(axis=0) for a, b in cuts]))


def links(home: np.ndarray, other: np.ndarray, radius: int, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (node, root) of the links between the rows of two sides."""
    if not len(home) or not len(other):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    nodes = np.unique(np.concatenate([home, other]))
    parent = np.arange(len(nodes))
    h, h_cuts, h_min, h_max = _blocks(home, block)
    o, o_cuts, o_min, o_max = _blocks(other, block)
    h_at, o_at = np.searchsorted(nodes, h), np.searchsorted(nodes, o)
    for i, (a, b) in enumerate(h_cuts):
        gap = np.maximum(0, np.maximum(h_min[i] - o_max, o_min - h_max[i])).sum(axis=1)
        for j in np.flatnonzero(gap <= radius):
            c, d = o_cuts[j]
            near = np.bitwise_count(h[a:b, None] ^ o[None, c:d]) <= radius
            x, y = np.nonzero(near)
            u, v = parent[h_at[a:b][x]], parent[o_at[c:d][y]]
            while (apart := u != v).any():
                u, v = u[apart], v[apart]
                parent[np.maximum(u, v)] = np.minimum(u, v)
                while (parent[parent] != parent).any():
                    parent = parent[parent]
                u, v = parent[u], parent[v]
    moved = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[moved], nodes[parent[moved]]


def _compare(radius: int):
    def run(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        home = table.column("home").to_numpy(zero_copy_only=False).astype(bool)
        u, v = links(fps[home], fps[~home], radius)
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})
    return run


def edges(fps: DataFrame, radius: int = RADIUS, parts: int | None = None,
          task_rows: int | None = None) -> DataFrame:
    """(u, v) on the distinct ``fp`` values: a graph with the same components
    as all links within ``radius`` bits.

    Each tile is compared with the tiles at count distance up to the radius, in
    one direction.  The number of tiles is bounded by the parts' counts (1,089
    for halves, 83,521 for quarters), whatever the input, and so is the size of
    the directory that is broadcast.  Large tiles are split on both sides, so that
    a task reads about ``task_rows`` rows.
    """
    fps = fps.select("fp").distinct() if fps.columns != ["fp"] else fps
    total = fps.count()
    if not total:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v"))
    if parts is None:
        parts = 2 if total < 4_000_000 else 4
    width = BITS // parts
    n = width + 1
    offsets = [x for x in itertools.product(range(-radius, radius + 1), repeat=parts)
               if sum(map(abs, x)) <= radius and x >= (0,) * parts]
    if task_rows is None:
        tasks = 4 * int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        task_rows = min(max(total * (len(offsets) + 1) // tasks, 2048), 1 << 20)
    mask = (1 << width) - 1
    counted = [F.bit_count(F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit(mask).cast("long")))
               for i in range(parts)]
    own = fps.select("fp", *[c.alias(f"c{i}") for i, c in enumerate(counted)])
    cs = [f"c{i}" for i in range(parts)]
    sizes = stored(own.groupBy(*cs).count(), "tiles")
    shift = F.explode(F.array(*[F.struct(*[F.lit(d).alias(f"d{i}") for i, d in enumerate(x)]) for x in offsets]))

    def back(df: DataFrame, *keep: str) -> DataFrame:
        """Each row under the tiles that it visits."""
        moved = df.withColumn("d", shift)
        return moved.select(*keep, *[(F.col(c) - F.col(f"d.d{i}")).alias(c) for i, c in enumerate(cs)]) \
            .filter(" and ".join(f"{c} between 0 and {n - 1}" for c in cs))

    visits = back(sizes, "count").groupBy(*cs).agg(F.sum("count").alias("visitors"))
    home_rows = max(task_rows // 4, 512)
    tiles = stored(sizes.join(visits, cs).select(
        *cs, F.ceil(F.col("count") / home_rows).cast("int").alias("n_home"),
        F.ceil(F.col("visitors") / task_rows).cast("int").alias("n_visit")), "tiles")
    tiles = F.broadcast(tiles)
    at_home = own.join(tiles, cs).select(
        *cs, F.pmod(F.xxhash64("fp"), "n_home").cast("int").alias("h"),
        F.explode(F.sequence(F.lit(0), F.col("n_visit") - 1)).alias("k"), F.lit(True).alias("home"), "fp")
    visiting = back(own, "fp").join(tiles, cs).select(
        *cs, F.explode(F.sequence(F.lit(0), F.col("n_home") - 1)).alias("h"),
        F.pmod(F.xxhash64("fp"), "n_visit").cast("int").alias("k"), F.lit(False).alias("home"), "fp")
    met = at_home.unionByName(visiting)
    return met.groupBy(*cs, "h", "k").applyInArrow(_compare(radius), "u long, v long")


def classes(prints: DataFrame, radius: int = RADIUS, **options) -> DataFrame:
    """(fp, rep, component_id) per distinct fingerprint of the stored ``prints``."""
    per_fp = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    linked = components.representatives(edges(per_fp.select("fp"), radius, **options)) \
        .withColumnRenamed("node", "fp")
    named = per_fp.join(linked, "fp", "left").select("fp", "least", F.coalesce("rep", "fp").alias("rep"))
    least = named.groupBy("rep").agg(F.min("least").alias("component_id"))
    return stored(named.join(least, "rep").select("fp", "rep", "component_id"), "classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits),
    component_id (smallest id of the component)."""
    prints = fingerprints(docs, id_col, text_col, shingle)
    found = classes(prints, radius, **options)
    return prints.join(found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, radius: int = RADIUS, **options) -> DataFrame:
    """``docs`` with one row of each component, same columns: the one with the
    smallest id (nulls last), of equal ids the one with the smallest text key;
    of rows equal in both, one.  Rows go by (id, text), not by their place."""
    prints = fingerprints(docs, id_col, text_col, shingle)
    found = classes(prints, radius, **options)
    ranked = prints.join(found.select("fp", "rep"), "fp").groupBy("rep").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_key")).alias("x"))
    # rows of a survivor's id and text: more than one only where whole rows repeat
    rows = prints.groupBy("doc_id", "text_key").agg(F.count("*").alias("rows"))
    first = ranked.select("x.doc_id", "x.text_key", F.lit(True).alias("first"))
    first = first.join(rows.withColumnsRenamed({"doc_id": "i", "text_key": "t"}),
                       first["doc_id"].eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("t"))) \
        .select("doc_id", "text_key", "rows")
    first = stored(first, "survivors")
    keys = {"doc_id": F.col(id_col), "text_key": text_key(text_col)}
    kept = look_up(docs, first, keys, ["rows"]).filter(F.col("__rows").isNotNull())
    once = kept.filter("__rows = 1").select(*docs.columns)
    if not first.filter("rows > 1").isEmpty():
        more = kept.filter("__rows > 1").select(*docs.columns)
        once = once.unionByName(more.dropDuplicates([id_col, text_col]))
    return once
