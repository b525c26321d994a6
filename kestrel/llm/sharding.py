"""Sharding by extendible hashing.

Rows go to the bucket of their key's leading hash bits.  A bucket that exceeds
the byte limit is split on one more bit, and only such a bucket, until every
bucket fits.  The directory is the table of buckets (prefix, depth).

A bucket is found without moving rows bit by bit: sums over the prefixes of
some more bits give all the buckets between, and a row's bucket is the
shortest of its prefixes that fits.  Rows whose buckets don't fit at that depth
go on to more bits.  Rows that all have one key (one hash) can't be split by
its bits; their bucket goes on with the bits of a row number, as an overflow
chain of further buckets under the same prefix.  A single row above the limit has a
bucket of its own (``oversized``).

Defined cases: null sizes count 0 bytes; null keys are a key of their own; an
empty table has no buckets.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import stored

BYTE_LIMIT = 16 << 20
HASH_BITS = 60
STEP_BITS = 12


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the MD5 of a key's string form (null: of none)."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def _split(rows: DataFrame, limit: int, at: int, depth: int, chain: bool) -> DataFrame:
    """Per slot (grp, the first ``depth`` bits of h): its bucket ``b`` (null:
    none of ``at`` to ``depth`` bits fits), and whether all its rows have one
    hash; stored.  An overflow chain ends at the last bit."""
    slots = stored(rows.groupBy("grp", F.shiftright("h", HASH_BITS - depth).alias("slot"))
                   .agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"),
                        (F.min("h") == F.max("h")).alias("one")), "slots")
    levels = slots.withColumn("depth", F.explode(F.sequence(F.lit(at), F.lit(depth)))) \
        .withColumn("prefix", F.expr(f"shiftright(slot, {depth} - depth)"))
    sums = levels.groupBy("grp", "depth", "prefix").agg(
        F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
    fits = (F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1)
    if chain:
        fits = fits | (F.col("depth") == HASH_BITS)
    best = levels.select("grp", "slot", "depth", "prefix").join(sums, ["grp", "depth", "prefix"]) \
        .filter(fits).groupBy("grp", "slot") \
        .agg(F.min(F.struct("depth", "prefix", "shard_bytes", "shard_rows")).alias("b"))
    return stored(slots.join(best, ["grp", "slot"], "left").select("grp", "slot", "one", "b"), "directory")


def _place(rows: DataFrame, limit: int, step: int | None, chain: bool) -> DataFrame:
    largest = rows.groupBy("grp").agg(F.sum("bytes").alias("b")).agg(F.max("b")).first()[0] or 0
    # the first look goes as deep as even buckets need, and a little more
    depth = min(HASH_BITS, step or max(4, math.ceil(math.log2(largest / limit + 1)) + 3))
    at, done = 0, []
    while True:
        found = _split(rows, limit, at, depth, chain)
        placed = rows.withColumn("slot", F.shiftright("h", HASH_BITS - depth)).join(found, ["grp", "slot"])
        bits = F.when(F.col("b.depth") == 0, F.lit("")) \
            .otherwise(F.expr("lpad(bin(b.prefix), cast(b.depth as int), '0')"))
        done.append(placed.filter("b is not null").select(
            "kept.*", (F.length(F.replace("grp", F.lit("/"))) + F.col("b.depth")).cast("long").alias("depth"),
            F.concat("grp", bits).alias("shard"), "b.shard_bytes", "b.shard_rows",
            (F.col("b.shard_bytes") > limit).alias("oversized")))
        if found.filter("b is null").isEmpty():
            break
        rest = stored(placed.filter("b is null").select(*rows.columns, "one"), "rest")
        if not chain:
            stuck = rest.filter("one").drop("one")
            if not stuck.isEmpty():  # one key: go on with the row numbers' bits
                below = stuck.withColumn("grp", F.concat(F.expr(f"lpad(bin(h), {HASH_BITS}, '0')"), F.lit("/"))) \
                    .withColumn("h", F.shiftrightunsigned(F.xxhash64("rid"), 64 - HASH_BITS))
                done.append(_place(stored(below, "overflow"), limit, step, True))
            rest = rest.filter("not one")
            if rest.isEmpty():
                break
        rows, at, depth = rest.drop("one"), depth, min(HASH_BITS, depth + (step or STEP_BITS))
    return reduce(DataFrame.unionByName, done)


def assign(df: DataFrame, key: Column, size: Column, keep: list[str], limit: int = BYTE_LIMIT,
           step: int | None = None) -> DataFrame:
    """Per row of ``df``: the columns ``keep`` and its bucket: depth, shard (the
    prefix's bits; those of an overflow chain after a ``/``), shard_bytes,
    shard_rows, oversized.  ``step``: bits looked at in one go (a plan choice)."""
    rows = df.select(F.struct(*keep).alias("kept"), hash_bits(key).alias("h"), F.coalesce(size, F.lit(0)).cast("long").alias("bytes"))
    rows = stored(rows.withColumn("rid", F.monotonically_increasing_id()).withColumn("grp", F.lit("")), "rows")
    return _place(rows, limit, step, False)


def write_shards(df: DataFrame, key: Column, size: Column, path: str, limit: int = BYTE_LIMIT) -> DataFrame:
    """Writes each bucket's rows, all columns of ``df``, under ``path`` in a folder
    of its own (``shard=...``), and returns the directory (shard, depth,
    shard_bytes, shard_rows).  ``df`` must not have a column ``shard``."""
    if "shard" in df.columns:
        raise ValueError("the table has a column shard; rename it first")
    held = df.select(F.struct(*df.columns).alias("row"), key.alias("key"), size.alias("size"))
    placed = assign(held, F.col("key"), F.col("size"), ["row"], limit)
    placed.select("row.*", "shard").repartition("shard").write.partitionBy("shard").parquet(path)
    return placed.select("shard", "depth", "shard_bytes", "shard_rows").distinct()
