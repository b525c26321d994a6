"""Ordered running sums per group that survive a hot group (RE2).

A plain ``sum().over(partitionBy(g).orderBy(o))`` sends every row of a
group to one task; if one group holds a third of the data, that task sorts
a third of the data.  Here the work is split in two levels:

1. ``repartitionByRange(g, *o)`` samples the key distribution and cuts the
   ordered key space into ranges of similar size.  A hot group is spread
   over several consecutive ranges ("chunks"); a range id is
   ``spark_partition_id()``, which is monotone in the key order.  The
   chunked rows are checkpointed so that every later branch reads the same cut.
2. Per (group, chunk): the chunk's row count and value sum -- a tiny table
   of at most ``groups + partitions`` rows.  A window over it (per group,
   ordered by chunk) gives each chunk the count and sum of everything
   before it.
3. The running sum inside each (group, chunk) is a window whose partition
   is bounded by the range size, plus the chunk's offset.

The result is exact: row positions and running sums are those of one
sequential scan of the group in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import materialize


def _chunked(df: DataFrame, group: str, order: list[str], chunks: int | None) -> DataFrame:
    """``df`` in ranges of the key order, with the range as ``__chunk``.

    All branches must see the *same* cut: a second exchange would sample its
    own bounds.  Materialising the rows (reliable checkpoint, which goes when
    nothing refers to it any more) pins one cut.
    """
    cut = (df.repartitionByRange(chunks, group, *order) if chunks
           else df.repartitionByRange(group, *order))
    return materialize(cut.withColumn("__chunk", F.spark_partition_id()))


def running_sum(df: DataFrame, group: str, order: list[str], value: str,
                chunks: int | None = None, sum_out: str = "running_sum",
                pos_out: str = "position") -> DataFrame:
    """Append the 1-based position of each row inside its group (in
    ``order``) and the running sum of ``value`` up to and including it.  A
    NULL value adds nothing; a NULL group is a group of its own."""
    chunked = _chunked(df, group, order, chunks)

    # Offsets: one row per (group, chunk) -- a hot group spans few chunks,
    # and only boundary groups span more than one.
    per_chunk = chunked.groupBy(group, "__chunk").agg(
        F.count(F.lit(1)).alias("__n"), F.sum(value).alias("__s"))
    before = Window.partitionBy(group).orderBy("__chunk") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_chunk.select(
        group, "__chunk",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n0"),
        F.coalesce(F.sum("__s").over(before), F.lit(0.0)).alias("__s0"))

    inside = Window.partitionBy(group, "__chunk").orderBy(*order) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = offsets.withColumnsRenamed({group: "__g", "__chunk": "__c"})
    same = chunked[group].eqNullSafe(offsets["__g"]) & (chunked["__chunk"] == offsets["__c"])
    return chunked.join(offsets, same).select(
        *df.columns,
        (F.col("__n0") + F.row_number().over(
            Window.partitionBy(group, "__chunk").orderBy(*order))).alias(pos_out),
        (F.col("__s0") + F.coalesce(F.sum(value).over(inside), F.lit(0))).alias(sum_out))


def first_crossing(df: DataFrame, group: str, order: list[str], value: str,
                   limit: float, chunks: int | None = None,
                   out: str = "steps") -> DataFrame:
    """Per group: how many rows, in ``order``, until the running sum of
    ``value`` first reaches ``limit`` (``>=``; the reaching row counts).
    Groups that never reach it are absent.

    Each chunk's largest prefix sum tells whether the group crosses there, so
    the group's first such chunk is known from one row per (group, chunk), and
    only the rows of that chunk are looked at.
    """
    rows = df.select(group, *order, value)
    chunked = _chunked(rows, group, order, chunks)
    inside = Window.partitionBy(group, "__chunk").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prefix = chunked.select(group, "__chunk", F.row_number().over(inside).alias("__pos"),
                            F.coalesce(F.sum(value).over(upto), F.lit(0.0)).alias("__pre"), F.col(value).alias("__v"))
    # the window's partitions are the aggregate's: no further shuffle
    per_chunk = prefix.groupBy(group, "__chunk").agg(
        F.count(F.lit(1)).alias("__n"), F.coalesce(F.sum("__v"), F.lit(0.0)).alias("__s"), F.max("__pre").alias("__top"))
    before = Window.partitionBy(group).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    reached = per_chunk.select(group, "__chunk", "__top",
                               F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n0"),
                               F.coalesce(F.sum("__s").over(before), F.lit(0.0)).alias("__s0")) \
        .filter(F.col("__s0") + F.col("__top") >= limit) \
        .groupBy(group).agg(F.min(F.struct("__chunk", "__n0", "__s0")).alias("__at"))
    reached = reached.select(F.col(group).alias("__g"), "__at.*").withColumnRenamed("__chunk", "__c")
    same = prefix[group].eqNullSafe(reached["__g"]) & (prefix["__chunk"] == reached["__c"])
    return prefix.join(reached, same).filter(F.col("__s0") + F.col("__pre") >= limit) \
        .groupBy(group).agg(F.min(F.col("__n0") + F.col("__pos")).alias(out))


def mean_first_crossing(crossings: DataFrame, steps: str = "steps") -> DataFrame:
    """Number of groups and mean steps to the crossing (AGG10)."""
    return crossings.agg(F.count(F.lit(1)).alias("n_groups"),
                         F.avg(steps).alias("mean_steps"))
