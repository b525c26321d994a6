"""Grouped aggregates (AGG1-AGG6, AGG10, RE5).

All of them are single ``groupBy().agg()`` calls, which Spark plans as a
partial (map-side) aggregate, one exchange on the keys, and a final
aggregate.  A hot key therefore costs one partial row per map task, not a
third of the input in one reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(keys) -> list:
    return [keys] if isinstance(keys, (str, Column)) else list(keys)


def count_by_key(df: DataFrame, keys, out: str = "count") -> DataFrame:
    """Rows per key (AGG1)."""
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(out))


def avg_by_key(df: DataFrame, keys, value: str, out: str = "avg") -> DataFrame:
    """Average per key (AGG3); NULL values are ignored."""
    return df.groupBy(*_cols(keys)).agg(F.avg(value).alias(out))


def partial_sums(df: DataFrame, part_keys, keys, value: str) -> DataFrame:
    """Mergeable pre-aggregates (RE5, the combiner made durable).

    One row per (part, key) with ``n`` (non-NULL values) and ``total``.  The
    rows can be stored per part -- a day, a file, a batch -- and merged later
    with :func:`merge_partial_sums` into exact totals.
    """
    return df.groupBy(*_cols(part_keys), *_cols(keys)).agg(
        F.count(value).alias("n"), F.sum(value).alias("total"))


def merge_partial_sums(parts: DataFrame, keys, out: str = "avg") -> DataFrame:
    """Merge (n, total) rows into per-key count, sum and average (AGG2)."""
    return parts.groupBy(*_cols(keys)).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")) \
        .withColumn(out, F.try_divide(F.col("total"), F.col("n")))


def max_by_key(df: DataFrame, keys, value: str, out: str = "max") -> DataFrame:
    """True maximum per key (AGG4); all-negative groups keep their value."""
    return df.groupBy(*_cols(keys)).agg(F.max(value).alias(out))


def argmax_by_key(df: DataFrame, keys, value: str, payload: str,
                  out_value: str | None = None, out_payload: str | None = None) -> DataFrame:
    """One row per key: the largest ``value`` and its ``payload`` (AGG5).

    A tie on ``value`` goes to the greatest payload, so the answer does not
    depend on merge order.  First the greatest payload of each (key, value),
    then the payload of the largest value: both aggregates keep fixed-width
    buffers, so Spark hashes (a struct buffer would be sorted), and both
    combine map-side.  Rows with a NULL value are ignored; a key with no
    other rows keeps NULLs.
    """
    by_value = df.groupBy(*_cols(keys), F.col(value).alias("__v")).agg(F.max(payload).alias("__p"))
    return by_value.groupBy(*_cols(keys)).agg(
        F.max("__v").alias(out_value or value), F.max_by("__p", "__v").alias(out_payload or payload))


def count_and_sum(df: DataFrame, keys, value: str, n_out: str = "n",
                  sum_out: str = "total") -> DataFrame:
    """Count and sum per key (AGG6)."""
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(n_out),
                                        F.sum(value).alias(sum_out))


def global_mean(df: DataFrame, value: str, out: str = "mean") -> DataFrame:
    """Global sum/average by one reduce (AGG10)."""
    return df.agg(F.count(value).alias("n"), F.sum(value).alias("total"),
                  F.avg(value).alias(out))
