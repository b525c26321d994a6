"""Rows at their group's maximum, and top-1 per group (JN4, JN5, WIN1).

Two equivalent forms of "keep every row whose value equals its group's
maximum" (ties kept):

* :func:`rows_at_group_max` -- ``rank() == 1`` over a window.  Spark plans
  the filter as a *partial* ``WindowGroupLimit`` before the exchange, so
  each map task forwards only its local rank-1 rows of a hot group.
* :func:`rows_at_group_max_join` -- aggregate the maximum (and row count)
  per group (partial aggregation), then join it back on ``(group, value)``
  with :func:`kestrel.operators.joins.join_per_key`: broadcast when the
  maxima are proven small, hot groups salted otherwise.

Both forms drop NULL values first, and keep rows whose group is NULL: they
are a group of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.joins import (DEFAULT_MAX_BROADCAST_ROWS, DEFAULT_ROWS_PER_TASK,
                                     join_per_key)


def _cols(keys) -> list:
    return [keys] if isinstance(keys, (str, Column)) else list(keys)


def rows_at_group_max(df: DataFrame, keys, value: str) -> DataFrame:
    w = Window.partitionBy(*_cols(keys)).orderBy(F.col(value).desc())
    return df.filter(F.col(value).isNotNull()) \
        .withColumn("__rank", F.rank().over(w)) \
        .filter(F.col("__rank") == 1).drop("__rank")


def rows_at_group_max_join(df: DataFrame, keys, value: str, broadcast: str = "auto",
                           max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                           rows_per_task: int = DEFAULT_ROWS_PER_TASK) -> DataFrame:
    keys = _cols(keys)
    rows = df.filter(F.col(value).isNotNull())
    maxima = rows.groupBy(*keys).agg(F.max(value).alias(value), F.count(F.lit(1)).alias("__cnt"))
    return join_per_key(rows, maxima, keys + [value], "__cnt", broadcast,
                        rows_per_task, max_rows).drop("__cnt")


def first_per_group(df: DataFrame, keys, order: list) -> DataFrame:
    """Exactly one row per group: the first by ``order`` (WIN1).

    Make ``order`` total (end it with a unique column) for a repeatable
    winner.  ``row_number() == 1`` is planned with a partial
    ``WindowGroupLimit`` ahead of the shuffle, so hot groups are cut down to
    one row per map task before they move.
    """
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
