"""Joins (JN1-JN3, JN5, JN6) and the size-checked broadcast.

Broadcast policy:

* ``"auto"`` (default): no hint.  With AQE on, Spark measures each side at
  the shuffle boundary and converts the join to a broadcast join only when
  the measured size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
  -- a proven bound, taken at run time.
* ``"checked"``: the small side is measured with a bounded read of at most
  ``max_rows + 1`` rows; it is broadcast only if it has at most ``max_rows``
  rows and ``max_bytes`` bytes, otherwise an ordinary shuffle join is used.
* ``"never"``: shuffle join.

A broadcast is never forced on a side whose size is unknown.

Joining rows back to a one-row-per-key table (group means, group maxima)
is the one place where AQE's skew handling does not help: the per-key side
comes out of an aggregate, so the join has no plain shuffle stage on that
side to split against.  :func:`join_per_key` handles it: keys holding more
than ``rows_per_task`` rows are *hot*; there are at most
``total_rows / rows_per_task`` of them.  Rows find their key's number of salts
in the list of hot keys (broadcast behind the same check, else a shuffle join
of two plain stages, which AQE may split).  A hot key's rows get a salt in ``[0, n)`` with
``n = ceil(count / rows_per_task)`` and its per-key row is replicated ``n``
times, so the key is spread over ``n`` tasks; cold keys join as usual.  The
salt is a hash of the row's columns, so a retried task deals its rows out as
before.  Keys compare null-safely: rows with a NULL key meet their group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import materialize

DEFAULT_MAX_BROADCAST_ROWS = 200_000
DEFAULT_MAX_BROADCAST_BYTES = 32 << 20
DEFAULT_ROWS_PER_TASK = 5_000_000


def is_small(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
             max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows that are together at most
    ``max_bytes`` long (as JSON text, an upper estimate for most types).
    Reads at most ``max_rows + 1`` rows of the result."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    row = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    return row["n"] <= max_rows and (row["b"] or 0) <= max_bytes


def join(big: DataFrame, small: DataFrame, on, how: str = "inner",
         broadcast: str = "auto", max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Equi-join with an explicit broadcast policy (JN1, JN2, JN5)."""
    if broadcast == "checked" and is_small(small, max_rows):
        return big.join(F.broadcast(small), on, how)
    if broadcast == "never":
        return big.hint("shuffle_merge").join(small, on, how)
    return big.join(small, on, how)


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on equal keys, NULL equal to NULL; the keys appear once."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys])
    return left.join(renamed, on).drop(*[f"__r_{k}" for k in keys])


def join_per_key(big: DataFrame, per_key: DataFrame, key, count_col: str,
                 broadcast: str = "auto", rows_per_task: int = DEFAULT_ROWS_PER_TASK,
                 max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Inner join of ``big`` with ``per_key`` (one row per key, where
    ``count_col`` is the number of ``big`` rows with that key), safe for
    hot keys.

    ``broadcast='checked'``: the whole per-key table is broadcast when it
    is small (then nothing of ``big`` moves).  Otherwise, and for ``'auto'``:
    hot keys are salted as described in the module notes.  ``'never'``: plain
    shuffle join.
    """
    keys = _keys(key)
    if broadcast == "never":
        return _null_safe_join(big, per_key, keys)
    if broadcast == "checked" and is_small(per_key, max_rows):
        return _null_safe_join(big, F.broadcast(per_key), keys)
    per_key = materialize(per_key)
    hot = per_key.filter(F.col(count_col) > rows_per_task).select(
        *[F.col(k).alias(f"__h_{k}") for k in keys],
        F.ceil(F.col(count_col) / F.lit(rows_per_task)).cast("int").alias("__salts"))
    if is_small(hot, max_rows):
        hot = F.broadcast(hot)

    def on_hot(df):
        return reduce(lambda a, b: a & b, [df[k].eqNullSafe(F.col(f"__h_{k}")) for k in keys])

    hot_cols = [f"__h_{k}" for k in keys]
    salted = big.join(hot, on_hot(big), "left") \
        .withColumn("__salt", F.when(F.col("__salts").isNull(), F.lit(0))
                    .otherwise(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]),
                                      F.col("__salts")).cast("int"))) \
        .drop("__salts", *hot_cols)
    spread = per_key.join(hot, on_hot(per_key), "left") \
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1))) \
        .drop("__salts", *hot_cols)
    return _null_safe_join(salted, spread, keys + ["__salt"]).drop("__salt")


def relative_to_group_mean(df: DataFrame, key: str, score: str, label: str,
                           broadcast: str = "auto",
                           max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                           rows_per_task: int = DEFAULT_ROWS_PER_TASK) -> DataFrame:
    """Each row's score divided by its group's mean, for groups whose mean is
    positive (JN1 / JN2 + AGG2 + FLT5 + MTH1).

    Output: ``relative_score, <label>, <key>``, sorted by ``relative_score``
    descending, then label and key (SRT2).  Rows without a score have no
    relative score and are left out.  The group means are one partial aggregate; only rows
    whose group survives the ``mean > 0`` filter come out of the join, which
    splits hot groups (:func:`join_per_key`).
    """
    rows = df.filter(F.col(score).isNotNull()).select(key, score, label)
    means = rows.groupBy(key).agg(F.avg(score).alias("__mean"), F.count(F.lit(1)).alias("__cnt")) \
        .filter(F.col("__mean") > 0)
    joined = join_per_key(rows, means, key, "__cnt", broadcast, rows_per_task, max_rows)
    # Label and key break ties in the sort: equal sort keys cannot be split
    # by the range partitioner, so a score shared by many rows would
    # otherwise land in one task.
    return joined.select(
        (F.col(score).cast("double") / F.col("__mean")).alias("relative_score"),
        F.col(label), F.col(key),
    ).orderBy(F.col("relative_score").desc(), F.col(label), F.col(key))


def relative_to_group_mean_window(df: DataFrame, key: str, score: str, label: str) -> DataFrame:
    """Same answer as :func:`relative_to_group_mean` with a window average
    instead of aggregate + join (one shuffle, no join).  The join form is
    preferred for skewed keys: a window sends a hot group to one task."""
    from pyspark.sql import Window
    w = Window.partitionBy(key)
    return df.filter(F.col(score).isNotNull()) \
        .select(key, score, label, F.avg(score).over(w).alias("__mean")) \
        .filter(F.col("__mean") > 0) \
        .select((F.col(score).cast("double") / F.col("__mean")).alias("relative_score"),
                F.col(label), F.col(key)) \
        .orderBy(F.col("relative_score").desc(), F.col(label), F.col(key))


def previous_day_join(daily: DataFrame, key: str, date: str, value: str,
                      out: str | None = None) -> DataFrame:
    """Attach yesterday's value for the same key (JN6, DAT2).

    An equi-join on ``(key, date - 1)``: a gap in the dates gives no match,
    unlike ``lag``, which would pair a row with whatever came before it.
    Both sides hash on ``(key, date)``-derived keys, so a skewed key is split
    over many dates.
    """
    out = out or f"yesterday_{value}"
    today = daily.alias("today")
    yesterday = daily.select(F.col(key).alias("__k"), F.col(date).alias("__d"),
                             F.col(value).alias(out))
    return today.join(
        yesterday,
        (F.col(f"today.{key}") == F.col("__k")) &
        (F.date_sub(F.col(f"today.{date}"), 1) == F.col("__d")),
        "inner").select("today.*", F.col(out))
