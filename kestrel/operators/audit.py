"""Key and NOT NULL audits (CAT9, CAT10).

The session catalog does not enforce primary/foreign keys or NOT NULL on
file tables, so declared constraints are checked by jobs:

* duplicate keys -- ``groupBy(key).count() > 1`` (partial aggregate);
* orphans -- ``left_anti`` join of the child's foreign key on the parent's
  key (distinct parent keys, so the right side is as small as it can be);
* NULL counts -- one aggregate over all audited columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")) \
        .filter(F.col("n_rows") > 1)


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose (non-NULL) foreign key has no parent row.

    The orphan *keys* are found on per-key counts (no skew: one row per
    key); the child rows are then joined back to those keys with
    :func:`kestrel.operators.joins.join_per_key`, which spreads a hot
    orphan key over several tasks.
    """
    from kestrel.operators.joins import join_per_key
    checked = child.filter(F.col(fk).isNotNull())
    per_key = checked.groupBy(fk).agg(F.count(F.lit(1)).alias("__n"))
    parents = parent.select(F.col(pk).alias("__pk")).distinct()
    orphan_keys = per_key.join(parents, F.col(fk) == F.col("__pk"), "left_anti")
    return join_per_key(checked, orphan_keys, fk, "__n").drop("__n")


def orphan_summary(child: DataFrame, child_name: str, fk: str,
                   parent: DataFrame, parent_name: str, pk: str) -> DataFrame:
    """One row: relationship name, child rows checked, orphan rows.

    Keys of both sides go into one aggregate, which counts a key's child rows and
    notes whether a parent has it: one shuffle of partial rows, no join and no
    ``distinct``.  A key referenced by a third of the child rows costs one row
    per task.
    """
    both = child.filter(F.col(fk).isNotNull()).select(F.col(fk).alias("__k"), F.lit(1).alias("__n"), F.lit(0).alias("__p")) \
        .union(parent.filter(F.col(pk).isNotNull()).select(F.col(pk).alias("__k"), F.lit(0), F.lit(1)))
    per_key = both.groupBy("__k").agg(F.sum("__n").alias("__n"), F.max("__p").alias("__p"))
    return per_key.agg(
        F.lit(f"{child_name}.{fk} -> {parent_name}.{pk}").alias("relationship"),
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_checked"),
        F.coalesce(F.sum(F.when(F.col("__p") == 0, F.col("__n"))), F.lit(0)).alias("n_orphans"))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: how many rows hold NULL there.  One scan."""
    cols = columns or df.columns
    wide = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, n_nulls)")
