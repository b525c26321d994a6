"""Partition-count helpers for CPU-heavy row work."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread_for_cpu(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """``df`` dealt round-robin over ``partitions`` tasks, or as it is when
    ``partitions`` is not given.

    A single unsplittable file (gzip text, a one-row-group parquet file)
    is read by one task; regex tokenising or parsing after it would then
    run on one core.  The caller knows its files and says so; a large table
    that arrives in many splits needs no shuffle here.
    """
    return df if partitions is None else df.repartition(partitions)
