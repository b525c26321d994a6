"""Writers (SNK1-SNK5).  These are the only actions in the batch jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_lines(df: DataFrame, path: str, fmt: str | None = None,
                columns: list[str] | None = None, sep: str = "\t",
                mode: str = "overwrite", compression: str | None = None) -> None:
    """One text line per row (SNK1).

    ``fmt`` is a ``format_string`` pattern (``'%s %d'``); otherwise the
    columns are joined by ``sep``.
    """
    cols = columns or df.columns
    if fmt is not None:
        line = F.format_string(fmt, *[F.col(c) for c in cols])
    else:
        line = F.concat_ws(sep, *[F.col(c).cast("string") for c in cols])
    writer = df.select(line.alias("value")).write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite",
              header: bool = False) -> None:
    """CSV, overwrite by default (SNK2)."""
    df.write.mode(mode).option("header", header).csv(path)


def write_json(df: DataFrame, path: str, compression: str | None = None,
               mode: str = "overwrite") -> None:
    """JSON lines, optionally gzip (SNK3)."""
    writer = df.write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)


def split_write(df: DataFrame, predicate: Column, output: str, fmt: str = "json") -> None:
    """One input, two complementary outputs (SNK4).

    A single job: the flag becomes a partition column, so the input is read
    once without a cache, and the two outputs land in ``output/side=positive``
    and ``output/side=negative``.  Rows whose predicate is NULL go to the
    negative side instead of vanishing from both.
    """
    flagged = df.withColumn("side", F.when(F.coalesce(predicate, F.lit(False)),
                                           F.lit("positive")).otherwise(F.lit("negative")))
    flagged.write.mode("overwrite").partitionBy("side").format(fmt).save(output)


def split_frames(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """The two sides of SNK4 as DataFrames (NULL predicate -> negative)."""
    p = F.coalesce(predicate, F.lit(False))
    return df.filter(p), df.filter(~p)


def append_table(df: DataFrame, path_or_table: str, fmt: str = "parquet",
                 partition_by: list[str] | None = None, as_table: bool = False) -> None:
    """Append to a keyed table (SNK5).

    The original forced 50 writers; here AQE's rebalance sizes the output
    files from the measured data instead of a fixed count.  It deals rows by
    the partition columns, so that a task writes few folders.
    """
    writer = df.hint("rebalance", *(partition_by or [])).write.mode("append").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if as_table:
        writer.saveAsTable(path_or_table)
    else:
        writer.save(path_or_table)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str],
                       fmt: str = "parquet") -> None:
    """Write whole partitions of a keyed table (SNK5): those that ``df`` has rows
    for are replaced, the others stay.  Loading the same days again gives
    the same table."""
    df.hint("rebalance", *partition_by).write.mode("overwrite").format(fmt) \
        .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).save(path)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows, for a look at a result (LIM1).  The limit is the
    feature here; Spark stops reading once ``n`` rows are found."""
    return df.limit(n)
