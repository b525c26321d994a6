"""Tables that grow by batches (SNK5 RE5).

An appended batch is data and an entry in a list of batches.  The data go to a folder of
the batch, the entry is written last, and readers look at listed batches alone.  So
a batch that is tried again adds nothing, one that broke off is not seen, and trying it again
replaces what it left.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators import aggregate
from kestrel.sources.files import rows
from kestrel.sources.sinks import replace_partitions

_ID = re.compile(r"[A-Za-z0-9_.-]{1,200}")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def append_batch(df: DataFrame, table: str, batch: str) -> bool:
    """Append ``df`` to the folder ``table`` as the batch ``batch``; False, and nothing is
    written, if that batch is listed already.  Two writers may not append one batch at once."""
    if not _ID.fullmatch(batch) or batch.startswith((".", "_")):
        raise ValueError(f"not a batch id: {batch}")
    spark = df.sparkSession
    if _exists(spark, f"{table}/batches/{batch}/_SUCCESS"):
        return False
    df.hint("rebalance").write.mode("overwrite").parquet(f"{table}/data/batch={batch}")
    rows(spark, [(batch,)], "batch string").coalesce(1).write.mode("overwrite").parquet(f"{table}/batches/{batch}")
    return True


def read_batches(spark: SparkSession, table: str, schema) -> DataFrame:
    """The rows of the listed batches, with ``batch``.  ``schema`` is that of the data; a table without
    batches is empty."""
    if not _exists(spark, f"{table}/batches"):
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(None).cast("string"))
    listed = spark.read.schema("batch string").parquet(f"{table}/batches/*")
    data = spark.read.schema(schema).option("basePath", f"{table}/data").parquet(f"{table}/data")
    return data.withColumn("batch", F.col("batch").cast("string")).join(listed, "batch", "left_semi")


def store_partial_sums(df: DataFrame, table: str, part: str, keys: list[str], value: str) -> None:
    """Write the (n, total) rows of the parts of ``df`` into the folder ``table``: a part that is there
    already is replaced, others stay as they are (RE5)."""
    replace_partitions(aggregate.partial_sums(df, part, keys, value), table, [part])


def stored_averages(spark: SparkSession, table: str, schema, keys: list[str], out: str = "avg") -> DataFrame:
    """Count, sum and average per key from the stored parts; raw rows are not read again."""
    return aggregate.merge_partial_sums(spark.read.schema(schema).parquet(table), keys, out)
