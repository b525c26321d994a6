"""Readers (SRC1-SRC13).  All schemas are explicit: nothing is inferred,
so a scan never needs an extra pass over the data and types are stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines as ``value string`` (SRC1).  ``.gz`` files are decoded by
    suffix (SRC2); gzip is not splittable, so each such file is one task --
    use ``rebalance`` afterwards for CPU-heavy parsing."""
    return spark.read.text(path)


def read_csv(spark: SparkSession, path, schema: T.StructType | str, sep: str = ",",
             header: bool = False, quote: str | None = None,
             mode: str = "PERMISSIVE") -> DataFrame:
    """Delimited text with a fixed schema (SRC3, SRC4, SRC12).

    A field that does not parse becomes NULL (PERMISSIVE).  For
    space-delimited page-view dumps pass ``quote=''`` so a title that begins
    with ``"`` does not swallow the rest of the line.
    """
    reader = spark.read.schema(schema).option("sep", sep).option("header", header) \
        .option("mode", mode)
    if quote is not None:
        reader = reader.option("quote", quote)
    return reader.csv(path)


def read_json(spark: SparkSession, path, schema: T.StructType | str,
              mode: str = "PERMISSIVE", corrupt_column: str | None = None) -> DataFrame:
    """JSON lines with an explicit schema (SRC5, SRC11, SRC13).

    Missing keys read as NULL; a malformed line gives an all-NULL row, or
    lands in ``corrupt_column`` when it is named (and part of the schema).
    """
    reader = spark.read.schema(schema).option("mode", mode)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.json(path)


def with_source_file(df: DataFrame, column: str = "file_path") -> DataFrame:
    """Attach the full path of the file each row came from (SRC6): files of
    the same name in different folders stay apart."""
    return df.withColumn(column, F.col("_metadata.file_path"))


def rows(spark: SparkSession, data, schema) -> DataFrame:
    """Literal rows to a table (SRC7).  For small driver-side inputs only.

    The rows become literals of one ``inline`` expression, so the table is
    built in the JVM -- no Python worker is started to deserialize them.
    ``schema`` is a DDL string or a ``StructType``.
    """
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if not data:
        return spark.createDataFrame([], st)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                          for v, f in zip(row, st.fields)]) for row in data]
    return spark.range(1).select(F.inline(F.array(*structs))).select(
        *[F.col(f.name).cast(f.dataType) for f in st.fields])


def trials(spark: SparkSession, n: int, slices: int | None = None) -> DataFrame:
    """Integer ids ``0..n-1`` spread over ``slices`` partitions (SRC8)."""
    return spark.range(0, n, 1, slices)


def read_table(spark: SparkSession, path_or_name: str, fmt: str = "parquet",
               **options) -> DataFrame:
    """Keyed external table (SRC9).  The original read a wide-column store
    through its connector; the format is a parameter, parquet by default
    (the connector jar is not part of a plain Spark distribution)."""
    if fmt == "table":
        return spark.table(path_or_name)
    return spark.read.format(fmt).options(**options).load(path_or_name)
