"""Catalog work (CAT1-CAT8, SRC11-SRC13): views, typed tables, external
partitioned tables, partition registration, drops.

Tables are data-source tables in the session catalog (``USING parquet`` /
``USING csv``); no Hive metastore is needed.  Declared keys and NOT NULL
are not enforced by file tables -- see :mod:`kestrel.operators.audit`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.session import checkpoint_root, scratch_path

# The star schema of the purchases data set, as typed DDL.  Column lists and
# types are fixed values of the original schema.
STAR_SCHEMA = {
    "amenities": "amenid CHAR(11), lat FLOAT, lon FLOAT, ts TIMESTAMP, "
                 "amenity VARCHAR(1000), amname VARCHAR(1000), tags VARIANT",
    "customers": "custid CHAR(11), custname STRING, street STRING, city STRING, "
                 "province CHAR(2), postalcode CHAR(6)",
    "paymentmethods": "pmid CHAR(9), custid CHAR(11), number VARCHAR(20), "
                      "expdate CHAR(5), mtype VARCHAR(6)",
    "purchases": "purchid CHAR(15), custid CHAR(11), pmid CHAR(9), amenid CHAR(11), "
                 "pdate DATE, amount DECIMAL(7,2)",
    "greater_vancouver_prefixes": "city VARCHAR(15), pcprefix CHAR(3)",
}

# Declared keys of the same schema: (table, key) and (child, fk, parent, pk).
PRIMARY_KEYS = {"amenities": ["amenid"], "customers": ["custid"],
                "paymentmethods": ["pmid"], "purchases": ["purchid"]}
FOREIGN_KEYS = [("paymentmethods", "custid", "customers", "custid"),
                ("purchases", "custid", "customers", "custid"),
                ("purchases", "pmid", "paymentmethods", "pmid"),
                ("purchases", "amenid", "amenities", "amenid")]
NOT_NULL = {"amenities": ["amenity"]}


def view(df: DataFrame, name: str) -> DataFrame:
    """Register a temp view (CAT1)."""
    df.createOrReplaceTempView(name)
    return df


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Namespace for external tables (CAT7)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{loc}")


def create_table(spark: SparkSession, name: str, columns: str, fmt: str = "parquet",
                 location: str | None = None, partitioned_by: list[str] | None = None,
                 options: dict | None = None, replace: bool = True) -> None:
    """Typed table (CAT3); with ``location`` it is external (CAT4, CAT6).
    ``columns`` is a DDL column list; partition columns must be in it."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    parts = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    opts = ""
    if options:
        opts = " OPTIONS (" + ", ".join(f"'{k}' '{v}'" for k, v in options.items()) + ")"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt}{opts}{parts}{loc}")


def add_partitions(spark: SparkSession, table: str, column: str, values: list,
                   base_location: str | None = None, per_statement: int = 1000) -> None:
    """Register partitions, many in one statement (CAT5)."""
    parts = [f"PARTITION ({column}='{v}')" + (f" LOCATION '{base_location.rstrip('/')}/{column}={v}'"
                                              if base_location else "") for v in values]
    for k in range(0, len(parts), per_statement):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(parts[k:k + per_statement])}")


def discover_partitions(spark: SparkSession, table: str) -> None:
    """Register every partition folder found under the table (CAT5, bulk)."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table; an external table's files stay (CAT8)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def drop_schema(spark: SparkSession, name: str) -> None:
    """Drop a namespace and its tables (CAT8)."""
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


class BadRows(ValueError):
    """A bulk load met rows that don't fit the table."""


def _plain(schema: T.StructType, renames: dict | None = None) -> T.StructType:
    """A table's schema as a reader takes it: names of the file, all nullable."""
    back = {v: k for k, v in (renames or {}).items()}
    kinds = [T.StringType() if isinstance(f.dataType, (T.CharType, T.VarcharType)) else f.dataType
             for f in schema.fields]
    return T.StructType([T.StructField(back.get(f.name, f.name), k, True) for f, k in zip(schema.fields, kinds)])


_BAD = "__bad_row"


def _insert(rows: DataFrame, table: str, not_null: list[str], bad_path: str | None) -> None:
    """Insert the good rows.  A row is bad if the reader could not parse it whole
    or a ``not_null`` column is missing.  Bad rows fail the load before
    anything is inserted, or go to ``bad_path`` as JSON lines."""
    empty = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in not_null], F.lit(False))
    bad = F.col(_BAD).isNotNull() | empty
    # a reader that prunes its columns would not parse the others
    rows = rows.select("*", bad.alias("__is_bad")).checkpoint(eager=True)
    wrong = rows.filter("__is_bad").drop("__is_bad")
    if bad_path is None:
        first = wrong.limit(1).collect()
        if first:
            raise BadRows(f"{table}: {first[0].asDict()}")
    else:
        wrong.write.mode("overwrite").json(bad_path)
    rows.filter("NOT __is_bad").select(*rows.sparkSession.table(table).columns).write.insertInto(table)


def load_csv_into(spark: SparkSession, path: str, table: str, not_null: list[str] | None = None,
                  bad_path: str | None = None) -> None:
    """Bulk load CSV files into an existing typed table (SRC12).  The file is
    read with the table's own schema; a field that does not parse, or a missing
    ``not_null`` one, fails the load (or sends its row to ``bad_path``); char and
    varchar lengths are checked on insert (an over-long varchar fails the load,
    as a typed COPY would)."""
    checkpoint_root(spark)
    schema = _plain(spark.table(table).schema).add(_BAD, "string")
    rows = spark.read.schema(schema).option("columnNameOfCorruptRecord", _BAD).csv(path)
    _insert(rows, table, not_null or [], bad_path)


def load_json_into(spark: SparkSession, path: str, table: str, renames: dict | None = None,
                   not_null: list[str] | None = None, bad_path: str | None = None,
                   tolerant: bool = False) -> None:
    """Bulk load JSON lines, keys matched to columns by name (SRC11).
    ``renames`` maps a JSON key to a column (``{'timestamp': 'ts'}``).  Lines
    that do not parse fail the load or go to ``bad_path``; ``tolerant`` (SRC13)
    takes them as rows whose unreadable fields are NULL."""
    checkpoint_root(spark)
    schema = _plain(spark.table(table).schema, renames).add(_BAD, "string")
    rows = spark.read.schema(schema).option("columnNameOfCorruptRecord", _BAD).json(path) \
        .withColumnsRenamed(renames or {})
    if tolerant:
        rows = rows.withColumn(_BAD, F.lit(None).cast("string"))
    _insert(rows, table, not_null or [], bad_path)


def write_partitioned(df: DataFrame, name: str, partition_by: list[str],
                      fmt: str = "parquet", path: str | None = None) -> str:
    """Write ``df`` as a partitioned folder in the shared scratch area and
    return its path (partition layout for pruning, CAT4)."""
    path = path or scratch_path(df.sparkSession, name)
    # Rebalance on the partition columns first: each task then writes few
    # partition folders (not every task into every folder), and AQE splits
    # an oversized partition so files stay bounded.
    df.hint("rebalance", *partition_by).write.mode("overwrite") \
        .partitionBy(*partition_by).format(fmt).save(path)
    return path


def star_schema_ddl(spark: SparkSession, database: str | None = None) -> list[str]:
    """Create the typed star-schema tables (CAT3); returns their names."""
    names = []
    for t, cols in STAR_SCHEMA.items():
        full = f"{database}.{t}" if database else t
        create_table(spark, full, cols)
        names.append(full)
    return names
