"""Row filters and projections of the ETL jobs (PRJ1-PRJ5, FLT1-FLT8,
JSN1-JSN3).  Filters are plain predicates so Catalyst pushes them into the
scan (``PushedFilters``) and prunes columns (``ReadSchema``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def observations(df: DataFrame, flag: str, station: str, prefix: str,
                 observation: str, wanted: str, value: str, date: str,
                 scale: float = 10.0, out: str = "tmax") -> DataFrame:
    """Keep clean readings of one kind from stations with a prefix, scaled.

    ``flag IS NULL`` (quality flag absent), ``station`` starts with
    ``prefix``, ``observation == wanted``; ``value / scale`` as ``out``.
    """
    return df.filter(F.col(flag).isNull() & F.col(station).startswith(prefix) &
                     (F.col(observation) == wanted)) \
        .select(F.col(station).alias("station"), F.col(date).alias("date"),
                (F.col(value) / scale).alias(out))


def segment_rows(df: DataFrame, segment: str, letter: str, score: str,
                 positive: bool, fields: list[str]) -> DataFrame:
    """Rows whose ``segment`` contains ``letter``, split by the sign of
    ``score`` (``> 0``, or not), keeping ``fields`` (FLT3, FLT5, PRJ1).  A NULL
    score is not positive, so the two sides are complementary."""
    sign = F.col(score) > 0 if positive else (F.col(score) <= 0) | F.col(score).isNull()
    return df.filter(F.col(segment).contains(letter) & sign).select(*fields)


def json_field(text: str | Column, schema: str) -> Column:
    """Parse a JSON text column with a fixed schema (JSN1); missing key or
    malformed text -> NULL fields."""
    c = F.col(text) if isinstance(text, str) else text
    return F.from_json(c, schema)


def to_json_line(*cols) -> Column:
    """Serialise columns to one JSON object (JSN2)."""
    return F.to_json(F.struct(*cols))


def variant_path(text: str | Column, path: str, type_: str = "string") -> Column:
    """Path into semi-structured text; a missing key or wrong type -> NULL
    (JSN3; the SUPER-column behaviour)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.try_variant_get(F.try_parse_json(c), path, type_)


def tag(df: DataFrame, name: str, value) -> DataFrame:
    """Constant column (PRJ5)."""
    return df.withColumn(name, F.lit(value))


def page_views(df: DataFrame, locale: str = "en", excluded_title: str = "Main_Page",
               excluded_prefix: str = "Special:") -> DataFrame:
    """Page-view rows worth ranking: one locale, not the main page, not a
    special page (FLT1 equality and inequality, FLT2 negated prefix, FLT6)."""
    return df.filter((F.col("locale") == locale) & (F.col("title") != excluded_title) &
                     ~F.col("title").startswith(excluded_prefix))


def hourly_page_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """``hour locale title views bytes`` lines, cut at white space, as typed
    columns; lines without five fields, or with a count that is none, are left out."""
    parts = F.split(F.trim(F.col(col)), r"\s+")
    rows = lines.select(parts.alias("p")).filter(F.size("p") == 5)
    return rows.select(F.col("p")[0].alias("hour"), F.col("p")[1].alias("locale"), F.col("p")[2].alias("title"),
                       F.col("p")[3].try_cast("bigint").alias("views"),
                       F.col("p")[4].try_cast("bigint").alias("bytes")).filter(F.col("views").isNotNull())
