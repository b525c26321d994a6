"""The driver's parquet tables, and stand-in inputs derived from them.

The stand-in builders only shape rows into the schema a job expects (a
text line, an edge, a colour); the job then does all of its work on them
through the library's operators.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table.  Column pruning and filter pushdown reach the
    parquet scan because nothing here selects or materialises."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


#: English month names of log times: fixed values.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def day_text(ts: str = "ts"):
    """``yyyy-MM-dd`` of a timestamp without zone (no session zone enters)."""
    return F.substring(F.col(ts).cast("string"), 1, 10)


def hour_text(ts: str = "ts"):
    """``yyyy-MM-dd HH`` of a timestamp without zone."""
    return F.substring(F.col(ts).cast("string"), 1, 13)


def reading_flag(event_id: str = "event_id"):
    """Quality flag of a stand-in reading: 'X' on every 29th id (about 3 per
    cent), whatever the reading's value."""
    return F.when(F.col(event_id) % 29 == 0, F.lit("X"))


def access_log_lines(events: DataFrame) -> DataFrame:
    """Access-log text lines shaped from ``events`` (one per event).

    ``error`` events get a ``-`` byte count, as servers write for empty
    responses; such lines do not match the log pattern and are dropped by
    the parser.
    """
    size = F.when(F.col("event_type") == "error", F.lit("-")) \
        .otherwise(F.round(F.col("value") * 100).cast("bigint").cast("string"))
    line = F.format_string('%s - - [%s -0800] "GET %s HTTP/1.0" 200 %s',
                           F.concat(F.lit("host"), F.col("user_id").cast("string")),
                           F.concat(F.substring(F.col("ts").cast("string"), 9, 2), F.lit("/"),
                                    F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month("ts")),
                                    F.lit("/"), F.substring(F.col("ts").cast("string"), 1, 4), F.lit(":"),
                                    F.substring(F.col("ts").cast("string"), 12, 8)),
                           F.concat(F.lit("/"), F.col("event_type"), F.lit("/"),
                                    F.col("event_id").cast("string")),
                           size)
    return events.select(line.alias("value"))


def order_edges(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Directed edges customer -> (order key mod the number of customers), the
    graph stand-in; the number of nodes follows the tables."""
    nodes = max(customer.count(), 1)
    return orders.select(F.col("o_custkey").alias("src"),
                         (F.col("o_orderkey") % nodes).alias("dest"))


def part_colours(part: DataFrame) -> DataFrame:
    """RGB bytes shaped from part columns."""
    return part.select("p_partkey",
                       (F.col("p_partkey") % 256).cast("int").alias("R"),
                       ((F.col("p_size") * 5) % 256).cast("int").alias("G"),
                       (F.col("p_retailprice").cast("int") % 256).cast("int").alias("B"))


def point_messages(events: DataFrame) -> DataFrame:
    """``"x y"`` text messages from events (x = props.k, y = value)."""
    k = F.get_json_object("props", "$.k")
    return events.select(F.concat_ws(" ", k, F.col("value").cast("string")).alias("value"))


def weather_observations(events: DataFrame) -> DataFrame:
    """Weather-station readings shaped from events: station 'U' || user_id,
    date yyyyMMdd, purchase -> TMAX and click -> TMIN (others keep their type
    in upper case), value in tenths, quality flag of :func:`reading_flag`."""
    obs = F.when(F.col("event_type") == "purchase", F.lit("TMAX")) \
        .when(F.col("event_type") == "click", F.lit("TMIN")) \
        .otherwise(F.upper("event_type"))
    return events.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("station"),
        F.replace(day_text(), F.lit("-"), F.lit("")).alias("date"),
        obs.alias("observation"),
        F.round(F.col("value") * 10).cast("int").alias("value"),
        F.lit(None).cast("string").alias("mflag"),
        reading_flag().alias("qflag"),
        F.lit("S").alias("sflag"),
        F.replace(F.substring(F.col("ts").cast("string"), 12, 5), F.lit(":"), F.lit("")).alias("obstime"))


def page_view_lines(events: DataFrame) -> DataFrame:
    """Page-view rows shaped from events: the hour as ``yyyyMMdd-HH``, a locale,
    a title (some are the main page or special pages, some start with a quote),
    views and bytes."""
    uid = F.col("user_id")
    title = F.when(uid % 11 == 0, F.lit("Main_Page")).when(uid % 7 == 0, F.concat(F.lit("Special:"), uid)) \
        .when(uid % 5 == 0, F.concat(F.lit('"Page_'), uid)).otherwise(F.concat(F.lit("Page_"), uid))
    hour = F.concat(F.replace(day_text(), F.lit("-"), F.lit("")), F.lit("-"),
                    F.substring(F.col("ts").cast("string"), 12, 2))
    return events.select(hour.alias("hour"),
                         F.when(F.col("event_type") == "error", F.lit("fr")).otherwise(F.lit("en")).alias("locale"),
                         title.alias("title"), (F.col("event_id") % 97).alias("views"),
                         (F.col("event_id") * 3).alias("bytes"))
