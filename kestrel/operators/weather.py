"""Daily temperature range and its per-day peak (FLT4 FLT1 JN3 PRJ2 AGG4 JN4 SRT3).

The original joined every TMAX row to every TMIN row of the same
(date, station); duplicate readings then multiply into all pairs.  Here the
readings are reduced first -- highest TMAX and lowest TMIN per (date,
station), one partial aggregate and one shuffle, no join -- so the output
is one row per (date, station) whatever the duplication.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators import peaks

WEATHER_SCHEMA = ("station string, date string, observation string, value int, "
                  "mflag string, qflag string, sflag string, obstime string")


def daily_range(obs: DataFrame, scale: float = 10.0) -> DataFrame:
    """``date, station, range`` with range = (max TMAX - min TMIN) / scale,
    from readings whose quality flag is empty."""
    clean = obs.filter(F.col("qflag").isNull())
    per_day = clean.groupBy("date", "station").agg(
        F.max(F.when(F.col("observation") == "TMAX", F.col("value"))).alias("tmax"),
        F.min(F.when(F.col("observation") == "TMIN", F.col("value"))).alias("tmin"))
    return per_day.filter(F.col("tmax").isNotNull() & F.col("tmin").isNotNull()) \
        .select("date", "station", ((F.col("tmax") - F.col("tmin")) / scale).alias("range"))


def widest_range_per_day(obs: DataFrame, scale: float = 10.0) -> DataFrame:
    """Stations with the widest range of each day (ties kept), sorted by
    date then station."""
    return peaks.rows_at_group_max(daily_range(obs, scale), "date", "range") \
        .orderBy("date", "station")
