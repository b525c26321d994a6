"""Correlation and least-squares fits (AGG7, AGG8, AGG9, MTH2, MTH3).

One aggregate each -- the original issued one job per moment.  Built-in
``corr`` and ``regr_*`` are numerically stable (co-moment updates, not raw
power sums), run as partial aggregates, and return NULL where the answer
is undefined (one point, zero variance) instead of dividing by zero.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson r and r^2 of two columns, as doubles."""
    xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
    return df.agg(F.count(F.when(xd.isNotNull() & yd.isNotNull(), 1)).alias("n"),
                  F.corr(xd, yd).alias("r")) \
        .withColumn("r2", F.pow(F.col("r"), 2))


def moments(df: DataFrame, x: str, y: str) -> DataFrame:
    """The six raw sums of the textbook formula, in one pass (AGG7)."""
    xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(xd).alias("sx"), F.sum(yd).alias("sy"),
                  F.sum(xd * xd).alias("sxx"), F.sum(yd * yd).alias("syy"),
                  F.sum(xd * yd).alias("sxy"))


def correlation_from_moments(m: DataFrame) -> DataFrame:
    """r from raw sums (AGG8 as written in the original; MTH2, MTH3)."""
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    num = n * F.col("sxy") - sx * sy
    den = F.sqrt(n * F.col("sxx") - F.pow(sx, 2)) * F.sqrt(n * F.col("syy") - F.pow(sy, 2))
    return m.select(n, F.try_divide(num, den).alias("r"))


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line ``y = slope * x + intercept`` (AGG9)."""
    xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
    return df.agg(F.regr_count(yd, xd).alias("n"),
                  F.regr_slope(yd, xd).alias("slope"),
                  F.regr_intercept(yd, xd).alias("intercept"))
