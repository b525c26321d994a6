"""Access-log line parsing (STR6, DAT3, FLT8, UID1).

Four ``regexp_extract`` calls pull the groups; a line that does not match
gives an empty host and is dropped.  Everything stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The accepted line shape and the time format of the log.
# host - - [dd/Mon/yyyy:HH:mm:ss zone] "METHOD path HTTP/x.y" status bytes
LOG_LINE = r'^(\S+) - - \[(\S+) [+-]\d+\] "[A-Z]+ (\S+) HTTP/\d\.\d" \d+ (\d+)$'
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"


def log_time(text: Column) -> Column:
    """``dd/Mon/yyyy:HH:mm:ss`` as a timestamp without zone; NULL when it is
    not one (an unknown month, the 31st of February)."""
    place = F.instr(F.lit(MONTHS), F.substring(text, 4, 3))
    # names stand at every third place; text across two names does not count
    month = F.when(place % 3 == 1, F.lpad(((place + 2) / 3).cast("int").cast("string"), 2, "0"))
    iso = F.concat(F.substring(text, 8, 4), F.lit("-"), month, F.lit("-"), F.substring(text, 1, 2),
                   F.lit(" "), F.substring(text, 13, 8))
    return F.when(text.rlike(r"^\d{2}/[A-Z][a-z]{2}/\d{4}:\d{2}:\d{2}:\d{2}$"), iso.try_cast("timestamp_ntz"))


def parse_log_lines(lines: DataFrame, line_col: str = "value",
                    keep_bad: bool = False) -> DataFrame:
    """Parse access-log lines into ``host, datetime, path, bytes``.

    Lines that do not match (a ``-`` size, HTTP/0.9, junk), and lines whose
    time does not exist, are dropped, or kept with ``ok = false`` when
    ``keep_bad`` is set so they can be counted.
    ``datetime`` is a ``timestamp_ntz``; the zone offset is ignored.
    """
    # The line's groups once each: the steps below only refer to them.  The host
    # group is ``\S+``: it is empty exactly when the line does not match, so no
    # separate ``rlike`` pass is needed to tell good from bad.  The time is made
    # inside a lambda, which reads its group once even where the optimizer
    # moves the test of ``ok`` below the projection.
    line = F.col(line_col)
    groups = lines.select(*[F.regexp_extract(line, LOG_LINE, i).alias(f"__g{i}") for i in (1, 2, 3, 4)])
    timed = groups.withColumn("__time", F.transform(F.array("__g2"), log_time)[0])
    ok = (F.coalesce(F.col("__g1"), F.lit("")) != F.lit("")) & F.col("__time").isNotNull()
    parsed = timed.withColumn("ok", ok).select(
        F.when(F.col("ok"), F.col("__g1")).alias("host"),
        F.when(F.col("ok"), F.col("__time")).alias("datetime"),
        F.when(F.col("ok"), F.col("__g3")).alias("path"),
        # conversions run only on matching lines (ANSI mode raises on '')
        F.when(F.col("ok"), F.col("__g4").try_cast("long")).alias("bytes"),
        "ok",
    )
    if keep_bad:
        return parsed
    return parsed.filter("ok").drop("ok")


def dropped_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """One row: lines read, and lines that :func:`parse_log_lines` rejects."""
    return parse_log_lines(lines, line_col, keep_bad=True).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.coalesce(F.sum(F.when(~F.col("ok"), 1)), F.lit(0)).alias("n_dropped"))


_COPIES = 100_000


def with_row_id(df: DataFrame, random: bool = False, name: str = "id") -> DataFrame:
    """Unique row id (UID1).  By default a SHA-256 of the row's fields and the
    row's number among its equals, so equal rows get different ids and a
    reload of the same data gives the same ids; ``random=True`` gives a fresh
    ``uuid()`` per row.

    Equal rows are counted (with partial aggregation) and written out again
    in blocks of at most ``_COPIES``, which a rebalance deals out, so that one
    very frequent row is no task's burden.
    """
    if random:
        return df.withColumn(name, F.expr("uuid()"))
    cols = df.columns
    counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    blocks = counts.withColumn("__b", F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / _COPIES)))) \
        .hint("rebalance")
    upto = F.least(F.col("__n"), (F.col("__b") + 1) * _COPIES)
    each = blocks.withColumn("__i", F.explode(F.sequence(F.col("__b") * _COPIES + 1, upto)))
    text = F.concat_ws("\u0001", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in cols],
                       F.col("__i").cast("string"))
    return each.select(*cols, F.sha2(text, 256).alias(name))
