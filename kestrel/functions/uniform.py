"""Random numbers that belong to rows (RND1 SRC8 ML1).

``rand(seed)`` depends on how rows are dealt out.  Here a number is a hash of a seed and the
row's key, so a row has the same number in every partitioning, run and engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of the hash that make a number: 52 bits, exact in a double.
DIGITS = 13


def uniform(seed: int, *keys: Column | str) -> Column:
    """A double in [0, 1) from the seed and the keys' texts.  Null keys are a value of their own; the
    keys' texts are separated, and marked as such, so that ``("a", "b")`` and ``("ab",)`` differ."""
    parts = [F.coalesce(F.concat(F.lit("="), (F.col(k) if isinstance(k, str) else k).cast("string")), F.lit("-"))
             for k in keys]
    digest = F.md5(F.concat_ws("\x1f", F.lit(str(int(seed))), *parts))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long") / F.lit(float(16 ** DIGITS))


def sample_rows(df: DataFrame, fraction: float, seed: int, *keys: str) -> DataFrame:
    """The rows whose number is below ``fraction``: rows of equal keys stay or go together."""
    return df.filter(uniform(seed, *keys) < F.lit(float(fraction)))
