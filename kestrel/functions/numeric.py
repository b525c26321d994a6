"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(c, places: int) -> Column:
    """Round half up to ``places`` decimals using only IEEE operations.

    ``round`` on a double rounds its shortest decimal text (0.95625 -> 0.9563)
    while other engines round the binary value (0.956249999... -> 0.9562);
    ``floor(x * 10^p + 0.5) / 10^p`` gives the same bits everywhere for the
    same input.  A value whose scaled form has no fraction bits left (2^52
    and above, where ``floor`` to a long would saturate) is returned as it is.
    """
    col = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** places)
    return F.when(F.abs(col) * scale < float(1 << 52), F.floor(col * scale + 0.5) / scale).otherwise(col)
