"""Tokenising and formatting expressions (STR1-STR4, STR7, PRJ7, FLT7).

All are built-in column expressions: they run inside whole-stage codegen
and never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns.  Java regex classes: \s is ASCII whitespace
# [ \t\n\x0B\f\r]; \p{Punct} is ASCII punctuation !"#$%&'()*+,-./:;<=>?@[\]^_`{|}~
WHITESPACE = r"\s+"
UNICODE_WHITESPACE = r"(?U)\s+"
PUNCT_OR_SPACE = r"[\p{Punct}\s]+"
UNICODE_PUNCT_OR_SPACE = r"(?U)[\p{Punct}\s]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_words(text, unicode: bool = False) -> Column:
    """Array of whitespace-separated tokens (STR1).

    Leading separators would give an empty first token; empty tokens are
    removed so ``'  a b'`` gives ``[a, b]`` and an empty line gives ``[]``.
    """
    pattern = UNICODE_WHITESPACE if unicode else WHITESPACE
    return F.filter(F.split(_col(text), pattern), lambda w: w != F.lit(""))


def split_lower_words(text, unicode: bool = False) -> Column:
    """Lower-cased tokens split on punctuation or whitespace (STR2, STR3, FLT7)."""
    pattern = UNICODE_PUNCT_OR_SPACE if unicode else PUNCT_OR_SPACE
    return F.filter(F.split(F.lower(_col(text)), pattern), lambda w: w != F.lit(""))


def explode_words(df: DataFrame, text: str, out: str = "word",
                  tokens: Column | None = None, lower: bool = False,
                  punct: bool = False, unicode: bool = False) -> DataFrame:
    """Row -> one row per non-empty token (PRJ7, FLT7).

    By default splits on whitespace (STR1); ``punct`` also splits on
    punctuation and ``lower`` lower-cases first (STR2, STR3).  Empty tokens
    are dropped *after* the explode -- a plain filter inside the codegen
    stage, cheaper than a lambda over each array.  Only the token column is
    kept, so the scan below reads just ``text``.
    """
    if tokens is not None:
        return df.select(F.explode(tokens).alias(out))
    if punct:
        pattern = UNICODE_PUNCT_OR_SPACE if unicode else PUNCT_OR_SPACE
    else:
        pattern = UNICODE_WHITESPACE if unicode else WHITESPACE
    src = F.lower(_col(text)) if lower else _col(text)
    return df.select(F.explode(F.split(src, pattern)).alias(out)).filter(F.col(out) != F.lit(""))


def split_trim(text, sep: str) -> Column:
    """Split on a literal separator and trim each piece (STR4)."""
    import re
    return F.transform(F.split(_col(text), re.escape(sep)), lambda x: F.trim(x))


def format_line(fmt: str, *cols) -> Column:
    """printf-style line (STR7); ``%f`` gives six decimals, ``%d`` integers."""
    return F.format_string(fmt, *[_col(c) for c in cols])
