"""Tokenising."""

from __future__ import annotations

import re

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The default delimiter set of Pig's TOKENIZE (space, double
# quote, comma, left parenthesis, right parenthesis, star).  Runs of delimiters
# collapse and no empty token is produced; all other punctuation, tabs and
# newlines stay inside the token.
PIG_DELIMITERS = ' ",()*'


def tokenize(text: Column | str, delimiters: str = PIG_DELIMITERS, lower: bool = True) -> Column:
    """Array of tokens (null text -> null array, which explodes to no row)."""
    c = F.col(text) if isinstance(text, str) else text
    if lower:
        c = F.lower(c)
    return F.filter(F.split(c, _pattern(delimiters)), lambda t: t != F.lit(""))


def _pattern(delimiters: str) -> str:
    return "[" + "".join(re.escape(ch) for ch in delimiters) + "]+"


def explode_tokens(df: DataFrame, keep: Sequence[Column | str], text: Column | str,
                   delimiters: str = PIG_DELIMITERS, lower: bool = True, out: str = "word") -> DataFrame:
    """``keep`` + one ``out`` row per token.  Same tokens as ``explode(tokenize(...))``
    but the empty pieces (only possible at the ends of the text) are dropped by a
    plain filter after the explode, which stays in generated code instead of
    running the array lambda per document."""
    c = F.col(text) if isinstance(text, str) else text
    if lower:
        c = F.lower(c)
    return (df.select(*keep, F.explode(F.split(c, _pattern(delimiters))).alias(out))
              .where(F.col(out) != F.lit("")))
