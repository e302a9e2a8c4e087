"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token rule of the reference's vectoriser: runs of two or more word characters.
TOKEN_PATTERN = r"\w\w+"


def normalise(c) -> Column:
    """``strip().lower()``."""
    return F.lower(F.trim(c))


def tokens(c) -> Column:
    """H9: lower-case tokens of ≥ 2 word characters, null text as ''."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(f"({TOKEN_PATTERN})"), 1)
