"""Date helpers (H1–H4) as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_week(c) -> Column:
    """H1: ISO week number *without* the ISO year (2024-12-30 → 1)."""
    return F.weekofyear(c)


def iso_year_week(c) -> Column:
    """H1 variant qualified by the ISO year, as ``yyyy * 100 + week``."""
    d = F.to_date(c)
    # ISO year = calendar year of the Thursday of the same ISO week.
    thursday = F.date_add(d, F.lit(3) - ((F.dayofweek(d) + 5) % 7))
    return F.year(thursday) * 100 + F.weekofyear(d)


def date_parts_as_category(c) -> list[Column]:
    """H2: day, month and year as strings (treated as categories)."""
    return [F.dayofmonth(c).cast("string").alias("day"), F.month(c).cast("string").alias("month"),
            F.year(c).cast("string").alias("year")]


def day(c) -> Column:
    """H3: truncate a timestamp to its day."""
    return F.to_date(c)


def days_between(later, earlier) -> Column:
    """H3: whole days between two dates / timestamps."""
    return F.datediff(F.to_date(later), F.to_date(earlier))


def next_week_number(c, reference_date: str = "2024-12-31") -> Column:
    """H4: ``52 + floor((date − reference)/7) + 1``; never wraps (53, 54, …)."""
    return (F.lit(53) + F.floor(F.datediff(F.to_date(c), F.lit(reference_date).cast("date")) / 7)).cast("int")


def parse_dmy2(c) -> Column:
    """A2: parse ``dd/MM/yy`` with the POSIX two-digit-year pivot used by
    ``strptime('%y')``: 69–99 → 1969–1999, 00–68 → 2000–2068."""
    d = F.to_date(c, "dd/MM/yy")
    return F.when(F.year(d) >= 2069, F.add_months(d, -1200)).otherwise(d)
