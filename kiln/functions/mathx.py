"""Numeric helpers (H5–H8)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def fourier_terms(t, period: float, order: int, prefix: str = "f") -> list[Column]:
    """H5: sin/cos(2πkt/p) for k = 1..order."""
    cols = []
    for k in range(1, order + 1):
        arg = F.lit(2.0 * math.pi * k) * t.cast("double") / F.lit(float(period))
        cols += [F.sin(arg).alias(f"{prefix}_sin{k}"), F.cos(arg).alias(f"{prefix}_cos{k}")]
    return cols


def clip(c, lo, hi) -> Column:
    """H6: clip to [lo, hi]; null stays null (``greatest``/``least`` skip nulls)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(F.least(c, F.lit(hi) if not isinstance(hi, Column) else hi),
                                                            F.lit(lo) if not isinstance(lo, Column) else lo))


def safe_div(n, d, default=0.0) -> Column:
    """H7: n / d, ``default`` when d is 0 or null."""
    return F.when((d.isNotNull()) & (d != 0), n / d).otherwise(F.lit(default))
