"""Small helpers shared by the query modules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def round_doubles(df: DataFrame, digits: int = 6, cols: list[str] | None = None) -> DataFrame:
    """Round double columns for engine-independent comparison (sums of doubles
    differ in the last bits with the order of addition)."""
    names = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in names else F.col(c) for c in df.columns])


def sql_round(select_sql: str, cols: list[str], digits: int = 6) -> str:
    """Wrap an oracle query so the listed columns are rounded like ``round_doubles``."""
    rep = ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({select_sql}) _r"
