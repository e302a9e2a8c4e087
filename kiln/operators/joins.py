"""Join operators (C1–C6).  Quadratic ones (C7 co-rating, C8 kNN) live in
``recsys`` and ``knn`` with their own skew handling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join(fact: DataFrame, dim: DataFrame, on) -> DataFrame:
    """Many-to-one left join. AQE broadcasts the dimension when its
    runtime size is under ``spark.sql.autoBroadcastJoinThreshold`` and uses a
    sort-merge join (with skew splitting) when it is not."""
    return fact.join(dim, on, "left")


def inner_join(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """C2."""
    return a.join(b, on, "inner")


def star_join(fact: DataFrame, dims: list[tuple[DataFrame, str]]) -> DataFrame:
    """Fact ⟕ dim₁ ⟕ dim₂ …, each on its own key."""
    for dim, key in dims:
        fact = fact.join(dim, key, "left")
    return fact


def candidate_pairs(history: DataFrame, left: str, right: str) -> DataFrame:
    """C4 (re-aimed): scoring candidates are the distinct (client, product)
    pairs present in the history.  The reference scores the full client ×
    product product, which grows quadratically; this set grows with the data."""
    return history.select(left, right).filter(F.col(left).isNotNull() & F.col(right).isNotNull()).distinct()


def anti_join(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """Rows of ``a`` without a match in ``b``."""
    return a.join(b, on, "left_anti")


def semi_join(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """Rows of ``a`` with a match in ``b`` (``isin`` of a large list)."""
    return a.join(b, on, "left_semi")
