"""Set operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: list[DataFrame]) -> DataFrame:
    """G1: schema-aligned union (by name)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(frames: list[DataFrame]) -> DataFrame:
    """G2."""
    return union_all(frames).distinct()


def precedence_union(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """One row per key, taken from the first frame that has it (known
    ratings win over predicted).  ``min_by`` on the source rank, so no key is
    ever gathered whole into a window partition."""
    tagged = [f.withColumn("_src", F.lit(i)) for i, f in enumerate(frames)]
    u = union_all(tagged)
    rest = [c for c in u.columns if c not in keys and c != "_src"]
    best = u.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col("_src")).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def difference(a: DataFrame, b: DataFrame, keep_duplicates: bool = False) -> DataFrame:
    """``exceptAll`` (multiset) or ``subtract`` (set)."""
    return a.exceptAll(b) if keep_duplicates else a.subtract(b)
