"""Deterministic splits.

Random functions never agree across engines or re-runs, so every random-like
split orders or buckets rows by ``md5`` of a key.  Positional splits number
rows with the distributed ``global_row_number``; per-class positions with
``rank_within_group`` (a class may hold most of the rows, so no per-class
window)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.plans.ordering import global_row_number, rank_within_group


def hash_bucket(key, buckets: int = 100):
    """Stable bucket in [0, buckets) from the first 32 bits of md5(key)."""
    return (F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def ordered_holdout(df: DataFrame, order: list[str], test: float = 0.1, val: float = 0.2,
                    out: str = "split", by_first: bool = False) -> DataFrame:
    """Sort by ``order``; the last ⌈test·n⌉ rows are test, then the last
    ⌈val·(n − n_test)⌉ of the rest are validation (``shuffle=False`` splits).

    ``by_first``: for rows that are cheap to read again and whose first order column has
    few values (a calendar week).  The rows per value tell in which values the two cuts
    lie, only the rows of those are sorted, and every row is compared with the first ones
    behind the cuts."""
    if by_first:
        return _holdout_by_first(df, order, test, val, out)
    numbered = global_row_number(df, order, out="_pos")
    n = numbered.select(F.count(F.lit(1))).scalar()
    n_test = F.ceil(n * F.lit(test))
    n_tv = n - n_test
    n_val = F.ceil(n_tv * F.lit(val))
    label = (F.when(F.col("_pos") >= n_tv, "test").when(F.col("_pos") >= n_tv - n_val, "val").otherwise("train"))
    return numbered.withColumn(out, label).drop("_pos")


def _holdout_by_first(df: DataFrame, order: list[str], test: float, val: float, out: str) -> DataFrame:
    first, key = order[0], F.struct(*order)
    # one row per value of the first column, in order (nulls first, as in a sort)
    sizes = df.groupBy(first).agg(F.count(F.lit(1)).alias("n")).orderBy(first).collect()
    n = sum(r["n"] for r in sizes)
    n_tv = n - math.ceil(n * test)
    cuts = {"val": n_tv - math.ceil(n_tv * val), "test": n_tv}
    label, before, tied = F.lit("train"), 0, False
    for r in sizes:
        inside = {name: c - before for name, c in cuts.items() if before <= c < before + r["n"]}
        before += r["n"]
        if inside:
            at = global_row_number(df.filter(F.col(first).eqNullSafe(F.lit(r[first]))), order, out="_pos")
            wanted = [c - k for c in inside.values() for k in (0, 1)]
            found = {x["_pos"]: x for x in at.filter(F.col("_pos").isin(wanted)).select("_pos", *order).collect()}  # four at most
            for name, c in inside.items():
                # structs compare as rows sort, nulls first
                start = F.struct(*[F.lit(found[c][x]).cast(df.schema[x].dataType).alias(x) for x in order])
                label = F.when(key >= start, name).otherwise(label)
                tied |= c > 0 and found[c][1:] == found[c - 1][1:]
    if tied:  # a cut between rows that are equal in the order: they need their places
        return ordered_holdout(df, order, test, val, out)
    return df.withColumn(out, label)


def stratified_holdout(df: DataFrame, label: str, key: str, test: float, out: str = "split") -> DataFrame:
    """Per class, the ⌈test·n_class⌉ rows with the smallest md5(key) are test."""
    r = rank_within_group(df.withColumn("_h", F.md5(F.col(key).cast("string"))), [label], ["_h", key])
    return r.withColumn(out, F.when(F.col("_pos") < F.ceil(F.col("_n") * F.lit(test)), "test").otherwise("train")) \
        .drop("_h", "_pos", "_n")


def hash_split(df: DataFrame, key: str, weights: list[tuple[str, int]], out: str = "split") -> DataFrame:
    """Named splits by md5 bucket; ``weights`` are percentages summing to 100."""
    b = hash_bucket(F.col(key))
    expr, acc = None, 0
    for name, w in weights:
        acc += w
        expr = F.when(b < acc, name) if expr is None else expr.when(b < acc, name)
    return df.withColumn(out, expr)


def cutoff_split(df: DataFrame, date: str, last_train: str, out: str = "split") -> DataFrame:
    """Train up to and including ``last_train``, test after."""
    return df.withColumn(out, F.when(F.to_date(F.col(date)) <= F.lit(last_train).cast("date"), "train")
                         .otherwise("test"))


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, out: str = "fold") -> DataFrame:
    """fold = (position in class by md5(key)) mod k, so every fold keeps the
    class shares (``foldCol`` for ``CrossValidator``)."""
    r = rank_within_group(df.withColumn("_h", F.md5(F.col(key).cast("string"))), [label], ["_h", key])
    return r.withColumn(out, (F.col("_pos") % k).cast("int")).drop("_h", "_pos", "_n")
