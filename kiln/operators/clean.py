"""Projection, filter and cleaning operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.text import normalise


def project(df: DataFrame, keep: list[str] | None = None, drop: list[str] | None = None) -> DataFrame:
    """B1: keep or drop a column list (pruned at the scan by Catalyst)."""
    if keep is not None:
        df = df.select(*keep)
    return df.drop(*(drop or []))


def drop_nulls(df: DataFrame, subset: list[str]) -> DataFrame:
    """``dropna(subset)``."""
    return df.dropna(subset=subset)


def dedup_rows(df: DataFrame) -> DataFrame:
    """Full-row ``drop_duplicates``."""
    return df.dropDuplicates()


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key in ``order`` (ties by the remaining columns).

    A ``min_by`` aggregate, not ``row_number`` over the key: partial
    aggregation keeps one candidate per key and partition, so a hot key never
    lands whole in one task."""
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order])
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), ordering).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """B6."""
    return df.withColumnsRenamed(mapping)


def map_categories(df: DataFrame, col: str, mapping: dict[str, str], out: str,
                   drop_unmapped: bool = True) -> DataFrame:
    """Category → group via a ``CASE`` (small fixed mapping), unmapped →
    null, rows with null removed when ``drop_unmapped``."""
    expr = reduce(lambda acc, kv: acc.when(F.col(col) == kv[0], F.lit(kv[1])),
                  list(mapping.items())[1:],
                  F.when(F.col(col) == list(mapping.items())[0][0], F.lit(list(mapping.items())[0][1])))
    df = df.withColumn(out, expr)
    return df.filter(F.col(out).isNotNull()) if drop_unmapped else df


def presence_flag(df: DataFrame, col: str, out: str) -> DataFrame:
    """1 if the value is present else 0."""
    return df.withColumn(out, F.col(col).isNotNull().cast("int"))


def with_constants(df: DataFrame, values: dict) -> DataFrame:
    """Attach constant columns."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def decode_label(df: DataFrame, col: str, labels: dict, out: str) -> DataFrame:
    """Code → text."""
    expr = None
    for k, v in labels.items():
        expr = (F.when(F.col(col) == k, F.lit(v)) if expr is None else expr.when(F.col(col) == k, F.lit(v)))
    return df.withColumn(out, expr)


def match_normalised(df: DataFrame, col: str, value: str) -> DataFrame:
    """Rows whose ``strip().lower()`` equals the query's."""
    return df.filter(normalise(F.col(col)) == normalise(F.lit(value)))


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """Reproducible sample of ``n`` rows: smallest md5 of the key
    (same digest in every engine). Planned as a top-k, so each task keeps ≤ n rows."""
    return df.orderBy(F.md5(F.col(key).cast("string")), F.col(key)).limit(n)


def continuous_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Whether each numeric column holds any non-integral value."""
    wide = df.agg(*[F.coalesce(F.max(F.col(c) != F.floor(F.col(c))), F.lit(False)).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "is_continuous")
