"""Window operators.

Per-key windows are only used where the partition size has a proven bound:
on a series ordered by calendar day (one row per key and day), or after a
``WindowGroupLimit`` top-k.  Row-level orderings over a key that may be hot go
through a distinct-day compression or the distributed ``global_row_number``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.plans.ordering import global_row_number


def gap_stats(df: DataFrame, key: str | list[str], date: str, prefix: str = "gap") -> DataFrame:
    """Per key, count of rows and mean / population std of the day gaps
    between consecutive rows in date order (same-day rows give gap 0).

    Rows are first compressed to (key, day, count) — partial aggregation, so a
    hot key costs one row per day — and the ``lag`` runs on that table, whose
    partitions are bounded by the calendar span.  With n rows the n − 1 gaps are
    the m − 1 gaps between distinct days plus Σ(count − 1) zeros."""
    keys = [key] if isinstance(key, str) else list(key)
    days = (df.filter(F.col(date).isNotNull()).groupBy(*keys, F.to_date(F.col(date)).alias("_day"))
            .agg(F.count(F.lit(1)).alias("_c")))
    w = Window.partitionBy(*keys).orderBy("_day")
    g = days.withColumn("_gap", F.datediff("_day", F.lag("_day").over(w)).cast("double"))
    s = g.groupBy(*keys).agg(F.sum("_c").alias("n"), F.sum("_gap").alias("_s1"),
                             F.sum(F.col("_gap") * F.col("_gap")).alias("_s2"))
    m = F.col("n") - 1
    mean = F.when(m > 0, F.coalesce(F.col("_s1"), F.lit(0.0)) / m)
    var = F.greatest(F.coalesce(F.col("_s2"), F.lit(0.0)) / m - mean * mean, F.lit(0.0))
    return s.select(*keys, "n", mean.alias(f"{prefix}_mean"), F.when(m > 0, F.sqrt(var)).alias(f"{prefix}_std"))


def lag_features(df: DataFrame, key: str, order: str, cols: list[str], lags) -> DataFrame:
    """``shift(L)`` of each column for each L, per series in date order."""
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumns({f"{c}_lag{L}": F.lag(c, L).over(w) for c in cols for L in lags})


def calendar(df: DataFrame, key: str, date: str) -> DataFrame:
    """Every day between each series' first and last day (bounded by the span)."""
    b = df.groupBy(key).agg(F.min(date).alias("_a"), F.max(date).alias("_b"))
    return b.select(key, F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 DAY"))).alias(date))


def fill_forward_backward(df: DataFrame, key: str, order: str, cols: list[str]) -> DataFrame:
    """``ffill().bfill()`` per series."""
    back = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    fwd = Window.partitionBy(key).orderBy(order).rowsBetween(0, Window.unboundedFollowing)
    out = df
    for c in cols:
        out = out.withColumn(c, F.last(c, ignorenulls=True).over(back))
        out = out.withColumn(c, F.coalesce(F.col(c), F.first(c, ignorenulls=True).over(fwd)))
    return out


def top_n(df: DataFrame, key: str | list[str], order: list, n: int, rank_col: str = "rank") -> DataFrame:
    """Best ``n`` rows per group.  ``row_number() <= n`` is planned with a
    partial ``WindowGroupLimit`` before the shuffle, so each task forwards at
    most n rows per group (a hot group cannot flood the final window)."""
    w = Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def elapsed_days(df: DataFrame, date: str, out: str = "t", key: str | None = None) -> DataFrame:
    """E5: days since the first date, of the table or of the row's ``key`` series
    (partial minimum per series, joined back)."""
    day = F.to_date(F.col(date))
    if key is None:
        return df.withColumn(out, F.datediff(day, df.select(F.min(day)).scalar()))
    first = df.groupBy(F.col(key).alias("_key")).agg(F.min(day).alias("_first"))
    return (df.join(first, F.col(key).eqNullSafe(F.col("_key")))
            .select(*df.columns, F.datediff(day, F.col("_first")).alias(out)))


def sorted_head(df: DataFrame, order: list, n: int) -> DataFrame:
    """Multi-key sort + limit (``TakeOrderedAndProject``: a bounded top-k per task)."""
    return df.orderBy(*order).limit(n)


def arg_best(df: DataFrame, key: str | list[str], value: str, by: list, smallest: bool = True,
             out: str | None = None) -> DataFrame:
    """The ``value`` of the row with the smallest (or largest) ``by`` per
    key — ``min_by``/``max_by`` with partial aggregation."""
    keys = [key] if isinstance(key, str) else list(key)
    f = F.min_by if smallest else F.max_by
    return df.groupBy(*keys).agg(f(F.col(value), F.struct(*by)).alias(out or f"best_{value}"))


def row_index(df: DataFrame, order: list, out: str = "row_id") -> DataFrame:
    """Running-order row id (``reset_index`` after a sort), 0-based,
    computed without a single-partition window."""
    return global_row_number(df, order, out=out)
