"""Priority label from per-client quantiles of weekly items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.plans.ordering import exact_quantiles

PROBS = (0.2, 0.4, 0.6, 0.8)
# Label names, from lowest to highest quintile.
LABELS = ("Very Low", "Low", "Medium", "High", "Very High")


def counted(weekly: DataFrame, client: str, items: str, partitions: int | None = None) -> DataFrame:
    """Equal (client, value) pairs with their number of rows: what the quantiles
    of the clients and of the whole table are both read from.  ``partitions``: how
    many tasks count (none: left to the session, which coalesces by compressed
    bytes and so does not see how large a task's counts become)."""
    if partitions:
        weekly = weekly.select(client, items).repartition(partitions, client, items)
    return weekly.groupBy(client, items).agg(F.count(F.lit(1)).alias("_rows"))


def client_quantiles(weekly: DataFrame, client: str = "customer_id", items: str = "weekly_items",
                     min_rows: int = 5, weight: str | None = None) -> DataFrame:
    """Per-client q20/q40/q60/q80 for clients with ≥ ``min_rows`` rows: exact
    positions among counted (client, value) pairs, so no task holds a client's
    values whatever their number or cardinality."""
    names = [f"q{int(p * 100)}" for p in PROBS]
    q = exact_quantiles(weekly, items, PROBS, by=[client], names=names, count_col="_n", weight=weight)
    return q.filter(F.col(client).isNotNull() & (F.col("_n") >= min_rows)).select(client, *names)


def global_quantiles(weekly: DataFrame, items: str, weight: str | None = None):
    """Whole-table q20…q80 as an array column (scalar subquery)."""
    names = [f"q{int(p * 100)}" for p in PROBS]
    return exact_quantiles(weekly, items, PROBS, names=names, weight=weight).select(F.array(*names)).scalar()


def assign_priority(weekly: DataFrame, client: str = "customer_id", items: str = "weekly_items",
                    out: str = "priority", min_rows: int = 5, partitions: int | None = None) -> DataFrame:
    """Label every row: ≤ q20 Very Low, ≤ q40 Low, ≤ q60 Medium, ≤ q80 High, else
    Very High, using the client's own quantiles when it has ≥ ``min_rows`` rows
    and the global ones otherwise (a null value falls through to Very High,
    like ``np.select``)."""
    counts = counted(weekly, client, items, partitions)
    glob = global_quantiles(counts, items, "_rows")
    per = client_quantiles(counts, client, items, min_rows, "_rows")
    j = weekly.join(per, client, "left")
    qs = [F.coalesce(F.col(f"q{int(p * 100)}"), glob[i]) for i, p in enumerate(PROBS)]
    x = F.col(items)
    label = (F.when(x <= qs[0], LABELS[0]).when(x <= qs[1], LABELS[1]).when(x <= qs[2], LABELS[2])
             .when(x <= qs[3], LABELS[3]).otherwise(LABELS[4]))
    return j.withColumn(out, label).drop(*[f"q{int(p * 100)}" for p in PROBS])


def assign_global_priority(weekly: DataFrame, items: str = "weekly_items", out: str = "priority_global",
                           client: str = "customer_id", source: DataFrame | None = None) -> DataFrame:
    """Baseline label from the global quantiles only (every client treated as
    having too few rows).  ``source``: the rows that the quantiles are taken of,
    where ``weekly`` was derived from them (its rows, with more columns)."""
    glob = global_quantiles(counted(source if source is not None else weekly, client, items), items, "_rows")
    x = F.col(items)
    label = (F.when(x <= glob[0], LABELS[0]).when(x <= glob[1], LABELS[1]).when(x <= glob[2], LABELS[2])
             .when(x <= glob[3], LABELS[3]).otherwise(LABELS[4]))
    return weekly.withColumn(out, label)
