"""Length, Recency, Frequency, Monetary, Periodicity per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def round_half_even(c, digits: int):
    """numpy ``round``: scale, round half to even in binary, unscale."""
    s = float(10 ** digits)
    return F.rint(c * s) / s


UNIT_DIGITS = 6


def _micro_units(c):
    """Value in integer millionths (exact decimal sums, independent of order)."""
    return F.round(c * F.lit(float(10 ** UNIT_DIGITS))).cast("decimal(38,0)")


def exact_mean_half_even(units_sum: str, n: str, digits: int):
    """``units_sum / n`` (in millionths) rounded half to even at ``digits``,
    in integer arithmetic: the float mean of a distributed sum depends on the
    order of addition, which decides ties such as x.xx5."""
    d = f"nullif({n} * {10 ** (UNIT_DIGITS - digits)}, 0)"
    q = f"(abs({units_sum}) div {d})"
    r = f"(abs({units_sum}) - {q} * {d})"
    c = f"(CASE WHEN 2 * {r} > {d} THEN {q} + 1 WHEN 2 * {r} = {d} THEN {q} + {q} % 2 ELSE {q} END)"
    return F.expr(f"CAST(sign({units_sum}) * {c} AS DOUBLE) / {10 ** digits}")


def lrmfp(df: DataFrame, customer: str = "customer_id", date: str = "invoice_date",
          quantity: str = "quantity", price: str = "price") -> DataFrame:
    """I11. Dates are truncated to the day and rows with a null date dropped;
    "today" is the latest day of the whole table; rows with a null customer do
    not form a group.  L = last − first day, R = today − last day, F = rows,
    M = mean(quantity · price) rounded half-even to 2 on the exact
    (decimal) sum, P = population std of consecutive
    day gaps rounded to 1 (0 when undefined)."""
    d = df.filter(F.col(date).isNotNull()).select(customer, F.to_date(F.col(date)).alias("_day"),
                                                  (F.col(quantity).cast("double") * F.col(price).cast("double"))
                                                  .alias("_tp"))
    today = d.select(F.max("_day")).scalar()
    # One row per (customer, day): partial aggregation absorbs hot customers and
    # the gap window below is bounded by the calendar span.
    days = (d.filter(F.col(customer).isNotNull()).groupBy(customer, "_day")
            .agg(F.count(F.lit(1)).alias("_c"), F.sum(_micro_units(F.col("_tp"))).alias("_s"),
                 F.count("_tp").alias("_ct")))
    w = Window.partitionBy(customer).orderBy("_day")
    g = days.withColumn("_gap", F.datediff("_day", F.lag("_day").over(w)).cast("double"))
    a = g.groupBy(customer).agg(F.min("_day").alias("_first"), F.max("_day").alias("_last"),
                                F.sum("_c").alias("Frequency"), F.sum("_s").alias("_s"), F.sum("_ct").alias("_ct"),
                                F.sum("_gap").alias("_s1"), F.sum(F.col("_gap") * F.col("_gap")).alias("_s2"))
    m = F.col("Frequency") - 1
    mean = F.coalesce(F.col("_s1"), F.lit(0.0)) / m
    std = F.when(m > 0, F.sqrt(F.greatest(F.coalesce(F.col("_s2"), F.lit(0.0)) / m - mean * mean, F.lit(0.0))))
    return a.select(customer, F.datediff("_last", "_first").alias("Length"),
                    F.datediff(today, F.col("_last")).alias("Recency"), "Frequency",
                    exact_mean_half_even("_s", "_ct", 2).alias("Monetary"),
                    round_half_even(F.coalesce(std, F.lit(0.0)), 1).alias("Periodicity"))


def add_lrmfp(rows: DataFrame, features: DataFrame, customer: str = "customer_id") -> DataFrame:
    """Attach the customer features (computed on the fit data) to rows;
    customers unseen at fit time get nulls."""
    return rows.join(features, customer, "left")
