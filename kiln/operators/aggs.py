"""Aggregates and data profiles.

All profiles are a single ``agg`` (one pass, partial aggregation map-side)
followed by ``unpivot`` into a long (column, value) table, so their size is
the column count, never the row count."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from kiln.functions.dates import iso_week
from kiln.plans.ordering import exact_quantiles, exact_quantiles_multi


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in exclude]


def weekly_rollup(tx: DataFrame, clients: DataFrame | None = None, products: DataFrame | None = None,
                  customer: str = "customer_id", product: str = "product_id", date: str = "purchase_date",
                  items: str = "items", out: str = "weekly_items", dedup: bool = True,
                  partitions: int | None = None) -> DataFrame:
    """Sum of items per (customer, ISO week, product), dimension columns attached.
    ``partitions``: how many tasks sum (none: left to the session).

    The fact is aggregated *before* the dimension joins (dimensions are unique
    per key), so the joins see one row per (customer, week, product) instead of
    one per transaction. Null keys are dropped as a pandas groupby does."""
    f = tx.select(customer, product, date, items, *([c for c in ("order_id",) if c in tx.columns]))
    if dedup:
        f = f.dropDuplicates()
    f = (f.filter(F.col(customer).isNotNull() & F.col(product).isNotNull() & F.col(date).isNotNull())
         .select(customer, iso_week(F.col(date)).alias("week"), product, items))
    if partitions:
        f = f.repartition(partitions, customer, "week", product)
    agg = f.groupBy(customer, "week", product).agg(F.coalesce(F.sum(items), F.lit(0.0)).alias(out))
    if clients is not None:
        agg = agg.join(clients, customer, "left")
    if products is not None:
        agg = agg.join(products, product, "left")
    return agg


def describe_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Count, mean, sample std, min, exact 25/50/75 %, max per column, one row per column."""
    cols = cols or numeric_columns(df)
    names = ["p25", "p50", "p75"]
    qs = exact_quantiles_multi(df, cols, [0.25, 0.5, 0.75], names=names)

    def stats(c):
        x = F.col(c).cast("double")
        return F.struct(F.lit(c).alias("column_name"), F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                        F.min(x).alias("min"), F.max(x).alias("max"))

    # one aggregate for all columns; an empty table keeps its row per column
    one = df.agg(F.array(*[stats(c) for c in cols]).alias("_s")).select(F.inline("_s"))
    return one.join(qs, "column_name", "left").select("column_name", "n", "mean", "std", "min", *names, "max")


def describe_categorical(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """D3: count, unique, top (most frequent, ties → smallest), freq per column."""
    cols = cols or string_columns(df)
    out = []
    for c in cols:
        counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        top = counts.agg(F.min_by(F.col(c), F.struct(-F.col("_n"), F.col(c))).alias("top"),
                         F.max("_n").alias("freq"), F.sum("_n").alias("n"), F.count(F.lit(1)).alias("n_unique"))
        out.append(top.select(F.lit(c).alias("column_name"), "n", "n_unique", "top", "freq"))
    return reduce(DataFrame.unionByName, out)


def _long(df: DataFrame, cols: list[str], exprs, value: str) -> DataFrame:
    wide = df.agg(*[e.alias(c) for c, e in zip(cols, exprs)])
    return wide.unpivot([], cols, "column_name", value)


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Nulls per column, one pass."""
    cols = cols or df.columns
    return _long(df, cols, [F.count_if(F.col(c).isNull()) for c in cols], "n_null")


def negative_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Negative values per numeric column, one pass."""
    cols = cols or numeric_columns(df)
    return _long(df, cols, [F.count_if(F.col(c) < 0) for c in cols], "n_negative")


def distinct_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact distinct count per column."""
    return _long(df, cols, [F.count_distinct(F.col(c)) for c in cols], "n_distinct")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Count and share per label value (``value_counts(normalize=True)``)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # one row per label value: a whole-table window over it is bounded by the
    # label cardinality and avoids a second pass over the input
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def mean_and_size(df: DataFrame, key: str | list[str], value: str) -> DataFrame:
    """Mean and size per key."""
    return df.groupBy(key).agg(F.avg(value).alias(f"mean_{value}"), F.count(F.lit(1)).alias("n"))


def group_size(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows per key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def quantiles_by(df: DataFrame, value: str, by: list[str] | None, probs=(0.2, 0.4, 0.6, 0.8)) -> DataFrame:
    """Exact linear quantiles, global or per group, for any group size or
    value cardinality."""
    names = [f"q{int(round(p * 100))}" for p in probs]
    return exact_quantiles(df, value, probs, by=by, names=names)


def group_mode(df: DataFrame, key: list[str] | None, col: str, out: str | None = None) -> DataFrame:
    """Most frequent value per group, ties → smallest; nulls ignored.

    Counts per (key, value) first (partial aggregation absorbs a hot group),
    then the winner per key with ``min_by`` — no group is ever collected."""
    key = list(key or [])
    out = out or f"mode_{col}"
    counts = df.filter(F.col(col).isNotNull()).groupBy(*key, col).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*key).agg(F.min_by(F.col(col), F.struct(-F.col("_n"), F.col(col))).alias(out))


def functional_dependency_violations(df: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """Keys with more than one distinct value of any attribute."""
    g = df.groupBy(key).agg(*[F.count_distinct(a).alias(f"n_{a}") for a in attrs])
    cond = reduce(lambda a, b: a | b, [F.col(f"n_{a}") > 1 for a in attrs])
    return g.filter(cond)


def period_bounds(df: DataFrame, date: str) -> DataFrame:
    """First and last date."""
    return df.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def mean_distinct_gap(df: DataFrame, date: str) -> DataFrame:
    """Mean gap (days) between consecutive distinct dates = (max − min)/(n − 1)."""
    d = F.to_date(F.col(date))
    return df.agg((F.datediff(F.max(d), F.min(d)) / F.nullif(F.count_distinct(d) - 1, F.lit(0))).alias("mean_gap_days"))


def outlier_columns(df: DataFrame, cols: list[str] | None = None, k: float = 1.5) -> DataFrame:
    """Values outside [Q1 − k·IQR, Q3 + k·IQR] per column (exact quartiles)."""
    cols = cols or numeric_columns(df)
    qs = exact_quantiles_multi(df, cols, [0.25, 0.75], names=["q1", "q3"])
    out = []
    for c in cols:
        q = qs.filter(F.col("column_name") == c)
        lo = q.select(F.col("q1") - k * (F.col("q3") - F.col("q1"))).scalar()
        hi = q.select(F.col("q3") + k * (F.col("q3") - F.col("q1"))).scalar()
        out.append(df.agg(F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias("n_outliers"))
                   .select(F.lit(c).alias("column_name"), "n_outliers"))
    return reduce(DataFrame.unionByName, out)


def duplicate_rows(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Surplus rows per duplicated key (``duplicated().sum()``)."""
    keys = keys or df.columns
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"))


def equal_width_histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed (numpy rule).

    ``width_bucket`` returns bins+1 at the maximum, so it is clamped."""
    x = F.col(col).cast("double")
    lo = df.select(F.min(x)).scalar()
    hi = df.select(F.max(x)).scalar()
    # Same arithmetic as width_bucket, with the maximum clamped into the last bin.
    b = F.least(F.floor((x - lo) * F.lit(float(bins)) / (hi - lo)) + 1, F.lit(bins))
    b = F.when(lo == hi, F.lit(1)).otherwise(b)
    h = df.filter(x.isNotNull()).groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / F.lit(float(bins))
    return h.select("bin", (lo + (F.col("bin") - 1) * width).alias("lower"),
                    (lo + F.col("bin") * width).alias("upper"), "n")


def pivot_mean(df: DataFrame, row: str, col: str, value: str, values: list) -> DataFrame:
    """Wide (row × listed values) table of means; the value list is explicit
    so the pivot needs no distinct pass and its width is bounded."""
    return df.groupBy(row).pivot(col, values).agg(F.avg(value))


def sparsity(df: DataFrame, row: str, col: str) -> DataFrame:
    """1 − filled / (rows · cols), from counts only."""
    return df.agg(F.count_distinct(row).alias("n_rows"), F.count_distinct(col).alias("n_cols"),
                  F.count_distinct(row, col).alias("n_filled")) \
        .withColumn("sparsity", 1 - F.col("n_filled") / F.nullif(F.col("n_rows") * F.col("n_cols"), F.lit(0)))


def correlation_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every column pair, one pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    return (wide.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "corr")
            .select(F.split("pair", r"\|")[0].alias("col_a"), F.split("pair", r"\|")[1].alias("col_b"), "corr"))


def with_scalar(df: DataFrame, name: str, agg_expr) -> DataFrame:
    """Attach a whole-table aggregate to every row as a scalar subquery
    (evaluated once, inlined as a constant; no join, no one-partition window)."""
    return df.withColumn(name, df.select(agg_expr).scalar())
