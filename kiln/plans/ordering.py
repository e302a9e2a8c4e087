"""Exact, skew-proof ordering primitives.

``global_row_number`` numbers rows in a total order without a window over the
whole table (which would put every row in one task): the table is range
partitioned on the order keys, sorted within partitions, and each partition's
offset is the running sum of the partition sizes (a table with one row per
partition, so its broadcast is bounded by the partition count).  The number of
partitions is left to the session and to AQE.

``exact_quantiles`` needs positions only, so it selects instead of sorting:
counts per (group, value), then per (group, cell of the value), and a ranking
inside the cells that hold a wanted position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.session import cut_lineage


def _numbered(df: DataFrame, order_cols: list, out: str, weight: str | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """``out`` = rows (or the sum of ``weight``) before each row in order, plus
    ``_pid``, the range partition.  The sorted rows are fixed by a reliable
    checkpoint, since offsets and rows must see the same ranges."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    ranged = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    s = cut_lineage(ranged.sortWithinPartitions(*cols).withColumn("_pid", F.spark_partition_id())
                    .withColumn("_mid", F.monotonically_increasing_id()))
    if weight is None:
        s = s.withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
        sizes = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_tot"))
    else:
        local = Window.partitionBy("_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
        s = s.withColumn("_local", F.sum(weight).over(local) - F.col(weight))
        sizes = s.groupBy("_pid").agg(F.sum(weight).alias("_tot"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_tot").over(w), F.lit(0)).alias("_off"))
    return (s.join(F.broadcast(offsets), "_pid").withColumn(out, F.col("_off") + F.col("_local"))
            .drop("_mid", "_off", "_local"))


def global_row_number(df: DataFrame, order_cols: list, out: str = "_rn",
                      num_partitions: int | None = None) -> DataFrame:
    """0-based position of every row in ``order_cols`` order (ties broken by
    the incoming order)."""
    return _numbered(df, order_cols, out, num_partitions=num_partitions).drop("_pid")


def global_cumsum(df: DataFrame, order_cols: list, weight: str, out: str = "_cum") -> DataFrame:
    """Running total of ``weight`` in ``order_cols`` order (inclusive)."""
    return _numbered(df, order_cols, out, weight).withColumn(out, F.col(out) + F.col(weight)).drop("_pid")


def rank_within_group(df: DataFrame, by: list[str], order_cols: list, out: str = "_pos",
                      size_col: str = "_n", weight: str | None = None) -> DataFrame:
    """0-based position inside each ``by`` group plus the group size, exact,
    with no per-group window: the sort is range-partitioned on (group, order),
    so a hot group is split across tasks.  With ``weight`` a row stands for so
    many equal ones.  Group starts and sizes are aggregated per (range
    partition, group) and joined back on that pair, so a hot group arrives
    under as many join keys as partitions it spans and no task receives it
    whole."""
    numbered = _numbered(df, [*by, *order_cols], "_g", weight)
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    if by:
        per_part = numbered.groupBy("_pid", *by).agg(F.min("_g").alias("_pg0"), size.alias("_pn"))
        per_group = per_part.groupBy(*by).agg(F.min("_pg0").alias("_g0"), F.sum("_pn").alias(size_col))
        # null-safe equality: a null group is a group (rows are never dropped)
        pg = per_group.select(*[F.col(c).alias(f"_k_{c}") for c in by], "_g0", size_col)
        bounds = per_part.join(pg, [per_part[c].eqNullSafe(pg[f"_k_{c}"]) for c in by]) \
            .select(F.col("_pid").alias("_bpid"), *[F.col(c).alias(f"_b_{c}") for c in by], "_g0", size_col)
        cond = [numbered["_pid"] == bounds["_bpid"]] + [numbered[c].eqNullSafe(bounds[f"_b_{c}"]) for c in by]
        numbered = numbered.join(bounds, cond).drop("_pid", "_bpid", *[f"_b_{c}" for c in by])
    else:
        bounds = numbered.agg(size.alias(size_col))
        numbered = (numbered.drop("_pid").withColumn("_g0", F.lit(0))
                    .withColumn(size_col, bounds.select(size_col).scalar()))
    return numbered.withColumn(out, F.col("_g") - F.col("_g0")).drop("_g", "_g0")


#: Value cells per shuffle partition, and the least and greatest number of cells: with more partitions, cells are narrower.
CELLS_PER_PARTITION, LEAST_CELLS, MOST_CELLS = 4, 256, 16_384


def _counted_cells(df: DataFrame, value: str, by: list[str], weight: str | None = None) -> DataFrame:
    """(by, _v, _c, _cell): equal (group, value) pairs counted, and the cell of
    the value.  Cells are ranges between approximate quantiles of the counted
    values; any sorted bounds give exact results, they only decide how evenly the
    values are spread."""
    base = df.select(*by, F.col(value).cast("double").alias("_v"), *([F.col(weight).alias("_w")] if weight else []))
    total = F.sum("_w") if weight else F.count(F.lit(1))
    counts = base.filter(F.col("_v").isNotNull()).groupBy(*by, "_v").agg(total.alias("_c"))
    cells = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * CELLS_PER_PARTITION
    levels = max(min(cells, MOST_CELLS), LEAST_CELLS).bit_length() - 1
    probs = F.split(F.lit(",".join(str(i / 2 ** levels) for i in range(1, 2 ** levels))), ",").cast("array<double>")
    # reads the counts as the main plan does, so that both use one shuffle
    finite = F.when(~F.isnan("_v") & (F.col("_c") > 0), F.col("_v"))
    bounds = counts.agg(F.array_sort(F.percentile_approx(finite, probs, 4 * 2 ** levels)).alias("b")).scalar()
    # binary search: the number of bounds below the value
    out = counts.withColumn("_b", bounds).withColumn("_cell", F.lit(0))
    for i in range(levels):
        half = 2 ** (levels - 1 - i)
        out = out.withColumn("_cell", F.col("_cell") + F.when(F.get("_b", F.col("_cell") + (half - 1)) < F.col("_v"), half).otherwise(0))
    return out.drop("_b")


def exact_quantiles(df: DataFrame, value: str, probs, by: list[str] | None = None,
                    names: list[str] | None = None, count_col: str | None = None, weight: str | None = None) -> DataFrame:
    """Linear-interpolation quantiles (pandas / ``percentile`` semantics) of
    ``value`` per ``by`` group, one column per probability; nulls ignored.
    ``count_col`` adds the number of non-null values of the group.  With
    ``weight`` a row stands for so many equal ones.

    Selection instead of a sort: equal values are counted, the counts are summed per
    (group, cell of the value), the running sums over a group's cells tell which cell
    holds each wanted position, and only the values of those cells are ranked.  A hot
    group lies in as many cells as there are, a hot value is one row; nothing is
    sorted whole, checkpointed or run before the result is asked for."""
    by = list(by or [])
    names = names or [f"q{int(round(p * 100))}" for p in probs]
    counts = _counted_cells(df, value, by, weight)
    group = Window.partitionBy(*by)
    running = F.sum("_s").over(group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0))
    cells = (counts.groupBy(*by, "_cell").agg(F.sum("_c").alias("_s"))
             .withColumn("_before", running - F.col("_s")).withColumn("_n", F.sum("_s").over(group)))

    wants = []
    for i, p in enumerate(probs):
        at = (F.col("_n") - 1) * F.lit(float(p))
        wants += [F.struct(F.lit(2 * i).alias("what"), F.floor(at).alias("at")), F.struct(F.lit(2 * i + 1).alias("what"), F.ceil(at).alias("at"))]
    inside = F.filter(F.array(*wants), lambda w: (w["at"] >= F.col("_before")) & (w["at"] < F.col("_before") + F.col("_s")))
    # one row per cell that holds a wanted position; groups meet null-safely: a null group is a group
    wanted = cells.withColumn("_wants", inside).filter(F.size("_wants") > 0).drop("_s")
    wanted = wanted.select(*[F.col(c).alias(f"_k_{c}") for c in by], F.col("_cell").alias("_kcell"), "_before", "_n", "_wants")
    meet = [counts[c].eqNullSafe(wanted[f"_k_{c}"]) for c in by] + [counts["_cell"] == wanted["_kcell"]]
    upto = F.sum("_c").over(Window.partitionBy(*by, "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.join(wanted, meet).withColumn("_from", F.col("_before") - F.col("_c") + upto)
    hits = (ranked.select(*by, "_n", "_v", "_c", "_from", F.explode("_wants").alias("_w"))
            .filter((F.col("_w.at") >= F.col("_from")) & (F.col("_w.at") < F.col("_from") + F.col("_c"))))
    found = [F.max(F.when(F.col("_w.what") == i, F.col("_v"))).alias(f"_{i}") for i in range(2 * len(names))]
    per = hits.groupBy(*by).agg(*found, F.max("_n").alias("_n"))

    def quantile(i):
        at = (F.col("_n") - 1) * F.lit(float(probs[i]))
        lo, hi, frac = F.col(f"_{2 * i}"), F.col(f"_{2 * i + 1}"), at - F.floor(at)
        return F.when(frac == 0, lo).otherwise(lo + (hi - lo) * frac).alias(names[i])

    extra = [F.col("_n").alias(count_col)] if count_col else []
    return per.select(*by, *[quantile(i) for i in range(len(names))], *extra)


def exact_quantiles_multi(df: DataFrame, cols: list[str], probs, names: list[str] | None = None) -> DataFrame:
    """Exact quantiles of several columns in one pass: the columns are stacked
    into (column_name, value) and selected per column.  One row per column."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                  F.col(c).cast("double").alias("_x")) for c in cols])).alias("_s"))
    long = long.select("_s.column_name", "_s._x")
    return exact_quantiles(long, "_x", probs, by=["column_name"], names=names)
