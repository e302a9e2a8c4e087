"""Drift between two periods of one column.

PSI over shared equal-width bins, the two-sample Kolmogorov–Smirnov statistic
(max gap of the two empirical CDFs, from a distributed running count over the
distinct values), and the chi-square statistic of category counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.plans.ordering import global_cumsum


def psi(a: DataFrame, b: DataFrame, col: str, bins: int = 10, eps: float = 1e-6) -> DataFrame:
    """Population stability index of ``col`` (reference ``a``, current ``b``)."""
    u = a.select(F.col(col).alias("v"), F.lit(0).alias("_p")).unionByName(b.select(F.col(col).alias("v"),
                                                                                    F.lit(1).alias("_p")))
    u = u.filter(F.col("v").isNotNull())
    lo = a.select(F.min(col)).scalar()
    hi = a.select(F.max(col)).scalar()
    k = F.least(F.greatest(F.floor((F.col("v") - lo) * bins / F.nullif(hi - lo, F.lit(0.0))), F.lit(0)),
                F.lit(bins - 1)).cast("int")
    k = F.coalesce(k, F.lit(0))  # constant reference column: one bin
    c = u.groupBy(k.alias("bin")).agg(F.count_if(F.col("_p") == 0).alias("na"), F.count_if(F.col("_p") == 1).alias("nb"))
    na = a.select(F.count(col)).scalar()
    nb = b.select(F.count(col)).scalar()
    pa = F.greatest(F.col("na") / F.nullif(na, F.lit(0)), F.lit(eps))
    pb = F.greatest(F.col("nb") / F.nullif(nb, F.lit(0)), F.lit(eps))
    return c.agg(F.sum((pb - pa) * F.log(pb / pa)).alias("psi"))


def ks_statistic(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """sup |F_a(x) − F_b(x)| over all values."""
    u = a.select(F.col(col).alias("v"), F.lit(1).alias("_wa"), F.lit(0).alias("_wb")).unionByName(
        b.select(F.col(col).alias("v"), F.lit(0).alias("_wa"), F.lit(1).alias("_wb"))).filter(F.col("v").isNotNull())
    per = u.groupBy("v").agg(F.sum("_wa").alias("ca"), F.sum("_wb").alias("cb"))
    na = a.select(F.count(col)).scalar()
    nb = b.select(F.count(col)).scalar()
    ca = global_cumsum(per, ["v"], "ca", out="_fa")
    both = global_cumsum(ca, ["v"], "cb", out="_fb")
    return both.agg(F.max(F.abs(F.col("_fa") / F.nullif(na, F.lit(0)) - F.col("_fb") / F.nullif(nb, F.lit(0))))
                    .alias("ks"))


def chi_square(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Chi-square statistic of the 2 × k table of category counts."""
    u = a.select(F.col(col).alias("c"), F.lit(0).alias("_p")).unionByName(
        b.select(F.col(col).alias("c"), F.lit(1).alias("_p"))).filter(F.col("c").isNotNull())
    t = u.groupBy("c").agg(F.count_if(F.col("_p") == 0).alias("oa"), F.count_if(F.col("_p") == 1).alias("ob"))
    na = u.select(F.count_if(F.col("_p") == 0)).scalar()
    nb = u.select(F.count_if(F.col("_p") == 1)).scalar()
    n = na + nb
    ea = (F.col("oa") + F.col("ob")) * na / n
    eb = (F.col("oa") + F.col("ob")) * nb / n
    return t.agg(F.sum(F.pow(F.col("oa") - ea, 2) / ea + F.pow(F.col("ob") - eb, 2) / eb).alias("chi2"),
                 (F.count(F.lit(1)) - 1).alias("dof"))
