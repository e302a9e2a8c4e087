"""Evaluation operators (M1–M12) as grouped aggregates over (label, prediction)
tables.  Nothing is collected: every metric is a small DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.plans.ordering import global_cumsum


def confusion_matrix(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """M1: count per (true, predicted)."""
    return df.groupBy(F.col(y).alias("label"), F.col(yhat).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def per_class(df: DataFrame, y: str, yhat: str, by: list[str] | None = None) -> DataFrame:
    """Per class (of every ``by`` group): support, true positives, predicted count,
    precision, recall, F1 (zero division → 0)."""
    by = list(by or [])
    # every cell of the matrix counts once for its true and once for its predicted class: one pass
    zero, n = F.lit(0).cast("long"), F.col("n")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(zero)
    sides = F.array(F.struct(F.col("label").alias("cls"), n.alias("support"), hit.alias("tp"), zero.alias("predicted")),
                    F.struct(F.col("prediction").alias("cls"), zero.alias("support"), zero.alias("tp"), n.alias("predicted")))
    cells = df.groupBy(*by, F.col(y).alias("label"), F.col(yhat).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))
    j = (cells.select(*by, F.inline(sides)).groupBy(*by, "cls").agg(*[F.sum(c).alias(c) for c in ("support", "tp", "predicted")]))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    return j.select(*by, "cls", "support", "tp", "predicted", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


def classification_summary(df: DataFrame, y: str, yhat: str, by: list[str] | None = None) -> DataFrame:
    """M2: accuracy and macro / weighted precision, recall, F1 in one row (one per ``by`` group)."""
    pc = per_class(df, y, yhat, by)
    tot = F.sum("support")
    return pc.groupBy(*(by or [])).agg((F.sum("tp") / tot).alias("accuracy"),
                  F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
                  F.avg("f1").alias("macro_f1"),
                  (F.sum(F.col("precision") * F.col("support")) / tot).alias("weighted_precision"),
                  (F.sum(F.col("recall") * F.col("support")) / tot).alias("weighted_recall"),
                  (F.sum(F.col("f1") * F.col("support")) / tot).alias("weighted_f1"))


def classification_report(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """M3: per class rows plus ``macro avg`` and ``weighted avg`` rows
    (row, precision, recall, f1, support), in ONE aggregate over the per-class
    table: every class row is emitted once as itself, once into the macro
    average (weight 1) and once into the weighted average (weight support)."""
    pc = per_class(df, y, yhat)
    parts = [F.struct(name.alias("row"), F.col("precision").alias("p"), F.col("recall").alias("r"),
                      F.col("f1").alias("f"), F.col("support").alias("s"), w.alias("w"))
             for name, w in [(F.col("cls").cast("string"), F.lit(1.0)), (F.lit("macro avg"), F.lit(1.0)),
                             (F.lit("weighted avg"), F.col("support").cast("double"))]]
    ex = pc.select(F.explode(F.array(*parts)).alias("_e")).select("_e.*")
    den = F.nullif(F.sum("w"), F.lit(0.0))
    return ex.groupBy("row").agg((F.sum(F.col("p") * F.col("w")) / den).alias("precision"),
                                 (F.sum(F.col("r") * F.col("w")) / den).alias("recall"),
                                 (F.sum(F.col("f") * F.col("w")) / den).alias("f1"),
                                 F.sum("s").alias("support"))


def roc_auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """M4: ROC-AUC = P(score⁺ > score⁻) + ½ P(tie), from per-score counts and a
    distributed running count of negatives (equals the rank-sum statistic
    with average ranks)."""
    per = df.groupBy(F.col(score).alias("_s")).agg(F.count_if(F.col(y) == 1).alias("_pos"),
                                                   F.count_if(F.col(y) != 1).alias("_neg"))
    cum = global_cumsum(per, ["_s"], "_neg", out="_negle")
    part = cum.agg(F.sum(F.col("_pos") * (F.col("_negle") - F.col("_neg")) + 0.5 * F.col("_pos") * F.col("_neg"))
                   .alias("_num"), F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"))
    return part.select((F.col("_num") / (F.col("_p") * F.col("_n"))).alias("roc_auc"))


def mae(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """M5: mean absolute error."""
    return df.agg(F.avg(F.abs(F.col(y) - F.col(yhat))).alias("mae"), F.count(F.lit(1)).alias("n"))


def residuals(df: DataFrame, y: str, yhat: str, out: str = "error") -> DataFrame:
    """M5: residual table y − ŷ."""
    return df.withColumn(out, F.col(y) - F.col(yhat))


def brier(df: DataFrame, y: str, p: str) -> DataFrame:
    """M6: mean squared gap between probability and outcome."""
    return df.agg(F.avg(F.pow(F.col(p) - F.col(y), 2)).alias("brier"))


def reliability_curve(df: DataFrame, y: str, p: str, bins: int = 10) -> DataFrame:
    """M7: per probability bin (uniform, last bin closed): mean probability,
    observed frequency, count."""
    b = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(b.alias("bin")).agg(F.avg(p).alias("mean_predicted"), F.avg(y).alias("fraction_positive"),
                                          F.count(F.lit(1)).alias("n"))


def threshold_curve(df: DataFrame, y: str, p: str, steps: int = 20) -> DataFrame:
    """M9: precision, recall and F1 when predicting positive for p ≥ k/steps,
    k = 0..steps.  Scores are bucketed first (one aggregate), and the counts
    above each cut are a running sum over ≤ steps + 1 buckets — no cross join
    of rows with thresholds."""
    bucket = F.least(F.floor(F.col(p) * steps), F.lit(steps)).cast("int")
    per = df.groupBy(bucket.alias("k")).agg(F.count_if(F.col(y) == 1).alias("_tp"),
                                             F.count_if(F.col(y) != 1).alias("_fp"))
    grid = df.sparkSession.range(0, steps + 1).select(F.col("id").cast("int").alias("k"))
    per = grid.join(per, "k", "left").fillna(0)
    w = Window.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, 0)  # ≤ steps + 1 rows
    cum = per.select("k", F.sum("_tp").over(w).alias("tp"), F.sum("_fp").over(w).alias("fp"))
    pos = df.select(F.count_if(F.col(y) == 1)).scalar()
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    rec = F.when(pos > 0, F.col("tp") / pos).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    return cum.select((F.col("k") / steps).alias("threshold"), "tp", "fp", prec.alias("precision"),
                      rec.alias("recall"), f1.alias("f1"))


def precision_recall_at_k(pred: DataFrame, user: str, est: str, true: str, ks, thresholds,
                          item: str | None = None) -> DataFrame:
    """Per user, the top-k items by estimate; recommended = est ≥ t
    among them, relevant = true ≥ t; precision = |rel ∩ rec| / |rec|,
    recall = |rel ∩ rec| / |rel| (0 when a denominator is 0); then the mean
    over users, for every (k, t) of the grid.

    Only the top max(k) rows per user survive a ``WindowGroupLimit``.  Running
    counts by rank (one array slot per threshold) give the counts within the
    top k at the row of rank min(k, n_user), so each row is expanded only to the
    k values it closes: the work is users × grid, never pairs of rows."""
    ks, thresholds = sorted(set(ks)), [float(t) for t in thresholds]
    kmax = max(ks)
    order = [F.col(est).desc()] + ([F.col(item)] if item else [])
    top = (pred.withColumn("_rank", F.row_number().over(Window.partitionBy(user).orderBy(*order)))
           .filter(F.col("_rank") <= kmax))
    ts = F.array(*[F.lit(t) for t in thresholds])
    nt = len(thresholds)
    top = top.withColumn("_rec", F.transform(ts, lambda t: (F.col(est) >= t).cast("int"))) \
             .withColumn("_hit", F.transform(ts, lambda t: ((F.col(est) >= t) & (F.col(true) >= t)).cast("int")))
    wr = Window.partitionBy(user).orderBy("_rank").rowsBetween(Window.unboundedPreceding, 0)
    cum = top.select(user, "_rank", F.count(F.lit(1)).over(Window.partitionBy(user)).alias("_nu"),
                     *[F.sum(F.col("_rec")[i]).over(wr).alias(f"_r{i}") for i in range(nt)],
                     *[F.sum(F.col("_hit")[i]).over(wr).alias(f"_h{i}") for i in range(nt)])
    r, nu = F.col("_rank"), F.col("_nu")
    closes = F.filter(F.array(*[F.lit(k) for k in ks]), lambda k: (k == r) | ((r == nu) & (k >= r)))
    per = cum.select(user, F.explode(closes).alias("k"),
                     F.arrays_zip(ts.alias("t"), F.array(*[F.col(f"_r{i}") for i in range(nt)]).alias("rec"),
                                  F.array(*[F.col(f"_h{i}") for i in range(nt)]).alias("hit")).alias("_z"))
    rel = pred.groupBy(user).agg(F.array(*[F.count_if(F.col(true) >= t) for t in thresholds]).alias("_rel"))
    per = per.join(rel, user).select("k", F.posexplode("_z").alias("_ti", "_c"), "_rel")
    rec, hit, nrel = F.col("_c.rec"), F.col("_c.hit"), F.col("_rel")[F.col("_ti")]
    prec = F.when(rec > 0, hit / rec).otherwise(0.0)
    recall = F.when(nrel > 0, hit / nrel).otherwise(0.0)
    return (per.groupBy("k", F.col("_c.t").alias("threshold"))
            .agg(F.avg(prec).alias("precision_at_k"), F.avg(recall).alias("recall_at_k")))


def roc_auc_by(df: DataFrame, by: str, y: str, score: str) -> DataFrame:
    """M4 per group (e.g. per permutation repeat): the running count of
    negatives restarts at each group — a distributed running count over
    (group, score) minus the totals of the earlier groups (one row per group)."""
    per = df.groupBy(by, F.col(score).alias("_s")).agg(F.count_if(F.col(y) == 1).alias("_pos"),
                                                       F.count_if(F.col(y) != 1).alias("_neg"))
    cum = global_cumsum(per, [by, "_s"], "_neg", out="_cum")
    tot = per.groupBy(by).agg(F.sum("_neg").alias("_gneg"))
    w = Window.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)  # one row per group
    before = tot.select(by, F.coalesce(F.sum("_gneg").over(w), F.lit(0)).alias("_before"))
    cum = cum.join(before, by).withColumn("_negle", F.col("_cum") - F.col("_before"))
    part = cum.groupBy(by).agg(
        F.sum(F.col("_pos") * (F.col("_negle") - F.col("_neg")) + 0.5 * F.col("_pos") * F.col("_neg")).alias("_num"),
        F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"))
    return part.select(by, (F.col("_num") / F.nullif(F.col("_p") * F.col("_n"), F.lit(0))).alias("roc_auc"))
