"""Queries: evaluation metrics (M1–M7, M9, M11, M12) on deterministic
prediction tables that both engines can rebuild:

* multiclass: the per-client priority label vs the global-quantile baseline;
* binary: document quality vs a length score p = min(1, ln(1 + n_chars)/12);
* regression: daily totals vs the seasonal-naive forecast (value 7 days before);
* ranking: held-out ratings vs the item mean of the training ratings."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import labels, metrics
from kiln.operators.aggs import weekly_rollup
from kiln.operators.splits import hash_split
from kiln.plans.common import round_doubles, sql_round
from kiln.plans.registry import register
from kiln.plans.sqlparts import LABELLED_CTES, SQL_DAILY, SQL_RATINGS, with_ctes
from kiln.sources import proxies
from kiln.sources.tables import read_star, read_table

SQL_MC = """mc AS (SELECT priority AS y, CASE
      WHEN weekly_items <= (SELECT q[1] FROM g) THEN 'Very Low' WHEN weekly_items <= (SELECT q[2] FROM g) THEN 'Low'
      WHEN weekly_items <= (SELECT q[3] FROM g) THEN 'Medium' WHEN weekly_items <= (SELECT q[4] FROM g) THEN 'High'
      ELSE 'Very High' END AS yhat FROM lab)"""


def multiclass_pred(spark, d):
    rollup = weekly_rollup(read_star(spark, d)[0])  # the labels need no dimension
    lab = labels.assign_global_priority(labels.assign_priority(rollup), source=rollup)
    return lab.select(F.col("priority").alias("y"), F.col("priority_global").alias("yhat"))


SQL_BIN = """bin AS (SELECT d.doc_id, l.quality AS y, least(1.0, ln(1 + d.n_chars) / 12.0) AS p
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def binary_pred(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "n_chars")
    lb = read_table(spark, d, "labels").select("doc_id", "quality")
    return docs.join(lb, "doc_id").select("doc_id", F.col("quality").alias("y"),
                                          F.least(F.lit(1.0), F.log(1 + F.col("n_chars")) / 12.0).alias("p"))


_PC_SQL = """pcl AS (SELECT cls, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp, coalesce(predicted, 0) AS predicted,
    CASE WHEN coalesce(predicted, 0) > 0 THEN tp / predicted ELSE 0.0 END AS precision,
    CASE WHEN coalesce(support, 0) > 0 THEN tp / support ELSE 0.0 END AS recall
  FROM (SELECT y AS cls, count(*) AS support, count_if(y = yhat) AS tp FROM mc GROUP BY y) t
  FULL JOIN (SELECT yhat AS cls, count(*) AS predicted FROM mc GROUP BY yhat) p USING (cls)),
pcs AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
  FROM pcl)"""


@register("m1_confusion_matrix", with_ctes(*LABELLED_CTES, SQL_MC) + """
SELECT y AS label, yhat AS prediction, count(*) AS n FROM mc GROUP BY y, yhat""")
def m1_confusion_matrix(spark, d):
    return metrics.confusion_matrix(multiclass_pred(spark, d), "y", "yhat")


_M2 = ["accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_precision", "weighted_recall", "weighted_f1"]


@register("m2_classification_summary", sql_round(with_ctes(*LABELLED_CTES, SQL_MC, _PC_SQL) + """
SELECT sum(tp) / sum(support) AS accuracy, avg(precision) AS macro_precision, avg(recall) AS macro_recall,
  avg(f1) AS macro_f1, sum(precision * support) / sum(support) AS weighted_precision,
  sum(recall * support) / sum(support) AS weighted_recall, sum(f1 * support) / sum(support) AS weighted_f1 FROM pcs""",
    _M2))
def m2_classification_summary(spark, d):
    return round_doubles(metrics.classification_summary(multiclass_pred(spark, d), "y", "yhat"))


@register("m3_classification_report", sql_round(with_ctes(*LABELLED_CTES, SQL_MC, _PC_SQL) + """
SELECT cls AS row, precision, recall, f1, CAST(support AS BIGINT) AS support FROM pcs
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM pcs
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM pcs""", ["precision", "recall", "f1"]))
def m3_classification_report(spark, d):
    return round_doubles(metrics.classification_report(multiclass_pred(spark, d), "y", "yhat"))


@register("m4_roc_auc", sql_round(with_ctes(SQL_BIN) + """
SELECT sum(pos * (negle - neg) + 0.5 * pos * neg) / (sum(pos) * sum(neg)) AS roc_auc FROM (
  SELECT p, pos, neg, sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS negle FROM (
    SELECT p, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM bin GROUP BY p))""", ["roc_auc"]))
def m4_roc_auc(spark, d):
    return round_doubles(metrics.roc_auc(binary_pred(spark, d), "y", "p"))


SQL_NAIVE = """nv AS (SELECT ds, y, lag(y, 7) OVER (PARTITION BY series_id ORDER BY ds) AS yhat FROM daily)"""


def naive_forecast(spark, d):
    from kiln.operators.windows import lag_features
    s = proxies.daily_series(spark, d).select("series_id", "ds", "y")
    return lag_features(s, "series_id", "ds", ["y"], [7]).withColumnRenamed("y_lag7", "yhat")


@register("m5_mae", sql_round(with_ctes(SQL_DAILY, SQL_NAIVE) + """
SELECT avg(abs(y - yhat)) AS mae, count(*) AS n FROM nv WHERE yhat IS NOT NULL""", ["mae"]))
def m5_mae(spark, d):
    return round_doubles(metrics.mae(naive_forecast(spark, d).filter(F.col("yhat").isNotNull()), "y", "yhat"))


@register("m5_residuals", sql_round(with_ctes(SQL_DAILY, SQL_NAIVE) + "SELECT ds, y - yhat AS error FROM nv",
                                    ["error"]))
def m5_residuals(spark, d):
    return round_doubles(metrics.residuals(naive_forecast(spark, d), "y", "yhat").select("ds", "error"))


@register("m6_brier", sql_round(with_ctes(SQL_BIN) + "SELECT avg(pow(p - y, 2)) AS brier FROM bin", ["brier"]))
def m6_brier(spark, d):
    return round_doubles(metrics.brier(binary_pred(spark, d), "y", "p"))


@register("m7_reliability_curve", sql_round(with_ctes(SQL_BIN) + """
SELECT CAST(least(floor(p * 10), 9) AS INTEGER) AS bin, avg(p) AS mean_predicted, avg(y) AS fraction_positive,
       count(*) AS n FROM bin GROUP BY 1""", ["mean_predicted", "fraction_positive"]))
def m7_reliability_curve(spark, d):
    return round_doubles(metrics.reliability_curve(binary_pred(spark, d), "y", "p"))


@register("m9_threshold_curve", sql_round(with_ctes(SQL_BIN) + """
, per AS (SELECT k, coalesce(tp, 0) AS tp, coalesce(fp, 0) AS fp FROM (SELECT CAST(range AS INTEGER) AS k FROM range(0, 21)) g
  LEFT JOIN (SELECT CAST(least(floor(p * 20), 20) AS INTEGER) AS kk, count_if(y = 1) AS tp, count_if(y <> 1) AS fp
             FROM bin GROUP BY 1) b ON g.k = b.kk),
cum AS (SELECT k, sum(tp) OVER (ORDER BY k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
               sum(fp) OVER (ORDER BY k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM per),
pr AS (SELECT k / 20 AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN (SELECT count_if(y = 1) FROM bin) > 0 THEN tp / (SELECT count_if(y = 1) FROM bin) ELSE 0.0 END AS recall
  FROM cum)
SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
FROM pr""", ["threshold", "precision", "recall", "f1"]))
def m9_threshold_curve(spark, d):
    return round_doubles(metrics.threshold_curve(binary_pred(spark, d), "y", "p", 20))


_HB = "CAST(CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR) || '|' || item_id), 1, 8)) AS BIGINT) % 100 AS INTEGER)"
SQL_RANKPRED = f"""sp AS (SELECT *, {_HB} AS b FROM ratings),
im AS (SELECT item_id, avg(rating) AS est FROM sp WHERE b >= 30 GROUP BY item_id),
rp AS (SELECT t.user_id, t.item_id, t.rating AS true_r, im.est FROM sp t JOIN im ON t.item_id = im.item_id
       WHERE t.b < 30)"""


def rating_predictions(spark, d):
    r = proxies.ratings(spark, d)
    r = r.withColumn("_k", F.concat_ws("|", F.col("user_id").cast("string"), "item_id"))
    s = hash_split(r, "_k", [("test", 30), ("train", 70)])
    im = s.filter(F.col("split") == "train").groupBy("item_id").agg(F.avg("rating").alias("est"))
    return (s.filter(F.col("split") == "test").join(im, "item_id")
            .select("user_id", "item_id", F.col("rating").alias("true_r"), "est"))


def _prk_sql(ks, ts):
    kl = ", ".join(str(k) for k in ks)
    tl = ", ".join(f"CAST({t!r} AS DOUBLE)" for t in ts)
    return sql_round(with_ctes(SQL_RATINGS, SQL_RANKPRED) + f"""
, top AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY est DESC, item_id) AS rk FROM rp),
grid AS (SELECT k, t FROM unnest([{kl}]) AS a(k), unnest([{tl}]) AS b(t)),
per AS (SELECT top.user_id, grid.k, grid.t, count_if(rk <= k AND est >= t) AS rec,
               count_if(rk <= k AND est >= t AND true_r >= t) AS hit, count_if(true_r >= t) AS rel
        FROM top, grid GROUP BY top.user_id, grid.k, grid.t)
SELECT CAST(k AS INTEGER) AS k, t AS threshold, avg(CASE WHEN rec > 0 THEN hit / rec ELSE 0.0 END) AS precision_at_k,
       avg(CASE WHEN rel > 0 THEN hit / rel ELSE 0.0 END) AS recall_at_k FROM per GROUP BY k, t""",
                     ["precision_at_k", "recall_at_k"])


@register("m11_precision_recall_at_k", _prk_sql([10], [3.5]))
def m11_precision_recall_at_k(spark, d):
    p = rating_predictions(spark, d)
    return round_doubles(metrics.precision_recall_at_k(p, "user_id", "est", "true_r", [10], [3.5], item="item_id"))


_KS = list(range(3, 26))
_TS = [round(3.0 + 0.1 * i, 1) for i in range(16)]


@register("m12_pr_at_k_sweep", _prk_sql(_KS, _TS))
def m12_pr_at_k_sweep(spark, d):
    p = rating_predictions(spark, d)
    return round_doubles(metrics.precision_recall_at_k(p, "user_id", "est", "true_r", _KS, _TS, item="item_id"))
