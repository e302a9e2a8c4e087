"""Queries: window operators (E) and LRMFP."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import lrmfp as lr
from kiln.operators import windows as wn
from kiln.plans.common import round_doubles, sql_round
from kiln.plans.registry import register
from kiln.plans.sqlparts import SQL_DAILY, SQL_PANEL, SQL_RATINGS, SQL_RETAIL, SQL_TX, with_ctes
from kiln.sources import proxies
from kiln.sources.tables import read_table


@register("e1_purchase_gaps", sql_round(with_ctes(SQL_TX) + """
SELECT product_id, count(*) AS n, avg(gap) AS gap_mean, stddev_pop(gap) AS gap_std FROM (
  SELECT product_id, datediff('day', lag(CAST(purchase_date AS DATE)) OVER (PARTITION BY product_id
         ORDER BY CAST(purchase_date AS DATE)), CAST(purchase_date AS DATE)) AS gap
  FROM tx WHERE purchase_date IS NOT NULL) GROUP BY product_id""", ["gap_mean", "gap_std"]))
def e1_purchase_gaps(spark, d):
    return round_doubles(wn.gap_stats(proxies.transactions(spark, d), "product_id", "purchase_date"))


_LAGS = range(1, 8)


@register("e2_lag_features", sql_round(with_ctes(SQL_DAILY) + "SELECT series_id, ds, y, " + ", ".join(
    f"lag(y, {L}) OVER (PARTITION BY series_id ORDER BY ds) AS y_lag{L}" for L in _LAGS) + " FROM daily",
    ["y"] + [f"y_lag{L}" for L in _LAGS]))
def e2_lag_features(spark, d):
    s = proxies.daily_series(spark, d).select("series_id", "ds", "y")
    return round_doubles(wn.lag_features(s, "series_id", "ds", ["y"], _LAGS))


@register("e3_fill_forward_backward", sql_round(with_ctes(SQL_DAILY) + """
, cal AS (SELECT 'all' AS series_id, CAST(g AS DATE) AS ds
          FROM (SELECT min(ds) AS a, max(ds) AS b FROM daily), generate_series(a, b, INTERVAL 1 DAY) AS t(g))
SELECT series_id, ds, coalesce(ff, first_value(ff IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ds
         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS y FROM (
  SELECT cal.series_id, cal.ds, last_value(daily.y IGNORE NULLS) OVER (PARTITION BY cal.series_id ORDER BY cal.ds
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ff
  FROM cal LEFT JOIN daily ON cal.ds = daily.ds AND cal.series_id = daily.series_id)""", ["y"]))
def e3_fill_forward_backward(spark, d):
    s = proxies.daily_series(spark, d).select("series_id", "ds", "y")
    full = wn.calendar(s, "series_id", "ds").join(s, ["series_id", "ds"], "left")
    return round_doubles(wn.fill_forward_backward(full, "series_id", "ds", ["y"]))


@register("e4_top_n_per_group", sql_round(with_ctes(SQL_RATINGS) + """
SELECT * FROM (SELECT user_id, item_id, rating,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS INTEGER) AS rank FROM ratings)
WHERE rank <= 3""", ["rating"]))
def e4_top_n_per_group(spark, d):
    r = proxies.ratings(spark, d)
    return round_doubles(wn.top_n(r, "user_id", [F.col("rating").desc(), F.col("item_id")], 3))


@register("e5_elapsed_days", with_ctes(SQL_DAILY) + """
SELECT ds, CAST(datediff('day', (SELECT min(ds) FROM daily), ds) AS INTEGER) AS t FROM daily""")
def e5_elapsed_days(spark, d):
    return wn.elapsed_days(proxies.daily_series(spark, d).select("ds"), "ds")


@register("e5_elapsed_days_panel", with_ctes(SQL_PANEL) + """
SELECT series_id, ds, CAST(datediff('day', min(ds) OVER (PARTITION BY series_id), ds) AS INTEGER) AS t FROM panel""")
def e5_elapsed_days_panel(spark, d):
    return wn.elapsed_days(proxies.daily_panel(spark, d).select("series_id", "ds"), "ds", key="series_id")


@register("e7_sorted_head", sql_round(with_ctes(SQL_TX) + """
SELECT product_id, avg(items) AS mean_items, count(*) AS n FROM tx GROUP BY product_id HAVING count(*) >= 35
ORDER BY mean_items DESC, n DESC, product_id LIMIT 10""", ["mean_items"]))
def e7_sorted_head(spark, d):
    g = (proxies.transactions(spark, d).groupBy("product_id")
         .agg(F.avg("items").alias("mean_items"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= 35))
    return round_doubles(wn.sorted_head(g, [F.col("mean_items").desc(), F.col("n").desc(), "product_id"], 10))


@register("e8_arg_best", with_ctes(SQL_RATINGS) + """
SELECT user_id, item_id AS best_item_id FROM (SELECT user_id, item_id,
  row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rn FROM ratings) WHERE rn = 1""")
def e8_arg_best(spark, d):
    r = proxies.ratings(spark, d)
    return wn.arg_best(r, "user_id", "item_id", [-F.col("rating"), F.col("item_id")], out="best_item_id")


@register("e9_row_index", """
SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_id FROM orders""")
def e9_row_index(spark, d):
    o = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return wn.row_index(o, ["o_orderdate", "o_orderkey"])


SQL_LRMFP = """d AS (SELECT customer_id, CAST(invoice_date AS DATE) AS day, quantity * price AS tp
       FROM retail WHERE invoice_date IS NOT NULL),
feat AS (SELECT customer_id, CAST(datediff('day', min(day), max(day)) AS INTEGER) AS Length,
       CAST(datediff('day', max(day), (SELECT max(day) FROM d)) AS INTEGER) AS Recency, count(*) AS Frequency,
       CAST(sign(u) * CASE WHEN 2 * r > dd THEN q + 1 WHEN 2 * r = dd THEN q + q % 2 ELSE q END AS DOUBLE) / 100
         AS Monetary, round_even(coalesce(stddev_pop(gap), 0.0), 1) AS Periodicity
  FROM (SELECT customer_id, day, tp, datediff('day', lag(day) OVER (PARTITION BY customer_id ORDER BY day), day) AS gap,
           sum(CAST(round(tp * 1000000.0) AS HUGEINT)) OVER (PARTITION BY customer_id) AS u,
           count(tp) OVER (PARTITION BY customer_id) * 10000 AS dd,
           abs(sum(CAST(round(tp * 1000000.0) AS HUGEINT)) OVER (PARTITION BY customer_id))
             // (count(tp) OVER (PARTITION BY customer_id) * 10000) AS q,
           abs(sum(CAST(round(tp * 1000000.0) AS HUGEINT)) OVER (PARTITION BY customer_id))
             - (abs(sum(CAST(round(tp * 1000000.0) AS HUGEINT)) OVER (PARTITION BY customer_id))
                // (count(tp) OVER (PARTITION BY customer_id) * 10000)) * (count(tp) OVER (PARTITION BY customer_id) * 10000)
             AS r
        FROM d WHERE customer_id IS NOT NULL) GROUP BY customer_id, u, dd, q, r)"""


@register("i11_lrmfp", with_ctes(SQL_RETAIL, SQL_LRMFP) + "SELECT * FROM feat")
def i11_lrmfp(spark, d):
    return lr.lrmfp(proxies.retail(spark, d))


@register("i12_add_lrmfp", with_ctes(SQL_RETAIL, SQL_LRMFP) + """
SELECT r.customer_id, r.invoice, r.quantity, f.Length, f.Recency, f.Frequency, f.Monetary, f.Periodicity
FROM retail r LEFT JOIN feat f ON r.customer_id = f.customer_id""")
def i12_add_lrmfp(spark, d):
    r = proxies.retail(spark, d)
    return lr.add_lrmfp(r.select("customer_id", "invoice", "quantity"), lr.lrmfp(r))
