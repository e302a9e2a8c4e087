"""Queries: sources and sinks (A), aggregates (D) and the flagship label."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from kiln.operators import aggs
from kiln.plans.common import round_doubles, sql_round
from kiln.plans.registry import register
from kiln.plans.sqlparts import LABELLED_CTES, SQL_RATINGS, SQL_TX, WEEKLY_CTES, with_ctes
from kiln.plans.weekly import weekly_data, weekly_priority
from kiln.session import scratch_path
from kiln.sources import files, proxies
from kiln.sources.tables import read_table

# ---------------------------------------------------------------- sources ----


@register("a1_parquet_scan", "SELECT * FROM part")
def a1_parquet_scan(spark, d):
    return read_table(spark, d, "part")


@register("a2_csv_scan", """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice
FROM orders""")
def a2_csv_scan(spark, d):
    path = scratch_path(spark, "orders-csv")
    src = read_table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.date_format("o_orderdate", "dd/MM/yy").alias("o_orderdate"), "o_totalprice")
    files.write_table(src, path, fmt="csv")
    return files.read_csv(spark, path, "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate DATE, o_totalprice DOUBLE",
                          dmy2_dates=("o_orderdate",))


@register("a3_json_scan", "SELECT event_id, ts, user_id, event_type, value FROM events")
def a3_json_scan(spark, d):
    path = scratch_path(spark, "events-json")
    files.write_table(read_table(spark, d, "events").drop("props"), path, fmt="json")
    return files.read_json(spark, path, "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                                        "value DOUBLE")


@register("a4_partitioned_sink", with_ctes(*WEEKLY_CTES[:4]) + "SELECT * FROM wf")
def a4_partitioned_sink(spark, d):
    path = scratch_path(spark, "weekly-by-week")
    tx = proxies.transactions(spark, d)
    files.write_table(aggs.weekly_rollup(tx), path, partition_by=["week"])
    back = spark.read.schema("customer_id BIGINT, product_id BIGINT, weekly_items DOUBLE, week INT").parquet(path)
    return back.select("customer_id", "week", "product_id", "weekly_items")


@register("a5_append_history", """
SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
UNION ALL
SELECT * FROM orders n WHERE o_orderdate >= TIMESTAMP '1998-07-01'
  AND NOT EXISTS (SELECT 1 FROM orders h WHERE h.o_orderdate < TIMESTAMP '1999-01-01' AND h.o_orderkey = n.o_orderkey)""")
def a5_append_history(spark, d):
    o = read_table(spark, d, "orders")
    history = o.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    batch = o.filter(F.col("o_orderdate") >= F.lit("1998-07-01").cast("timestamp_ntz"))
    once = files.extend_history(history, batch, ["o_orderkey"])
    return files.extend_history(once, batch, ["o_orderkey"])  # a re-run adds nothing


@register("a6_union_sources", """
SELECT c_custkey, c_name, c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer WHERE c_nationkey < 12
UNION ALL
SELECT c_custkey, c_name, CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment FROM customer WHERE c_nationkey >= 12""")
def a6_union_sources(spark, d):
    c = read_table(spark, d, "customer")
    p1, p2, p3 = (scratch_path(spark, f"source{i}") for i in (1, 2, 3))
    files.write_table(c.filter("c_nationkey < 12").select("c_custkey", "c_name", "c_acctbal"), p1)
    files.write_table(c.filter("c_nationkey >= 12").select("c_custkey", "c_name", "c_mktsegment"), p2)
    return files.union_sources(spark, [p1, p2, p3])  # p3 was never written


@register("a7_contract_check", with_ctes(SQL_TX) + """
SELECT count(*) AS n_rows, CAST(count_if(customer_id IS NULL) AS BIGINT) AS null_customer_id,
       CAST(count_if(product_id IS NULL) AS BIGINT) AS null_product_id, CAST(count_if(purchase_date IS NULL) AS BIGINT) AS null_purchase_date,
       CAST(count_if(items IS NOT NULL AND TRY_CAST(items AS INTEGER) IS NULL) AS BIGINT) AS badcast_items
FROM tx""")
def a7_contract_check(spark, d):
    tx = proxies.transactions(spark, d)
    return files.contract_violations(tx, ["customer_id", "product_id", "purchase_date", "items"],
                                     ["customer_id", "product_id", "purchase_date"], {"items": "int"})


@register("a7_contract_check_per_file", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_rows,
       CAST(count_if(o_custkey IS NULL) AS BIGINT) AS null_o_custkey,
       CAST(count_if(o_orderdate IS NULL) AS BIGINT) AS null_o_orderdate,
       CAST(count_if(o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS INTEGER) IS NULL) AS BIGINT)
         AS badcast_o_orderpriority
FROM orders GROUP BY year(o_orderdate)""")
def a7_contract_check_per_file(spark, d):
    """Landing files, one per order year (written by one partitioned job), each
    checked on its own."""
    path = scratch_path(spark, "orders-by-year")
    o = read_table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    o.repartition("year").write.partitionBy("year").parquet(path)
    back = spark.read.schema("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
                             "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING, year INT").parquet(path)
    chk = files.contract_violations(back, ["o_orderkey", "o_custkey", "o_orderdate"], ["o_custkey", "o_orderdate"],
                                    {"o_orderpriority": "int"}, per_file=True)
    year = F.regexp_extract(F.col("file_path"), r"year=(\d+)", 1).cast("int")
    return chk.groupBy(year.alias("year")).agg(F.sum("n_rows").alias("n_rows"),
                                               *[F.sum(c).alias(c) for c in chk.columns if c not in ("file_path", "n_rows")])


# ------------------------------------------------------------- flagship ----

@register("d1_weekly_rollup", with_ctes(*WEEKLY_CTES) + "SELECT * FROM w")
def d1_weekly_rollup(spark, d):
    return weekly_data(spark, d)


@register("i1_priority_label", with_ctes(*LABELLED_CTES) + "SELECT * FROM lab")
def i1_priority_label(spark, d):
    return weekly_priority(spark, d)


@register("d7_class_balance", with_ctes(*LABELLED_CTES) + """
SELECT priority, count(*) AS n, count(*) / (SELECT count(*) FROM lab) AS share FROM lab GROUP BY priority""")
def d7_class_balance(spark, d):
    return aggs.class_balance(weekly_priority(spark, d), "priority")


# ----------------------------------------------------------- aggregates ----

_D2_COLS = [("customer", "c_acctbal"), ("orders", "o_totalprice")]


def _d2_sql():
    parts = [f"""SELECT '{c}' AS column_name, count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std,
  CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
  quantile_cont({c}, 0.75) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM {t}""" for t, c in _D2_COLS]
    return sql_round(" UNION ALL ".join(parts), ["mean", "std", "min", "p25", "p50", "p75", "max"])


@register("d2_numeric_describe", _d2_sql())
def d2_numeric_describe(spark, d):
    from functools import reduce
    from pyspark.sql import DataFrame
    parts = [aggs.describe_numeric(read_table(spark, d, t), [c]) for t, c in _D2_COLS]
    return round_doubles(reduce(DataFrame.unionByName, parts))


_D3_COLS = [("customer", "c_mktsegment"), ("part", "p_type"), ("orders", "o_orderpriority")]


def _d3_sql():
    return " UNION ALL ".join(f"""SELECT '{c}' AS column_name, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_unique,
  (SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY n DESC, v LIMIT 1)
    AS top, max(n) AS freq
FROM (SELECT {c} AS v, count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY 1)""" for t, c in _D3_COLS)


@register("d3_categorical_describe", _d3_sql())
def d3_categorical_describe(spark, d):
    from functools import reduce
    from pyspark.sql import DataFrame
    return reduce(DataFrame.unionByName,
                  [aggs.describe_categorical(read_table(spark, d, t), [c]) for t, c in _D3_COLS])


SQL_CLIENT_P = """cp AS (
  SELECT c.c_custkey, c.c_mktsegment, c.c_nationkey, c.c_acctbal, p.n_p, p.v_p, p.last_p, p.prio_p
  FROM customer c LEFT JOIN (
    SELECT o_custkey, count(*) AS n_p, sum(o_totalprice) AS v_p, max(o_orderdate) AS last_p,
           max(o_orderpriority) AS prio_p
    FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey) p ON c.c_custkey = p.o_custkey)"""


def client_pending(spark, d):
    """Customers with their pending-order summary; customers without a pending
    order carry nulls (the data has no nulls of its own)."""
    c = read_table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    p = (read_table(spark, d, "orders").filter(F.col("o_orderstatus") == "P").groupBy("o_custkey")
         .agg(F.count(F.lit(1)).alias("n_p"), F.sum("o_totalprice").alias("v_p"),
              F.max("o_orderdate").alias("last_p"), F.max("o_orderpriority").alias("prio_p")))
    return c.join(p, c.c_custkey == p.o_custkey, "left").drop("o_custkey")


@register("d4_null_profile", with_ctes(SQL_CLIENT_P) + """
UNPIVOT (SELECT CAST(count_if(c_custkey IS NULL) AS BIGINT) AS c_custkey, CAST(count_if(c_mktsegment IS NULL) AS BIGINT) AS c_mktsegment,
  CAST(count_if(c_nationkey IS NULL) AS BIGINT) AS c_nationkey, CAST(count_if(c_acctbal IS NULL) AS BIGINT) AS c_acctbal,
  CAST(count_if(n_p IS NULL) AS BIGINT) AS n_p, CAST(count_if(v_p IS NULL) AS BIGINT) AS v_p, CAST(count_if(last_p IS NULL) AS BIGINT) AS last_p,
  CAST(count_if(prio_p IS NULL) AS BIGINT) AS prio_p FROM cp)
ON COLUMNS(*) INTO NAME column_name VALUE n_null""")
def d4_null_profile(spark, d):
    return aggs.null_profile(client_pending(spark, d))


@register("d5_negative_profile", """
UNPIVOT (SELECT CAST(count_if(c_custkey < 0) AS BIGINT) AS c_custkey, CAST(count_if(c_nationkey < 0) AS BIGINT) AS c_nationkey,
  CAST(count_if(c_acctbal < 0) AS BIGINT) AS c_acctbal FROM customer)
ON COLUMNS(*) INTO NAME column_name VALUE n_negative""")
def d5_negative_profile(spark, d):
    return aggs.negative_profile(read_table(spark, d, "customer"))


@register("d6_distinct_counts", with_ctes(SQL_TX) + """
UNPIVOT (SELECT count(DISTINCT customer_id) AS customer_id, count(DISTINCT product_id) AS product_id,
  count(DISTINCT order_id) AS order_id FROM tx)
ON COLUMNS(*) INTO NAME column_name VALUE n_distinct""")
def d6_distinct_counts(spark, d):
    return aggs.distinct_counts(proxies.transactions(spark, d), ["customer_id", "product_id", "order_id"])


@register("d8_mean_size", sql_round(with_ctes(SQL_RATINGS) + """
SELECT item_id, avg(rating) AS mean_rating, count(*) AS n FROM ratings GROUP BY item_id""", ["mean_rating"]))
def d8_mean_size(spark, d):
    return round_doubles(aggs.mean_and_size(proxies.ratings(spark, d), "item_id", "rating"))


@register("d9_group_size", with_ctes(SQL_TX) + "SELECT customer_id, count(*) AS n FROM tx GROUP BY customer_id")
def d9_group_size(spark, d):
    return aggs.group_size(proxies.transactions(spark, d), "customer_id")


@register("d10_quantiles_by_client", sql_round(with_ctes(*WEEKLY_CTES[:4]) + """
SELECT customer_id, quantile_cont(weekly_items, 0.2) AS q20, quantile_cont(weekly_items, 0.4) AS q40,
       quantile_cont(weekly_items, 0.6) AS q60, quantile_cont(weekly_items, 0.8) AS q80
FROM wf GROUP BY customer_id""", ["q20", "q40", "q60", "q80"]))
def d10_quantiles_by_client(spark, d):
    wf = aggs.weekly_rollup(proxies.transactions(spark, d))
    return round_doubles(aggs.quantiles_by(wf, "weekly_items", ["customer_id"]))


@register("d10_quantiles_global", sql_round("""
SELECT quantile_cont(l_extendedprice, 0.2) AS q20, quantile_cont(l_extendedprice, 0.4) AS q40,
       quantile_cont(l_extendedprice, 0.6) AS q60, quantile_cont(l_extendedprice, 0.8) AS q80
FROM lineitem""", ["q20", "q40", "q60", "q80"]))
def d10_quantiles_global(spark, d):
    return round_doubles(aggs.quantiles_by(read_table(spark, d, "lineitem"), "l_extendedprice", None))


@register("d11_group_mode", with_ctes(SQL_TX, "products AS (SELECT p_partkey AS product_id, p_type AS category FROM part)") + """
SELECT customer_id, category AS mode_category FROM (
  SELECT customer_id, category, row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, category) AS rn
  FROM (SELECT tx.customer_id, p.category, count(*) AS n FROM tx JOIN products p ON tx.product_id = p.product_id
        WHERE p.category IS NOT NULL GROUP BY 1, 2)) WHERE rn = 1""")
def d11_group_mode(spark, d):
    tx = proxies.transactions(spark, d)
    pr = proxies.products(spark, d).select("product_id", "category")
    return aggs.group_mode(tx.join(pr, "product_id"), ["customer_id"], "category", "mode_category")


@register("d12_fd_violations", """
SELECT p_brand, count(DISTINCT p_type) AS n_p_type, count(DISTINCT p_size) AS n_p_size FROM part
GROUP BY p_brand HAVING count(DISTINCT p_type) > 1 OR count(DISTINCT p_size) > 1""")
def d12_fd_violations(spark, d):
    return aggs.functional_dependency_violations(read_table(spark, d, "part"), "p_brand", ["p_type", "p_size"])


@register("d13_period_bounds", "SELECT min(o_orderdate) AS first_date, max(o_orderdate) AS last_date FROM orders")
def d13_period_bounds(spark, d):
    return aggs.period_bounds(read_table(spark, d, "orders"), "o_orderdate")


@register("d14_mean_distinct_gap", sql_round("""
SELECT datediff('day', min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)))
       / (count(DISTINCT CAST(o_orderdate AS DATE)) - 1) AS mean_gap_days FROM orders""", ["mean_gap_days"]))
def d14_mean_distinct_gap(spark, d):
    return round_doubles(aggs.mean_distinct_gap(read_table(spark, d, "orders"), "o_orderdate"))


_D15 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _d15_sql():
    return " UNION ALL ".join(f"""SELECT '{c}' AS column_name, CAST(count_if({c} < q[1] - 1.5 * (q[2] - q[1])
  OR {c} > q[2] + 1.5 * (q[2] - q[1])) AS BIGINT) AS n_outliers
FROM lineitem, (SELECT quantile_cont({c}, [0.25, 0.75]) AS q FROM lineitem)""" for c in _D15)


@register("d15_outlier_columns", _d15_sql())
def d15_outlier_columns(spark, d):
    return aggs.outlier_columns(read_table(spark, d, "lineitem"), _D15)


@register("d16_duplicate_keys", with_ctes(SQL_TX) + """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates FROM (
  SELECT customer_id, product_id, CAST(purchase_date AS DATE) AS day, count(*) AS n FROM tx GROUP BY 1, 2, 3)""")
def d16_duplicate_keys(spark, d):
    tx = proxies.transactions(spark, d).withColumn("day", F.to_date("purchase_date"))
    return aggs.duplicate_rows(tx, ["customer_id", "product_id", "day"])


@register("d16_consistency_counts", with_ctes(SQL_TX) + """
, visits AS (SELECT o.o_custkey, count(DISTINCT CAST(l.l_shipdate AS DATE)) AS deliveries,
    count(DISTINCT CAST(o.o_orderdate AS DATE)) AS visits
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY 1)
SELECT (SELECT count(*) FROM visits WHERE deliveries > visits) AS n_deliveries_over_visits,
  (SELECT count(DISTINCT p_partkey) FROM part WHERE p_size > 5) AS n_products_over_size,
  (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (
    SELECT customer_id, product_id, CAST(purchase_date AS DATE) AS day, count(*) AS n FROM tx GROUP BY 1, 2, 3)) AS n_duplicates""")
def d16_consistency_counts(spark, d):
    """All three checks: customers with more delivery days than order days, distinct
    products above size 5, surplus (client, product, day) rows."""
    li = read_table(spark, d, "lineitem").select("l_orderkey", F.to_date("l_shipdate").alias("ship"))
    od = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    per = (li.join(od, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey")
           .agg(F.count_distinct("ship").alias("deliveries"), F.count_distinct("day").alias("visits")))
    over = per.agg(F.count_if(F.col("deliveries") > F.col("visits")).alias("n_deliveries_over_visits"))
    sized = read_table(spark, d, "part").filter(F.col("p_size") > 5).agg(F.count_distinct("p_partkey").alias("n"))
    return over.withColumns({"n_products_over_size": sized.scalar(), "n_duplicates": d16_duplicate_keys(spark, d).scalar()})


@register("d17_duplicate_rows", """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates FROM (
  SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY ALL)""")
def d17_duplicate_rows(spark, d):
    return aggs.duplicate_rows(read_table(spark, d, "customer").select("c_mktsegment", "c_nationkey"))


@register("d18_histogram", sql_round("""
WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT CAST(bin AS INTEGER) AS bin, lo + (bin - 1) * (hi - lo) / 30.0 AS lower, lo + bin * (hi - lo) / 30.0 AS upper,
       count(*) AS n
FROM (SELECT CASE WHEN hi = lo THEN 1 ELSE least(floor((l_extendedprice - lo) * 30.0 / (hi - lo)) + 1, 30) END AS bin,
             lo, hi FROM lineitem, b WHERE l_extendedprice IS NOT NULL)
GROUP BY bin, lo, hi""", ["lower", "upper"]))
def d18_histogram(spark, d):
    return round_doubles(aggs.equal_width_histogram(read_table(spark, d, "lineitem"), "l_extendedprice", 30))


# Brand domain of the driver's part table (the item catalogue of the ratings
# proxy): Brand#1 … Brand#25.
BRANDS = [f"Brand#{i}" for i in range(1, 26)]


def _d19_sql():
    cols = ", ".join(f"round(avg(rating) FILTER (WHERE item_id = '{b}'), 6) AS \"{b}\"" for b in BRANDS)
    return with_ctes(SQL_RATINGS) + f"SELECT user_id, {cols} FROM ratings GROUP BY user_id"


@register("d19_pivot", _d19_sql())
def d19_pivot(spark, d):
    return round_doubles(aggs.pivot_mean(proxies.ratings(spark, d), "user_id", "item_id", "rating", BRANDS))


@register("d20_sparsity", sql_round(with_ctes(SQL_RATINGS) + """
SELECT count(DISTINCT user_id) AS n_rows, count(DISTINCT item_id) AS n_cols,
       count(DISTINCT (user_id, item_id)) AS n_filled,
       1 - count(DISTINCT (user_id, item_id)) / (count(DISTINCT user_id) * count(DISTINCT item_id)) AS sparsity
FROM ratings""", ["sparsity"]))
def d20_sparsity(spark, d):
    return round_doubles(aggs.sparsity(proxies.ratings(spark, d), "user_id", "item_id"))


_D21 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _d21_sql():
    pairs = [(a, b) for i, a in enumerate(_D21) for b in _D21[i + 1:]]
    return " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
                              for a, b in pairs)


@register("d21_correlation", _d21_sql())
def d21_correlation(spark, d):
    return round_doubles(aggs.correlation_pairs(read_table(spark, d, "lineitem"), _D21))


@register("d22_scalar_broadcast", """
SELECT o_orderkey, CAST(datediff('day', CAST(o_orderdate AS DATE),
       (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)) AS INTEGER) AS days_before_last FROM orders""")
def d22_scalar_broadcast(spark, d):
    o = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    o = aggs.with_scalar(o, "_last", F.max(F.to_date("o_orderdate")))
    return o.select("o_orderkey", F.datediff("_last", F.to_date("o_orderdate")).alias("days_before_last"))
