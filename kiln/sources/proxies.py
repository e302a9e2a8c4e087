"""Proxy tables: the reference's inputs re-expressed over the driver tables.

Each proxy exists twice: as a DataFrame builder used by the library and as a
SQL common-table expression used by the DuckDB oracle, so both engines read
exactly the same rows.

| reference input | proxy |
| transactions | lineitem ⋈ orders |
| clients      | customer |
| products     | part |
| retail rows  | lineitem ⋈ orders (unit price = extended price / quantity) |
| ratings      | mean quantity of a customer per brand, scaled to 1..5 |
| daily series | orders per day |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.sources.tables import join_partitions, read_table


def transactions(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    n = join_partitions(spark, d, "lineitem", "orders")
    if n:  # rows without a key join nothing; they must not meet in one partition either
        li = li.filter("l_orderkey IS NOT NULL").repartition(n, "l_orderkey")
        od = od.filter("o_orderkey IS NOT NULL").repartition(n, "o_orderkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("product_id"),
                    F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("purchase_date"),
                    F.col("l_quantity").alias("items")))


SQL_TX = """tx AS (
  SELECT o.o_custkey AS customer_id, l.l_partkey AS product_id, o.o_orderkey AS order_id,
         o.o_orderdate AS purchase_date, l.l_quantity AS items
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def clients(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("customer_type"),
        F.col("c_nationkey").alias("zone_id"), F.col("c_acctbal").alias("acctbal"))


SQL_CLIENTS = """clients AS (
  SELECT c_custkey AS customer_id, c_mktsegment AS customer_type, c_nationkey AS zone_id,
         c_acctbal AS acctbal FROM customer)"""


def products(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"), F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("price"))


SQL_PRODUCTS = """products AS (
  SELECT p_partkey AS product_id, p_brand AS brand, p_type AS category, p_size AS size,
         p_retailprice AS price FROM part)"""


def retail(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    od = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("invoice_date"),
                    F.col("o_orderkey").alias("invoice"), F.col("l_quantity").alias("quantity"),
                    (F.col("l_extendedprice") / F.col("l_quantity")).alias("price")))


SQL_RETAIL = """retail AS (
  SELECT o.o_custkey AS customer_id, o.o_orderdate AS invoice_date, o.o_orderkey AS invoice,
         l.l_quantity AS quantity, l.l_extendedprice / l.l_quantity AS price
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def ratings(spark: SparkSession, d: str) -> DataFrame:
    """(user_id, item_id, rating) with rating = 1 + 4·(mean quantity − 1)/49 in [1, 5]."""
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = read_table(spark, d, "orders").select("o_orderkey", "o_custkey")
    pt = read_table(spark, d, "part").select("p_partkey", "p_brand")
    j = (li.join(od, li.l_orderkey == od.o_orderkey).join(pt, li.l_partkey == pt.p_partkey))
    return (j.groupBy(F.col("o_custkey").alias("user_id"), F.col("p_brand").alias("item_id"))
            .agg((F.lit(1.0) + F.lit(4.0) * (F.avg("l_quantity") - F.lit(1.0)) / F.lit(49.0)).alias("rating")))


SQL_RATINGS = """ratings AS (
  SELECT o.o_custkey AS user_id, p.p_brand AS item_id,
         1.0 + 4.0 * (avg(l.l_quantity) - 1.0) / 49.0 AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY o.o_custkey, p.p_brand)"""


def daily_series(spark: SparkSession, d: str) -> DataFrame:
    """One row per calendar day with orders: (series_id, ds, y, price_level)."""
    od = read_table(spark, d, "orders")
    return (od.groupBy(F.to_date("o_orderdate").alias("ds"))
            .agg(F.sum("o_totalprice").alias("y"), F.avg("o_totalprice").alias("x_price"),
                 F.count("*").cast("double").alias("x_orders"))
            .withColumn("series_id", F.lit("all")))


def daily_panel(spark: SparkSession, d: str, orders: bool = False) -> DataFrame:
    """The daily series of every order priority: (series_id, ds, y), with ``orders``
    also the day's number of orders, x_orders."""
    od = read_table(spark, d, "orders")
    return (od.groupBy(F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("ds"))
            .agg(F.sum("o_totalprice").alias("y"), *([F.count(F.lit(1)).cast("double").alias("x_orders")] if orders else [])))


SQL_PANEL = """panel AS (
  SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS ds, sum(o_totalprice) AS y
  FROM orders GROUP BY o_orderpriority, CAST(o_orderdate AS DATE))"""


SQL_DAILY = """daily AS (
  SELECT CAST(o_orderdate AS DATE) AS ds, sum(o_totalprice) AS y, avg(o_totalprice) AS x_price,
         CAST(count(*) AS DOUBLE) AS x_orders, 'all' AS series_id
  FROM orders GROUP BY CAST(o_orderdate AS DATE))"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
