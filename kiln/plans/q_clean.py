"""Queries: cleaning (B), joins (C1–C6), set operations (G) and scalar functions (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions import dates, mathx, text
from kiln.operators import clean, joins, sets
from kiln.plans.common import round_doubles, sql_round
from kiln.plans.q_core import SQL_CLIENT_P, client_pending
from kiln.plans.registry import register
from kiln.plans.sqlparts import SQL_CLIENTS, SQL_DAILY, SQL_PRODUCTS, SQL_RETAIL, SQL_TX, with_ctes
from kiln.sources import proxies
from kiln.sources.tables import read_table

# ---------------------------------------------------------------- cleaning ----


@register("b1_project_drop", "SELECT * EXCLUDE (l_tax, l_linestatus, l_shipdate) FROM lineitem")
def b1_project_drop(spark, d):
    return clean.project(read_table(spark, d, "lineitem"), drop=["l_tax", "l_linestatus", "l_shipdate"])


@register("b2_predicate_filter", """
SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'
  AND l_quantity > 20 AND l_returnflag = 'R'""")
def b2_predicate_filter(spark, d):
    li = read_table(spark, d, "lineitem")
    return (li.filter((F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
                      & (F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
                      & (F.col("l_quantity") > 20) & (F.col("l_returnflag") == "R"))
            .select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate"))


@register("b3_drop_nulls", with_ctes(SQL_CLIENT_P) + "SELECT * FROM cp WHERE v_p IS NOT NULL")
def b3_drop_nulls(spark, d):
    return clean.drop_nulls(client_pending(spark, d), ["v_p"])


@register("b4_dedup_rows", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def b4_dedup_rows(spark, d):
    return clean.dedup_rows(read_table(spark, d, "orders").select("o_custkey", "o_orderstatus"))


@register("b5_keep_first", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority) AS rn FROM orders) WHERE rn = 1""")
def b5_keep_first(spark, d):
    return clean.keep_first(read_table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@register("b6_rename", "SELECT c_custkey AS customer_id, c_mktsegment AS customer_type FROM customer")
def b6_rename(spark, d):
    c = read_table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return clean.rename(c, {"c_custkey": "customer_id", "c_mktsegment": "customer_type"})


@register("b7_casts", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_code, CAST(o_orderdate AS DATE) AS order_day,
       CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS order_ts, CAST(o_custkey AS DOUBLE) AS cust_num
FROM orders""")
def b7_casts(spark, d):
    o = read_table(spark, d, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("order_code"), F.to_date("o_orderdate").alias("order_day"),
                    F.to_timestamp_ntz(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("order_ts"),
                    F.col("o_custkey").cast("double").alias("cust_num"))


@register("b8_derived_arithmetic", sql_round(with_ctes(SQL_RETAIL) + """
SELECT customer_id, invoice, quantity * price AS total_price FROM retail""", ["total_price"]))
def b8_derived_arithmetic(spark, d):
    r = proxies.retail(spark, d)
    return round_doubles(r.select("customer_id", "invoice", (F.col("quantity") * F.col("price")).alias("total_price")))


PRIORITY_GROUPS = {"1-URGENT": "high", "2-HIGH": "high", "3-MEDIUM": "mid", "5-LOW": "low"}


@register("b9_category_mapping", """
SELECT o_orderkey, o_orderpriority, CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high'
  WHEN '3-MEDIUM' THEN 'mid' WHEN '5-LOW' THEN 'low' END AS priority_group
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')""")
def b9_category_mapping(spark, d):
    o = read_table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return clean.map_categories(o, "o_orderpriority", PRIORITY_GROUPS, "priority_group")


@register("b10_presence_flag", with_ctes(SQL_CLIENT_P) + """
SELECT c_custkey, CAST(v_p IS NOT NULL AS INTEGER) AS has_pending FROM cp""")
def b10_presence_flag(spark, d):
    return clean.presence_flag(client_pending(spark, d), "v_p", "has_pending").select("c_custkey", "has_pending")


@register("b11_constant_columns", """
SELECT DISTINCT l_partkey AS product_id, CAST(1001 AS BIGINT) AS customer_id, 27 AS week FROM lineitem""")
def b11_constant_columns(spark, d):
    p = read_table(spark, d, "lineitem").select(F.col("l_partkey").alias("product_id")).distinct()
    return clean.with_constants(p, {"customer_id": 1001, "week": 27}).withColumn(
        "customer_id", F.col("customer_id").cast("long"))


@register("b12_decode_label", """
SELECT doc_id, CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'bad' END AS quality_label FROM labels""")
def b12_decode_label(spark, d):
    lb = read_table(spark, d, "labels")
    return clean.decode_label(lb, "quality", {1: "good", 0: "bad"}, "quality_label").select("doc_id", "quality_label")


@register("b13_normalised_match", "SELECT * FROM part WHERE lower(trim(p_type)) = 'promo'")
def b13_normalised_match(spark, d):
    return clean.match_normalised(read_table(spark, d, "part"), "p_type", "  Promo ")


@register("b14_hash_sample", """
SELECT * FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 100""")
def b14_hash_sample(spark, d):
    return clean.hash_sample(read_table(spark, d, "orders"), "o_orderkey", 100)


_B15 = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]


@register("b15_continuous_columns", """
UNPIVOT (SELECT coalesce(bool_or(l_quantity <> floor(l_quantity)), false) AS l_quantity,
  coalesce(bool_or(l_extendedprice <> floor(l_extendedprice)), false) AS l_extendedprice,
  coalesce(bool_or(l_discount <> floor(l_discount)), false) AS l_discount,
  coalesce(bool_or(l_linenumber <> floor(l_linenumber)), false) AS l_linenumber FROM lineitem)
ON COLUMNS(*) INTO NAME column_name VALUE is_continuous""")
def b15_continuous_columns(spark, d):
    return clean.continuous_columns(read_table(spark, d, "lineitem"), _B15)


# ------------------------------------------------------------------ joins ----

@register("c1_left_join", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_brand, p.p_type, p.p_size
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""")
def c1_left_join(spark, d):
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    pt = read_table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type", "p_size")
    return joins.left_join(li, pt, "l_partkey")


@register("c2_inner_join", """
SELECT o.o_orderkey, o.o_totalprice, c.c_custkey, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def c2_inner_join(spark, d):
    o = read_table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.col("o_custkey").alias("c_custkey"))
    c = read_table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return joins.inner_join(o, c, "c_custkey")


@register("c3_star_join", with_ctes(SQL_TX, SQL_CLIENTS, SQL_PRODUCTS) + """
SELECT tx.*, c.customer_type, c.zone_id, c.acctbal, p.brand, p.category, p.size, p.price
FROM tx LEFT JOIN clients c ON tx.customer_id = c.customer_id LEFT JOIN products p ON tx.product_id = p.product_id""")
def c3_star_join(spark, d):
    return joins.star_join(proxies.transactions(spark, d),
                           [(proxies.clients(spark, d), "customer_id"), (proxies.products(spark, d), "product_id")])


@register("c4_candidate_pairs", with_ctes(SQL_TX) + "SELECT DISTINCT customer_id, product_id FROM tx")
def c4_candidate_pairs(spark, d):
    return joins.candidate_pairs(proxies.transactions(spark, d), "customer_id", "product_id")


@register("c5_anti_join", """
SELECT c.* FROM customer c WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderdate >= TIMESTAMP '2001-01-01')""")
def c5_anti_join(spark, d):
    c = read_table(spark, d, "customer")
    o = (read_table(spark, d, "orders").filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
         .select(F.col("o_custkey").alias("c_custkey")))
    return joins.anti_join(c, o, "c_custkey")


@register("c6_semi_join", """
SELECT o.* FROM orders o WHERE o.o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def c6_semi_join(spark, d):
    o = read_table(spark, d, "orders")
    r = (read_table(spark, d, "lineitem").filter(F.col("l_returnflag") == "R")
         .select(F.col("l_orderkey").alias("o_orderkey")))
    return joins.semi_join(o, r, "o_orderkey")


# ------------------------------------------------------------------- sets ----

@register("g1_union_all", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def g1_union_all(spark, d):
    o = read_table(spark, d, "orders")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    a = o.filter(F.col("o_orderdate") < cut).select("o_orderkey", "o_custkey", "o_totalprice")
    b = o.filter(F.col("o_orderdate") >= cut).select("o_totalprice", "o_custkey", "o_orderkey")
    return sets.union_all([a, b])


def _order_halves(spark, d):
    """All dated orders, before and from the middle of 1998."""
    o, cut = read_table(spark, d, "orders"), F.lit("1998-07-01").cast("date")
    return o.filter(F.col("o_orderdate") < cut), o.filter(F.col("o_orderdate") >= cut)


@register("g2_union_distinct", """
SELECT o_custkey FROM orders WHERE o_orderdate < DATE '1998-07-01'
UNION SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '1998-07-01'""")
def g2_union_distinct(spark, d):
    return sets.union_distinct([o.select("o_custkey") for o in _order_halves(spark, d)])


@register("g3_precedence_union", """
WITH known AS (SELECT o_custkey, max(o_orderpriority) AS prio FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
     guess AS (SELECT c_custkey AS o_custkey, '3-MEDIUM' AS prio FROM customer)
SELECT * FROM known UNION ALL SELECT * FROM guess g WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.o_custkey = g.o_custkey)""")
def g3_precedence_union(spark, d):
    o = read_table(spark, d, "orders")
    known = o.filter(F.col("o_orderstatus") == "P").groupBy("o_custkey").agg(F.max("o_orderpriority").alias("prio"))
    guess = read_table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.lit("3-MEDIUM").alias("prio"))
    return sets.precedence_union([known, guess], ["o_custkey"])


@register("g4_set_difference", """
SELECT o_custkey FROM orders WHERE o_orderdate < DATE '1998-07-01'
EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '1998-07-01'""")
def g4_set_difference(spark, d):
    a, b = (o.select("o_custkey") for o in _order_halves(spark, d))
    return sets.difference(a, b, keep_duplicates=True)


# -------------------------------------------------------------- functions ----

@register("h1_iso_week", """
SELECT o_orderkey, CAST(week(o_orderdate) AS INTEGER) AS week,
       CAST(isoyear(o_orderdate) * 100 + week(o_orderdate) AS INTEGER) AS iso_year_week FROM orders""")
def h1_iso_week(spark, d):
    o = read_table(spark, d, "orders")
    return o.select("o_orderkey", dates.iso_week("o_orderdate").alias("week"),
                    dates.iso_year_week("o_orderdate").alias("iso_year_week"))


@register("h2_date_parts", """
SELECT o_orderkey, CAST(day(o_orderdate) AS VARCHAR) AS day, CAST(month(o_orderdate) AS VARCHAR) AS month,
       CAST(year(o_orderdate) AS VARCHAR) AS year FROM orders""")
def h2_date_parts(spark, d):
    return read_table(spark, d, "orders").select("o_orderkey", *dates.date_parts_as_category(F.col("o_orderdate")))


@register("h3_day_difference", """
SELECT l.l_orderkey, l.l_linenumber, CAST(l.l_shipdate AS DATE) AS ship_day,
       CAST(datediff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS INTEGER) AS ship_delay
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def h3_day_difference(spark, d):
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = read_table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    j = li.join(o, "l_orderkey")
    return j.select("l_orderkey", "l_linenumber", dates.day(F.col("l_shipdate")).alias("ship_day"),
                    dates.days_between(F.col("l_shipdate"), F.col("o_orderdate")).alias("ship_delay"))


@register("h4_next_week_number", """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS day,
  CAST(53 + floor(datediff('day', DATE '2000-12-31', CAST(o_orderdate AS DATE)) / 7) AS INTEGER) AS next_week,
  CAST((SELECT max(week(o_orderdate)) FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders))
       + 1 AS INTEGER) AS week_after_latest
FROM orders""")
def h4_next_week_number(spark, d):
    o = read_table(spark, d, "orders")
    latest_year = o.select(F.max(F.year("o_orderdate"))).scalar()
    after = o.filter(F.year("o_orderdate") == latest_year).select(F.max(F.weekofyear("o_orderdate")) + 1).scalar()
    return (o.select(F.to_date("o_orderdate").alias("day")).distinct()
            .select("day", dates.next_week_number(F.col("day"), "2000-12-31").alias("next_week"),
                    after.cast("int").alias("week_after_latest")))


@register("h5_fourier_terms", sql_round(with_ctes(SQL_DAILY) + """
SELECT ds, sin(2 * pi() * 1 * t / 365.0) AS f_sin1, cos(2 * pi() * 1 * t / 365.0) AS f_cos1,
           sin(2 * pi() * 2 * t / 365.0) AS f_sin2, cos(2 * pi() * 2 * t / 365.0) AS f_cos2,
           sin(2 * pi() * 3 * t / 365.0) AS f_sin3, cos(2 * pi() * 3 * t / 365.0) AS f_cos3
FROM (SELECT ds, CAST(datediff('day', (SELECT min(ds) FROM daily), ds) AS DOUBLE) AS t FROM daily)""",
    [f"f_{f}{k}" for k in (1, 2, 3) for f in ("sin", "cos")]))
def h5_fourier_terms(spark, d):
    s = proxies.daily_series(spark, d)
    t = F.datediff("ds", s.select(F.min("ds")).scalar())
    return round_doubles(s.select("ds", *mathx.fourier_terms(t, 365.0, 3)))


@register("h6_clip", """
SELECT l_orderkey, l_linenumber, greatest(least(l_extendedprice, 50000.0), 1000.0) AS price_clipped FROM lineitem""")
def h6_clip(spark, d):
    li = read_table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", mathx.clip("l_extendedprice", 1000.0, 50000.0).alias("price_clipped"))


@register("h7_guarded_division", sql_round("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount <> 0 THEN l_extendedprice / l_discount ELSE 0.0 END AS ratio
FROM lineitem""", ["ratio"]))
def h7_guarded_division(spark, d):
    li = read_table(spark, d, "lineitem")
    return round_doubles(li.select("l_orderkey", "l_linenumber",
                                   mathx.safe_div(F.col("l_extendedprice"), F.col("l_discount")).alias("ratio")))


@register("h8_round_abs_sqrt", sql_round("""
SELECT c_custkey, round_even(c_acctbal / 7, 2) AS bal_r2, abs(c_acctbal) AS bal_abs, sqrt(abs(c_acctbal)) AS bal_sqrt,
       pow(c_acctbal, 2) AS bal_sq FROM customer""", ["bal_sqrt", "bal_sq"]))
def h8_round_abs_sqrt(spark, d):
    c = read_table(spark, d, "customer")
    x = F.col("c_acctbal")
    return round_doubles(c.select("c_custkey", F.bround(x / 7, 2).alias("bal_r2"), F.abs(x).alias("bal_abs"),
                                  F.sqrt(F.abs(x)).alias("bal_sqrt"), F.pow(x, 2).alias("bal_sq")),
                         cols=["bal_sqrt", "bal_sq"])


@register("h9_term_document_frequency", """
SELECT term, count(DISTINCT doc_id) AS df FROM (
  SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '(\\w\\w+)', 1)) AS term FROM documents)
GROUP BY term HAVING count(DISTINCT doc_id) >= 10""")
def h9_term_document_frequency(spark, d):
    docs = read_table(spark, d, "documents")
    t = docs.select("doc_id", F.explode(text.tokens(F.col("text"))).alias("term")).distinct()
    return t.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= 10)
