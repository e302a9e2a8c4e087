"""SQL fragments shared by the DuckDB oracles (mirror of the proxy builders)."""

from kiln.sources.proxies import SQL_CLIENTS, SQL_DAILY, SQL_PANEL, SQL_PRODUCTS, SQL_RATINGS, SQL_RETAIL, SQL_TX, with_ctes

SQL_WEEKLY_FACT = """wf AS (
  SELECT customer_id, CAST(week(purchase_date) AS INTEGER) AS week, product_id,
         coalesce(sum(items), 0.0) AS weekly_items
  FROM (SELECT DISTINCT customer_id, product_id, purchase_date, items, order_id FROM tx) f
  WHERE customer_id IS NOT NULL AND product_id IS NOT NULL AND purchase_date IS NOT NULL
  GROUP BY customer_id, CAST(week(purchase_date) AS INTEGER), product_id)"""

SQL_WEEKLY = """w AS (
  SELECT wf.customer_id, wf.week, wf.product_id, wf.weekly_items,
         c.customer_type, c.zone_id, c.acctbal, p.brand, p.category, p.size, p.price
  FROM wf LEFT JOIN clients c ON wf.customer_id = c.customer_id
          LEFT JOIN products p ON wf.product_id = p.product_id)"""

SQL_PRIORITY = """g AS (SELECT quantile_cont(weekly_items, [0.2, 0.4, 0.6, 0.8]) AS q FROM w),
pc AS (SELECT customer_id, quantile_cont(weekly_items, [0.2, 0.4, 0.6, 0.8]) AS q FROM w
       WHERE customer_id IS NOT NULL GROUP BY customer_id HAVING count(weekly_items) >= 5),
lab AS (
  SELECT w.*, CASE
      WHEN w.weekly_items <= coalesce(pc.q[1], (SELECT q[1] FROM g)) THEN 'Very Low'
      WHEN w.weekly_items <= coalesce(pc.q[2], (SELECT q[2] FROM g)) THEN 'Low'
      WHEN w.weekly_items <= coalesce(pc.q[3], (SELECT q[3] FROM g)) THEN 'Medium'
      WHEN w.weekly_items <= coalesce(pc.q[4], (SELECT q[4] FROM g)) THEN 'High'
      ELSE 'Very High' END AS priority
  FROM w LEFT JOIN pc ON w.customer_id = pc.customer_id)"""

WEEKLY_CTES = [SQL_TX, SQL_CLIENTS, SQL_PRODUCTS, SQL_WEEKLY_FACT, SQL_WEEKLY]
LABELLED_CTES = WEEKLY_CTES + [SQL_PRIORITY]

__all__ = ["SQL_CLIENTS", "SQL_DAILY", "SQL_PRODUCTS", "SQL_RATINGS", "SQL_RETAIL", "SQL_TX", "with_ctes",
           "SQL_WEEKLY_FACT", "SQL_WEEKLY", "SQL_PRIORITY", "WEEKLY_CTES", "LABELLED_CTES"]
