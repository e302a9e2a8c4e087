"""Flagship plan: weekly purchase priority per (client, week, product).

star inputs → dedup → weekly roll-up (aggregated before the dimension joins)
→ per-client quantile label.  Shuffles: dedup (all columns), roll-up
(customer, week, product), label join (customer); the dimension joins are
broadcast by AQE when their runtime size is under the threshold and
sort-merge otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kiln.operators.aggs import weekly_rollup
from kiln.operators.labels import assign_priority
from kiln.sources.tables import join_partitions, read_star


def weekly_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx, clients, products = read_star(spark, sf_dir)
    return weekly_rollup(tx, clients, products)


def weekly_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label on the fact-level roll-up, then attach the dimensions: the label's
    quantile branches (per client and global) read the same roll-up exchange,
    which AQE reuses instead of recomputing the roll-up behind the joins."""
    tx, clients, products = read_star(spark, sf_dir)
    n = join_partitions(spark, sf_dir, "lineitem", "orders")
    return assign_priority(weekly_rollup(tx, partitions=n), partitions=n).join(clients, "customer_id", "left").join(products, "product_id", "left")
