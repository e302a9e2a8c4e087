"""Parquet scans of the driver tables with declared schemas (A1).

Declaring the schema skips footer inference, and the scan only reads the
columns a plan asks for (``ReadSchema`` in ``explain``)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

SCHEMAS: dict[str, str] = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                 "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                 "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table with its declared schema; a missing path is the scan's error."""
    return spark.read.schema(SCHEMAS[name]).parquet(table_path(sf_dir, name))


#: Input from which a join's partitions are counted, and the bytes of a partition.
COUNTED_FROM, PARTITION_BYTES = 128_000_000, 8_000_000


def table_bytes(spark: SparkSession, sf_dir: str, *names: str) -> int:
    """Bytes of the files of these tables."""
    size = 0
    for name in names:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, name))
        size += where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(where).getLength()
    return size


def join_partitions(spark: SparkSession, sf_dir: str, *names: str) -> int | None:
    """Partitions for a join of these tables whose tasks stay of one size however large
    the files are (the session's number, coalesced by compressed bytes, does not see how
    far the rows expand); none for small tables, which Spark may broadcast."""
    size = table_bytes(spark, sf_dir, *names)
    return -(-size // PARTITION_BYTES) if size >= COUNTED_FROM else None


def read_star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three inputs of the weekly plan: transactions, clients, products
    (as proxies over the driver tables)."""
    from kiln.sources import proxies
    return (proxies.transactions(spark, sf_dir), proxies.clients(spark, sf_dir),
            proxies.products(spark, sf_dir))
