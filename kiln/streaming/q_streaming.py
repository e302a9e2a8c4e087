"""Queries: Structured Streaming twins (S1–S3).  Each query lands data derived
from the given tables as files, runs the stream to completion
(``availableNow``) and returns the sink as a batch DataFrame."""

from __future__ import annotations

import os

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from kiln.plans.registry import register
from kiln.plans.sqlparts import SQL_TX, with_ctes
from kiln.session import scratch_path
from kiln.sources import proxies
from kiln.sources.tables import read_table
from kiln.streaming import alerts, ingest, windows

TX_SCHEMA = "customer_id BIGINT, product_id BIGINT, order_id BIGINT, purchase_date TIMESTAMP_NTZ, items DOUBLE"


@register("s1_stream_ingest", with_ctes(SQL_TX) + "SELECT DISTINCT * FROM tx")
def s1_stream_ingest(spark, d):
    tx = proxies.transactions(spark, d)
    landing = scratch_path(spark, "landing-tx")
    # one folder per order year, and 1997 delivered again under a new name: one job, files split by size
    year = F.year("purchase_date").cast("string")
    parts = F.when(year == "1997", F.array(year, F.lit("resent"))).otherwise(F.array(year))
    tx.withColumn("part", F.explode(parts)).hint("rebalance", "part").write.partitionBy("part").parquet(landing)
    landing_glob = os.path.join(landing, "*")
    history = scratch_path(spark, "history-tx")
    q = ingest.ingest_files(spark, landing_glob, history, scratch_path(spark, "ckpt-ingest"), TX_SCHEMA,
                           event_col="purchase_date", files_per_trigger=4)
    q.awaitTermination()
    return ingest.read_history(spark, history, TX_SCHEMA)


@register("s2_stream_weekly_totals", """
WITH e AS (SELECT ts, event_type, value FROM events),
w AS (SELECT time_bucket(INTERVAL 7 DAY, ts) AS window_start, event_type, sum(value) AS total, count(*) AS n
      FROM e GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, event_type, round(total, 6) AS total, n FROM w
WHERE window_start + INTERVAL 7 DAY <= (SELECT max(ts) FROM e) - INTERVAL 1 DAY""")
def s2_stream_weekly_totals(spark, d):
    ev = read_table(spark, d, "events").select("ts", "event_type", "value")
    landing = scratch_path(spark, "landing-events")
    ev.withColumn("day", F.to_date("ts")).hint("rebalance", "day").write.partitionBy("day").parquet(landing)
    stream = spark.readStream.schema("ts TIMESTAMP_NTZ, event_type STRING, value DOUBLE").parquet(os.path.join(landing, "*"))
    out = scratch_path(spark, "weekly-stream")
    tz = spark.conf.get("spark.sql.session.timeZone")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # captured by the query at start
    # State partitions are fixed at the first start (AQE does not coalesce a
    # stateful stream): one per core of the cluster.
    spark.conf.set("spark.sql.shuffle.partitions", str(max(1, spark.sparkContext.defaultParallelism)))
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    # RocksDB keeps window state off the JVM heap (state larger than memory).
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        q = (windows.weekly_totals(stream, "ts", "event_type", "value").writeStream.format("parquet")
             .outputMode("append").option("path", out).option("checkpointLocation", scratch_path(spark, "ckpt-weekly"))
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.session.timeZone", tz)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    res = spark.read.parquet(out)
    return res.select("window_start", "window_end", "event_type", F.round("total", 6).alias("total"), "n")


@register("s3_stream_alerts")
def s3_stream_alerts(spark, d):
    ev = read_table(spark, d, "events").select("event_id", "ts", "value", "event_type")
    feats = ev.withColumn("hour", F.hour("ts").cast("double")).withColumn(
        "label", (F.col("event_type") == "error").cast("double"))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["value", "hour"], outputCol="_raw"),
                            StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
                            LogisticRegression(maxIter=50, threshold=0.2)])
    path = scratch_path(spark, "alert-pipeline")
    pipe.fit(feats).write().overwrite().save(path)
    landing = scratch_path(spark, "landing-sensors")
    feats.select("event_id", "ts", "value", "hour").repartition(8).write.parquet(landing)
    stream = spark.readStream.schema("event_id BIGINT, ts TIMESTAMP_NTZ, value DOUBLE, hour DOUBLE").parquet(landing)
    out = scratch_path(spark, "alerts")
    q = (alerts.alerts(stream, path).select("event_id", "ts", "value").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", scratch_path(spark, "ckpt-alerts")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)
