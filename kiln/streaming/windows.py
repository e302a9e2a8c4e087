"""Weekly totals per key on a stream.  A window is emitted (append mode)
once the watermark passes its end; rows older than the watermark of the
previous micro-batch are dropped as late (Spark's rule for stateful
operators), so a row can still join a window in the batch that closes it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def weekly_totals(stream: DataFrame, ts: str, key: str, value: str, delay: str = "1 day") -> DataFrame:
    """Monday-aligned 7-day tumbling windows (epoch is a Thursday, hence the
    4-day offset), sum and count per key.

    Watermarks need an instant (TIMESTAMP); a wall-clock ``TIMESTAMP_NTZ``
    column is read as UTC and the window bounds are returned as wall clock, so
    start the query with the session time zone set to UTC."""
    if dict((f.name, f.dataType.simpleString()) for f in stream.schema.fields)[ts] == "timestamp_ntz":
        stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
        back = "timestamp_ntz"
    else:
        back = "timestamp"
    w = F.window(F.col(ts), "7 days", "7 days", "4 days")
    return (stream.withWatermark(ts, delay).groupBy(w.alias("w"), F.col(key))
            .agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").cast(back).alias("window_start"), F.col("w.end").cast(back).alias("window_end"),
                    key, "total", "n"))
