"""Helpers shared by the training-data operators."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.session import scratch_path, ship  # noqa: F401  (ship: for the queries)

#: A word is a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and reread it: what
    follows does not recompute it when an executor is lost, and several
    consumers read the same rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def crc_bucket(key: Column, mod: int) -> Column:
    """crc32 of the key written as text, modulo ``mod`` (a null key counts as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def long_array(values) -> Column:
    """A constant array<bigint>; one folded literal, whatever its length."""
    return F.split(F.lit(",".join(str(int(v)) for v in values)), ",").cast("array<bigint>")


def small_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A driver-made table of bounded size, as JVM rows."""
    doc = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(doc))


def expand(df: DataFrame, count: str, out: str, chunk: int = 4096) -> DataFrame:
    """Repeat each row ``count`` times (0: dropped), numbered 0.. in ``out``.
    Large counts are cut into chunks that a rebalancing shuffle spreads, so one
    much repeated row does not burden one task."""
    last = F.col(count) - 1
    parts = df.filter(F.col(count) > 0).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / chunk).cast("long"))))
    return (parts.hint("rebalance")
            .withColumn(out, F.explode(F.sequence(F.col("_chunk") * chunk,
                                                  F.least(F.col(count), (F.col("_chunk") + 1) * chunk) - 1)))
            .drop("_chunk"))
