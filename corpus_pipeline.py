"""From raw documents to training tokens: five stages, each on all that the one
before kept, each written as Parquet and reread.

1. quality          documents the rule ensemble scores below 0.7 go
2. near_duplicates  one document of every near-duplicate group stays
3. pii              personal data and the terms that reveal it are masked
4. mix              sources are brought to their target weights (documents leave or repeat)
5. bpe              texts become byte-level BPE tokens, decoded again as a check

Stages 1 to 4 return the columns of ``documents``; null texts pass as empty
ones, empty tables give empty results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm import bpe, mixing, neardup, pii, quality
from kiln.llm.common import crc_bucket, materialize, read, ship
from kiln.llm.queries import bpe_file, bpe_pattern


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    labels = read(spark, sf_dir, "labels").filter(crc_bucket(F.col("doc_id"), 4) != 2)
    scored = quality.score(docs, labels, out="_score")
    return scored.filter(F.col("_score") >= quality.ACCEPT).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return neardup.deduplicated(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    found = pii.detect(docs, out="_spans")
    clean = found.withColumn("text", pii.sanitised(F.coalesce("text", F.lit("")), F.col("_spans")))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return mixing.repeated(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    coded = bpe.encode(docs, bpe_file(), bpe_pattern(), keep=["doc_id", "lang", "source"], decoded="decoded")
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality_stage), ("near_duplicates", near_duplicate_stage), ("pii", pii_stage), ("mix", mix_stage),
          ("bpe", bpe_stage)]

#: Fits, hashing and token ranks are beyond SQL; tests/llm holds every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
