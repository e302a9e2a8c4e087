"""Stream new transaction files into the history table, exactly once.

* The file source records processed files in the checkpoint, so a file is read once.
* Rows already in the history (e.g. a batch delivered again under a new
  name) are removed by a ``left_anti`` join against the history table itself:
  the deduplication state lives in storage, not in a growing state store.
* The history is partitioned by ``month`` of the event column, and each
  micro-batch reads only the month partitions its own rows touch (partition
  pruning with the batch's distinct months, bounded by the calendar), so the
  cost of a batch follows the batch, not the size of the history.
* Each micro-batch writes partitions ``month=…/run_id=…/batch_id=N`` with
  dynamic partition overwrite, so a batch replayed after a failure rewrites
  exactly its own output (idempotent).  The run id is stored in the checkpoint
  folder: a second stream into the same history, or one whose checkpoint was
  lost and whose batches count from 0 again, writes beside the first.
* Keys are compared null-safely: a row with a null key that is delivered again
  is known, too."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.sources.files import known_rows, read_if_there

LAYOUT = "month DATE, run_id STRING, batch_id BIGINT"


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that lives and dies with the checkpoint folder."""
    path = os.path.join(checkpoint, "run_id")
    there = read_if_there(lambda: spark.read.text(path))
    if there is None:
        spark.range(1).select(F.lit(uuid.uuid4().hex).alias("value")).write.text(path)
        there = spark.read.text(path)
    return there.first()[0]


def ingest_files(spark: SparkSession, landing: str, history: str, checkpoint: str, schema: str,
                 event_col: str, keys: list[str] | None = None, files_per_trigger: int = 1):
    """Start the ingestion stream (``availableNow``: process what is there, then stop)."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
              .parquet(landing))
    cols = [c.strip().split()[0] for c in schema.split(",")]
    keys = keys or cols
    run = _run_id(spark, checkpoint)

    def merge(batch: DataFrame, batch_id: int) -> None:
        b = batch.dropDuplicates(keys).withColumn("month", F.trunc(F.to_date(event_col), "month"))
        hist = read_if_there(lambda: spark.read.schema(f"{schema}, {LAYOUT}").parquet(history))
        if hist is not None:
            months = [r[0] for r in b.select("month").distinct().collect()]  # calendar-bounded
            here = F.col("month").isin([m for m in months if m is not None])
            if None in months:
                here = F.coalesce(here, F.lit(False)) | F.col("month").isNull()
            own = (F.col("run_id") == run) & (F.col("batch_id") == batch_id)
            b = known_rows(b, hist.filter(here & ~own), [*keys, "month"], "left_anti")
        (b.withColumns({"run_id": F.lit(run), "batch_id": F.lit(batch_id).cast("long")}).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("month", "run_id", "batch_id").parquet(history))

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_history(spark: SparkSession, history: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, {LAYOUT}").parquet(history).drop("month", "run_id", "batch_id")
