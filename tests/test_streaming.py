"""Streaming properties: late rows are dropped after the watermark (S2) and
ingestion is idempotent and exactly-once (S1)."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from kiln.streaming import ingest, windows

SCHEMA = "ts TIMESTAMP_NTZ, k STRING, v DOUBLE"


def _write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(path)


def test_weekly_windows_drop_late_rows(spark):
    base = tempfile.mkdtemp(prefix="kiln-s2-")
    land = os.path.join(base, "land")
    d = dt.datetime
    _write(spark, os.path.join(land, "f0"), [(d(2024, 1, 1, 1), "a", 1.0), (d(2024, 1, 2), "a", 2.0)])   # week of Jan 1
    _write(spark, os.path.join(land, "f1"), [(d(2024, 1, 10), "a", 4.0)])      # moves the watermark to Jan 9
    _write(spark, os.path.join(land, "f2"), [(d(2024, 1, 11), "a", 5.0)])      # week of Jan 1 is emitted
    _write(spark, os.path.join(land, "f3"), [(d(2024, 1, 3), "a", 100.0)])     # late: older than the watermark
    _write(spark, os.path.join(land, "f4"), [(d(2024, 1, 20), "a", 8.0)])      # closes the week of Jan 8
    tz = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(os.path.join(land, "*"))
        out = os.path.join(base, "out")
        q = (windows.weekly_totals(stream, "ts", "k", "v").writeStream.format("parquet").outputMode("append")
             .option("path", out).option("checkpointLocation", os.path.join(base, "ck")).trigger(availableNow=True)
             .start())
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.session.timeZone", tz)
    got = {(str(r.window_start)[:10], r.total) for r in spark.read.parquet(out).collect()}
    # Spark drops rows older than the previous batch's watermark: the late 100.0 is not counted
    assert got == {("2024-01-01", 3.0), ("2024-01-08", 9.0)}


def test_ingest_exactly_once_and_idempotent(spark):
    base = tempfile.mkdtemp(prefix="kiln-s1-")
    land = os.path.join(base, "land")
    d = dt.datetime
    rows0 = [(d(2024, 1, 1), "a", 1.0), (d(2024, 1, 1), "a", 1.0), (d(2024, 2, 1), "b", 2.0)]
    rows1 = [(d(2024, 2, 1), "b", 2.0), (d(2024, 3, 1), "c", 3.0)]   # one row delivered again
    _write(spark, os.path.join(land, "f0"), rows0)
    _write(spark, os.path.join(land, "f1"), rows1)
    _write(spark, os.path.join(land, "f2"), rows0)                   # whole file re-sent under a new name
    hist = os.path.join(base, "hist")
    for run in range(2):  # the second run has a fresh checkpoint: every file is seen again
        q = ingest.ingest_files(spark, os.path.join(land, "*"), hist, os.path.join(base, f"ck{run}"), SCHEMA, "ts")
        q.awaitTermination()
        got = sorted((str(r.ts), r.k, r.v) for r in ingest.read_history(spark, hist, SCHEMA).collect())
        assert got == [("2024-01-01 00:00:00", "a", 1.0), ("2024-02-01 00:00:00", "b", 2.0),
                       ("2024-03-01 00:00:00", "c", 3.0)]


def _land(spark, path, rows):
    spark.createDataFrame(rows, "k long, ts timestamp, v double").coalesce(1).write.parquet(path)


SCHEMA3 = "k BIGINT, ts TIMESTAMP, v DOUBLE"


def _ingest(spark, land, hist, ckpt):
    from kiln.streaming.ingest import ingest_files, read_history
    ingest_files(spark, land, hist, ckpt, SCHEMA3, "ts").awaitTermination()
    return sorted((r["k"] is None, r["k"], r["v"]) for r in read_history(spark, hist, SCHEMA3).collect())


def test_two_landings_into_one_history_and_null_keys(spark, tmp_path):
    import datetime as dt
    jan = dt.datetime(2024, 1, 5)
    a, b, hist = (str(tmp_path / n) for n in ("a", "b", "hist"))
    _land(spark, f"{a}/1", [(1, jan, 1.0), (None, jan, 9.0), (7, None, 7.0)])
    first = _ingest(spark, f"{a}/*", hist, str(tmp_path / "ca"))
    assert first == [(False, 1, 1.0), (False, 7, 7.0), (True, None, 9.0)]
    _land(spark, f"{b}/1", [(2, jan, 2.0), (None, jan, 9.0), (7, None, 7.0)])
    both = [(False, 1, 1.0), (False, 2, 2.0), (False, 7, 7.0), (True, None, 9.0)]
    assert _ingest(spark, f"{b}/*", hist, str(tmp_path / "cb")) == both
    # a lost checkpoint: batches count from 0 again, old and new files are there
    _land(spark, f"{a}/2", [(3, jan, 3.0)])
    assert _ingest(spark, f"{a}/*", hist, str(tmp_path / "lost")) == sorted([*both, (False, 3, 3.0)])


def test_absent_means_path_not_found_only(spark, tmp_path):
    import pytest
    from pyspark.errors import AnalysisException
    from kiln.sources.files import extend_history, union_sources
    good = str(tmp_path / "good")
    spark.range(3).write.parquet(good)
    assert union_sources(spark, [good, str(tmp_path / "none")]).count() == 3
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        union_sources(spark, [good, str(tmp_path / "empty")])
    h = spark.createDataFrame([(1, "a"), (None, "b")], "k long, v string")
    assert extend_history(h, h, ["k"]).count() == 2
