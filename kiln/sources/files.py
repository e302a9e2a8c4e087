"""File sources and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.functions.dates import parse_dmy2


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, header: bool = True) -> str:
    """A4: write parquet / CSV / JSON, optionally partitioned (one folder per value)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", header)
    if fmt in ("csv", "json"):  # keep microseconds
        w = w.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: str, dmy2_dates: tuple[str, ...] = (),
             header: bool = True) -> DataFrame:
    """A2: CSV with a declared schema; columns listed in ``dmy2_dates`` are read
    as text and parsed as ``dd/MM/yy`` with the two-digit-year pivot."""
    fields = [f.strip() for f in schema.split(",")]
    raw_schema = ", ".join(f"{f.split()[0]} STRING" if f.split()[0] in dmy2_dates else f for f in fields)
    df = spark.read.schema(raw_schema).option("header", header).option("mode", "PERMISSIVE").csv(path)
    for c in dmy2_dates:
        df = df.withColumn(c, parse_dmy2(F.col(c)))
    return df


def read_json(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """A3: JSON lines, or a JSON array of records when ``multi_line``."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def known_rows(new: DataFrame, known: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Semi or anti join on ``keys``, null-safe: a null key equals a null key."""
    other = known.select(*[F.col(k).alias(f"_known_{i}") for i, k in enumerate(keys)])
    return new.join(other, [new[k].eqNullSafe(other[f"_known_{i}"]) for i, k in enumerate(keys)], how)


def read_if_there(read) -> DataFrame | None:
    """``read()``, or None when its path does not exist; any other error is the caller's."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def extend_history(history: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """A5: history ∪ the new rows whose key is not in history yet (idempotent:
    re-running with the same batch adds nothing, null keys included)."""
    return history.unionByName(known_rows(new, history, keys, "left_anti"))


def union_sources(spark: SparkSession, paths: list[str], fmt: str = "parquet") -> DataFrame | None:
    """Union of whichever sources exist, columns aligned by name (a column
    missing in one source is null there); None when no source exists.  Only a
    path that does not exist counts as absent."""
    found = [read_if_there(lambda p=p: spark.read.format(fmt).load(p)) for p in paths]
    frames = [f for f in found if f is not None]
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def contract_violations(df: DataFrame, required: list[str], keys: list[str],
                        casts: dict[str, str] | None = None, per_file: bool = False) -> DataFrame:
    """Input contract check. Missing required columns are an error (schema
    only, no job); then one aggregate counts null keys and failed casts — per
    input file when ``per_file`` (``_metadata.file_path`` of a file scan)."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    casts = casts or {}
    exprs = [F.count(F.lit(1)).alias("n_rows")]
    exprs += [F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys]
    exprs += [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(f"badcast_{c}")
              for c, t in casts.items()]
    if per_file:
        return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(*exprs)
    return df.agg(*exprs)
