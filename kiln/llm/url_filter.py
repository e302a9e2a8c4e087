"""URL filter: a blocked Bloom filter of the listed canonical URLs lets
possible hits through to an exact hash join, which removes false positives.

A rule (verdict, host, path) fits its host and all subdomains of it when the
URL's path starts with the rule's path.  A URL therefore has one candidate key
per *shape* (labels of the rule's host, length of the rule's path) that the
list holds; the candidates are probed in the filter and only hits are joined.

Rules: a null URL, or one without ``://``, has an empty host and path; the
longest rule wins (host and path together, then the host, then ``block``);
URLs that no rule fits get ``default``; repeated rows are judged each on its
own; other columns pass through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import ascii_lower

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
BITS_PER_KEY, MAX_BLOCKS = 16, 1 << 23  # at most 64 MB of filter; a longer list only gets more false hits to join away


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(key, F.lit(blocks))


def _mask(key: Column) -> Column:
    """Four bits of a 64-bit block, taken from a second hash of the key."""
    h = F.xxhash64(key, F.lit("bits"))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, s).bitwiseAND(F.lit(63)).cast("int"))
            for s in (0, 6, 12, 18)]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> Column:
    """The filter of a column of 64-bit keys as a scalar array<bigint>, one
    block of 64 bits per element.  Partial OR on the map side; its size is
    fixed by ``blocks``."""
    words = keys.groupBy(_block(F.col(key), blocks).alias("_b")).agg(F.bit_or(_mask(F.col(key))).alias("_w"))
    filled = (keys.sparkSession.range(blocks).join(words, F.col("id") == F.col("_b"), "left")
              .agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("_w", F.lit(0).cast("long")).alias("w")))).alias("_a")))
    return filled.select(F.col("_a.w").alias("_a")).scalar()


def judge(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``df`` plus host, path, rule (``host`` + ``path``, null if none fits) and verdict.

    ``rules``: verdict, host, path.  A third of all rows may share a host: the
    side that repeats is the long one of an outer join, which Spark splits, and
    a row's hits meet again under its row number, never under its host."""
    listed = (rules.select(ascii_lower(F.col("host")).alias("r_host"), F.col("path").alias("r_path"),
                           F.col("verdict").alias("r_verdict"))
              .filter("r_host IS NOT NULL AND r_path IS NOT NULL"))
    listed = listed.groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict"))
    shapes = listed.select(_labels(F.col("r_host")).alias("k"), F.length("r_path").alias("n"))
    found = shapes.groupBy("k", "n").agg(F.count(F.lit(1)).alias("c")).collect()  # bounded by URL lengths, not by the list
    names = [c for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    rows = (df.select(F.struct(*names).alias("_row"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
            .withColumn("_rid", F.monotonically_increasing_id()))
    if found:
        blocks = max(1, min(MAX_BLOCKS, -(-sum(r["c"] for r in found) * BITS_PER_KEY // 64)))
        bloom = bloom_filter(listed.select(F.xxhash64("r_host", "r_path").alias("_k")), "_k", blocks)
        tries = []
        for r in found:
            suffix, prefix = F.substring_index("host", ".", -r["k"]), F.left(F.col("path"), F.lit(r["n"]))
            key = F.xxhash64(suffix, prefix)
            word, mask = F.element_at(bloom, (_block(key, blocks) + 1).cast("int")), _mask(key)
            fits = (_labels(F.col("host")) >= r["k"]) & (F.length("path") >= r["n"])
            tries.append(F.when(fits & (word.bitwiseAND(mask) == mask), F.struct(suffix.alias("r_host"), prefix.alias("r_path"))))
        rows = rows.withColumn("_hit", F.explode_outer(F.array_compact(F.array(*tries))))
        rows = rows.select("_rid", "_row", "host", "path", "_hit.r_host", "_hit.r_path")
    else:
        rows = rows.withColumns({"r_host": F.lit(None).cast("string"), "r_path": F.lit(None).cast("string")})
    exact = rows.join(listed, ["r_host", "r_path"], "left")
    rule = F.when(F.col("r_verdict").isNotNull(), F.struct(
        (F.length("r_host") + F.length("r_path")).alias("n"), F.length("r_host").alias("h"),
        F.col("r_verdict").alias("verdict"), F.concat("r_host", "r_path").alias("rule")))
    best = exact.groupBy("_rid").agg(F.first("_row").alias("_row"), F.first("host").alias("host"),
                                     F.first("path").alias("path"), F.max(rule).alias("_best"))
    return best.select("_row.*", "host", "path", F.col("_best.rule").alias("rule"),
                       F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))
