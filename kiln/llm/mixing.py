"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a budget of words.  Whole copies of the source go in while
they fit (every document once, twice, ...); the rest of the budget is fitted
on the counts of documents by exact length: a proportional share of each
length and one more of some lengths in seeded order, both again over what is
still free and fits until few words are left, and for the last words a
bounded-knapsack dynamic programme over the documents still free, which meets
the budget exactly whenever some subset does.  Documents are then picked by
count and length in seeded hash order.

Rules: size = number of words (null or empty text: 0, such documents take no
words and no copies); sources in code-point order weigh 1, 2, 3, 1, ...; a null
source is a source, the last one; targets share all words by weight and stop
at 3 times their source's words, the excess is reshared by weight; equal
(document, source, size) rows are counted first, so much repeated rows do not
meet in one task; reruns agree; an empty table gives an empty result."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import WORD, expand, materialize
from kiln.llm.sharding import CELL, starts
from kiln.plans.ordering import global_row_number

CAP, CYCLE, SEED, WINDOW = 3, 3, 17, 65_536


def n_words(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """``source_size`` per source -> plus ``target``.  Water filling: the common
    level (words per weight) rises until no source is above its cap; every
    round is one aggregate over the table of sources."""
    ranked = materialize(global_row_number(sizes, [F.col("source").asc_nulls_last()], out="_rn", num_partitions=8)
                         .withColumn("weight", (F.col("_rn") % CYCLE + 1).cast("long")).drop("_rn"), "mix-sources")
    level, total = None, ranked.agg(F.sum("source_size")).first()[0] or 0
    while True:
        full = F.lit(False) if level is None else CAP * F.col("source_size") < F.lit(level) * F.col("weight")
        row = ranked.agg(F.sum(F.when(full, CAP * F.col("source_size"))).alias("used"),
                         F.sum(F.when(~full, F.col("weight"))).alias("w")).first()
        now = (total - (row["used"] or 0)) / row["w"] if row["w"] else level or 0.0
        if level is not None and now <= level:
            break
        level = now
    return ranked.withColumn("target", F.least((CAP * F.col("source_size")).cast("double"),
                                               F.lit(float(level)) * F.col("weight")))


def subset_sum(items: list[tuple[int, int]], budget: int) -> dict[int, int]:
    """How many of each length (length, count) make the largest sum <= budget:
    bounded knapsack on a bit set, with the step that first reached each sum."""
    import numpy as np
    mask, reach = (1 << (budget + 1)) - 1, 1
    by, copies = np.zeros(budget + 1, np.int64), np.zeros(budget + 1, np.int64)
    for length, count in items:
        if reach >> budget & 1:
            break
        if not 0 < length <= budget:
            continue
        moved = reach
        for j in range(1, min(count, budget // length) + 1):
            moved = (moved << length) & mask
            new = moved & ~reach
            if new:
                at = np.flatnonzero(np.unpackbits(np.frombuffer(new.to_bytes(budget // 8 + 1, "little"), np.uint8),
                                                  bitorder="little"))
                by[at], copies[at] = length, j
                reach |= new
            elif not moved:
                break
    at, out = reach.bit_length() - 1, {}
    while at:
        out[int(by[at])] = out.get(int(by[at]), 0) + int(copies[at])
        at -= int(by[at] * copies[at])
    return out


def fit(lengths: list[int], counts: list[int], budget: int, seed: str) -> list[int]:
    """How many documents of each length to add so that their words come to ``budget``
    (less than all words): share and one more in seeded order until WINDOW words are
    left or no free document fits, then knapsack."""
    take, rest = [0] * len(lengths), budget
    order = sorted(range(len(lengths)), key=lambda i: hashlib.blake2b(f"{seed}:{lengths[i]}".encode(), digest_size=8).digest())
    while True:
        # what is free and fits shares the rest; lengths too long for it drop out, so the turns end
        open_ = [i for i in order if take[i] < counts[i] and 0 < lengths[i] <= rest]
        words = sum(lengths[i] * (counts[i] - take[i]) for i in open_)
        if not open_:
            break
        part = min(rest, words)
        for i in open_:
            more = (counts[i] - take[i]) * part // words
            take[i], rest = take[i] + more, rest - more * lengths[i]
        for i in open_:
            if rest <= WINDOW:
                break
            if take[i] < counts[i] and lengths[i] <= rest:
                take[i], rest = take[i] + 1, rest - lengths[i]
        if rest <= WINDOW:
            break
    if rest:
        more = subset_sum([(lengths[i], counts[i] - take[i]) for i in order if counts[i] > take[i]], min(rest, WINDOW))
        take = [k + more.get(n, 0) for n, k in zip(lengths, take)]
    return take


def plan(hist: DataFrame, sources: DataFrame, seed: int = SEED) -> DataFrame:
    """Per (source, size): ``whole`` copies of every document and ``extra``
    documents with one more.  A source's group holds one row per length."""
    def run(rows):
        rows = rows.sort_values("size")
        lengths, counts = [int(x) for x in rows["size"]], [int(x) for x in rows["n"]]
        words, budget = int(rows["source_size"].iloc[0]), int(rows["target"].iloc[0])
        whole, rest = divmod(budget, words) if words else (0, 0)
        rows["whole"] = whole
        rows["extra"] = fit(lengths, counts, rest, f"{seed}:{rows['skey'].iloc[0]}")
        return rows[["skey", "size", "n", "source_size", "target", "whole", "extra"]]

    return (hist.join(sources.select(_skey().alias("skey"), "source_size", "target"), "skey")
            .groupBy("skey").applyInPandas(run, "skey string, size long, n long, source_size long, target double, "
                                                "whole long, extra long"))


def _skey():
    """A non-null text for a source; the null source has the only empty one."""
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """Per distinct (key, source, size): ``rows`` of them, the number ``more`` of
    them that go in ``whole`` + 1 times, the others ``whole`` times; with
    ``source_size`` and ``target`` of the source."""
    keys = (docs.select(F.col(key).alias("_key"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"))
            .groupBy("_key", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("skey", _skey()))
    keys = materialize(keys, "mix-keys")
    hist = materialize(keys.groupBy("skey", "source", "size").agg(F.sum("rows").alias("n")), "mix-lengths")
    sources = targets(hist.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")))
    chosen = plan(hist.drop("source"), sources, seed)
    sized = keys.join(chosen, ["skey", "size"])
    ranked = starts(sized, ["skey", "size"], F.floor(F.col("n") / CELL) + 1, [F.xxhash64(F.lit(seed), "_key"), "_key"], "rows", "_at")
    more = F.greatest(F.lit(0), F.least(F.col("rows"), F.col("extra") - F.col("_at")))
    return ranked.select(F.col("_key").alias(key), "source", "size", "rows", "whole", more.cast("long").alias("more"),
                         "source_size", "target")


def taken(mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document row: its ``copies`` and the words ``taken``."""
    halves = mixed.withColumn("_p", F.explode(F.array(
        F.struct(F.col("more").alias("k"), (F.col("whole") + 1).alias("copies")),
        F.struct((F.col("rows") - F.col("more")).alias("k"), F.col("whole").alias("copies")))))
    halves = halves.select(key, "source", "size", "source_size", "target", "_p.k", "_p.copies")
    return expand(halves, "k", "_i").select(key, "source", "size", "source_size", "target", "copies",
                                            (F.col("copies") * F.col("size")).alias("taken"))


def repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """The mixed corpus itself: every document of ``docs`` as often as it goes in."""
    mixed = materialize(mix(docs, key, text, source, seed).select(
        F.col(key).alias("_k"), F.col("source").alias("_s"), F.col("size").alias("_z"), "rows", "whole", "more"), "mixed")
    met = (docs.select(F.struct(*docs.columns).alias("_row"), F.col(key).alias("_key"), F.col(source).alias("_source"),
                       n_words(F.col(text)).alias("_size"))
           .join(mixed, F.col("_key").eqNullSafe(F.col("_k")) & F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_size") == F.col("_z"))))
    copies = F.col("whole") + (F.col("more") > 0).cast("long")
    parted = (F.col("more") > 0) & (F.col("more") < F.col("rows"))  # equal rows of which only some go in once more
    out = met.filter(~parted)
    if not mixed.filter(parted).isEmpty():
        nth = F.row_number().over(Window.partitionBy("_k", "_s", "_z").orderBy(F.lit(0)))
        some = met.filter(parted).withColumn("_nth", nth).withColumn("more", (F.col("_nth") <= F.col("more")).cast("long"))
        out = out.unionByName(some.drop("_nth"))
    return out.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies.cast("int")))).select("_row.*")
