"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of the ring; a key belongs to the shard of
the first point clockwise from its hash (its home).  No shard takes more than
its quota, and the quotas differ by one row at most and sum to the row count:
what overflows a full shard continues clockwise to the next shard with room.
So the law is ``rows``, exactly, and only overflow leaves its home.

Keys between two neighbouring points (an *arc*) share their clockwise order of
shards, so the overflow is settled on row counts per arc: one number for each
of shards x vnodes arcs, whatever the data.  Rows then take the places of
their arc by their rank in it, in hash order; ranks come from cells of about
``CELL`` rows, so neither a shard nor a hot arc is ever one window.

Rules: rows are (key, size, CRC) triples, equal ones counted before anything
is shuffled further and expanded at the end, so one key with a third of all
rows spreads over tasks and, past the quota, over shards; a null key is a key
of its own; a null text has size 1 and the CRC of no bytes; reruns agree; an
empty table gives an empty result."""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import expand, long_array, materialize, small_table

VNODES, POINTS, CELL = 128, 1 << 16, 500


def ring(shards: int, vnodes: int = VNODES, points: int = POINTS) -> tuple[list[int], list[int]]:
    """(arc of each ring point, shard of each arc); of two virtual nodes on one
    point the smaller shard stays."""
    at: dict[int, int] = {}
    for s in range(shards):
        for v in range(vnodes):
            h = hashlib.blake2b(f"{s}:{v}".encode(), digest_size=8).digest()
            at.setdefault(int.from_bytes(h, "big") % points, s)
    taken = sorted(at)
    return [bisect_left(taken, p) % len(taken) for p in range(points)], [at[p] for p in taken]


def quotas(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def settle(counts: list[int], owner: list[int], quota: list[int]) -> list[dict]:
    """Intervals [lo, hi) of each arc's ranks, with the shard and first slot they take.

    Every arc offers its unplaced rows to the next shard clockwise that has
    room; a shard that is offered more than its room shares it in proportion.
    Each round places all or fills a shard, so there are at most shards + 1."""
    n, free, left, placed = len(owner), list(quota), list(counts), [0] * len(owner)
    step, out, slot = [0] * n, [], [0] * len(quota)
    while any(left):
        offers: dict[int, list[int]] = {}
        for a in range(n):
            if left[a]:
                while not free[owner[(a + step[a]) % n]]:
                    step[a] += 1
                offers.setdefault(owner[(a + step[a]) % n], []).append(a)
        for s, arcs in offers.items():
            want, room = sum(left[a] for a in arcs), free[s]
            give = {a: left[a] if want <= room else room * left[a] // want for a in arcs}
            spare = min(want, room) - sum(give.values())
            for a in arcs:
                extra = min(spare, left[a] - give[a], 1)
                spare -= extra
                got = give[a] + extra
                if got:
                    passed = {owner[(a + i) % n] for i in range(step[a])}
                    out.append({"arc": a, "lo": placed[a], "hi": placed[a] + got, "shard": s, "slot0": slot[s],
                                "hops": len(passed)})
                    placed[a], left[a], free[s], slot[s] = placed[a] + got, left[a] - got, free[s] - got, slot[s] + got
    return out


def starts(keys: DataFrame, group: list[str], cells: Column, order: list, weight: str, out: str) -> DataFrame:
    """The number of rows before each row in its group, each row counting
    ``weight``: rows go to ``cells`` hash cells of the group, ranked inside a
    cell by a window and offset by the cells before it."""
    spread = F.xxhash64(*order)
    celled = keys.withColumn("_cell", F.pmod(spread, cells)).repartition(*group, "_cell")  # else an earlier split by group would do
    sizes = celled.groupBy(*group, "_cell").agg(F.sum(weight).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*group, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*group, "_cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (celled.join(offsets, [*group, "_cell"])
            .withColumn(out, F.col("_off") + F.sum(weight).over(inside) - F.col(weight)).drop("_cell", "_off"))


def assign(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text", vnodes: int = VNODES) -> DataFrame:
    """One row per row of ``df``: the key, ``size`` (UTF-8 bytes + 1),
    ``text_crc32``, ``shard``, ``slot`` (gapless in the shard), ``home_shard``
    and ``hops`` (full shards passed)."""
    spark = df.sparkSession
    arc_of, owner = ring(shards, vnodes)
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    point = F.pmod(F.xxhash64(F.col(key)), F.lit(POINTS)) + 1
    keys = (df.select(F.col(key).alias("_key"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
                      F.element_at(long_array(arc_of), point.cast("int")).alias("arc"))
            .groupBy("_key", "size", "text_crc32", "arc").agg(F.count(F.lit(1)).alias("_m")))
    keys = materialize(keys, "shard-keys")
    per_arc = {r["arc"]: r["n"] for r in keys.groupBy("arc").agg(F.sum("_m").alias("n")).collect()}  # at most shards x vnodes
    counts = [per_arc.get(a, 0) for a in range(len(owner))]
    cells = F.element_at(long_array(c // CELL + 1 for c in counts), (F.col("arc") + 1).cast("int"))
    ranked = starts(keys, ["arc"], cells, [F.xxhash64("_key"), "_key", "size", "text_crc32"], "_m", "_at")
    plan = small_table(spark, settle(counts, owner, quotas(sum(counts), shards)),
                       "arc: bigint, lo: bigint, hi: bigint, shard: int, slot0: bigint, hops: int")
    from_, upto = F.greatest("_at", "lo"), F.least(F.col("_at") + F.col("_m"), F.col("hi"))
    pieces = (ranked.join(F.broadcast(plan), "arc")  # bounded: two or three intervals per arc
              .filter((F.col("_at") < F.col("hi")) & (F.col("_at") + F.col("_m") > F.col("lo")))
              .withColumns({"_slot": F.col("slot0") + from_ - F.col("lo"), "_k": upto - from_}))
    home = F.element_at(long_array(owner), (F.col("arc") + 1).cast("int")).cast("int")
    return expand(pieces, "_k", "_i").select(
        F.col("_key").alias(key), "size", "text_crc32", "shard", (F.col("_slot") + F.col("_i")).alias("slot"),
        home.alias("home_shard"), "hops")
