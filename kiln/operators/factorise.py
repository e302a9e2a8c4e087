"""Matrix factorisation with biases, fitted together with the factors.

A rating is mean + user bias + item bias + p·q.  Alternating least squares: with the
items fixed, a user's bias and factors solve one small ridge system whose matrix is
the sum of the outer products of (1, q) over the user's ratings, and the other way
round.  The ratings of a side are shuffled by that side's key in chunks of a bounded
number; an ordinary user is one chunk and solved where it arrives, the partial sums of
a hot one are added up entry by entry with partial aggregation and solved after.  So
no task holds a hot user's ratings, and only sums of a fixed size are shuffled twice."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from kiln.session import clear_scratch, laid_out, scratch_mark, ship

#: Ratings of one user (or item) whose products are summed in one place.
CHUNK = 4_096
#: Rows of factors that every task may hold; sums that a task holds.
FEW, HELD = 8_192, 256


def solve(sums: np.ndarray, reg: float) -> np.ndarray:
    """(bias, factors) from the matrix [n, XᵀX | Xᵀy], penalty ``reg`` per rating."""
    d = int(len(sums) ** 0.5)  # 1 + d (d + 1) entries
    n, system = sums[0], sums[1:].reshape(d, d + 1)
    a = system[:, :-1] + reg * n * np.eye(len(system))
    return np.linalg.solve(a, system[:, -1])


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """[n, XᵀX | Xᵀy] of ratings y with rows x, flat."""
    return np.concatenate([[len(y)], np.column_stack([x.T @ x, x.T @ y]).ravel()])


def _combined(batches, width: int):
    """Ratings (id, c, n, v) of a task with one sum of products in place of those of an id
    that has more ratings in a batch than its sums have rows."""
    import pyarrow as pa
    held: dict = {}  # id: (c, n, sums)
    schema = None

    def flush():
        rows = [(key, *x) for key, x in held.items()]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], schema.field(i).type) for i in range(4)], schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        schema = batch.schema
        codes = batch.column(0).dictionary_encode()
        where = codes.indices.to_numpy()
        count = np.bincount(where)
        few = count[where] <= width
        if few.any():
            yield batch.filter(pa.array(few))
        v = batch.column(3).flatten().to_numpy().reshape(-1, width + 1)
        for g in np.flatnonzero(count > width):
            at, key = np.flatnonzero(where == g), codes.dictionary[int(g)].as_py()
            c, n, before = held.get(key) or (batch.column(1)[int(at[0])].as_py(), batch.column(2)[int(at[0])].as_py(), 0.0)
            held[key] = c, n, before + products(v[at, :-1], v[at, -1])
        if len(held) >= HELD:
            yield flush()
    if held:
        yield flush()


def half_step(rows: DataFrame, fixed: DataFrame, side: str, other: str, reg: float, width: int, few: bool = False) -> DataFrame:
    """New (id, w) of ``side`` (w: bias, factors) with those of ``other`` fixed.
    ``rows``: side, other, y (rating less the mean), <side>_chunks.

    ``few``: ``fixed`` has ``FEW`` rows at most; the ratings are dealt by ``side`` and meet
    it there, so its vectors are not shuffled with them.  Otherwise the ratings meet it
    first, and where many of one ``side`` are met together their sums are shuffled."""
    dealt = rows.select(F.col(side).alias("id"), F.col(other).alias("_o"), "y", F.pmod(F.xxhash64(other), F.col(f"{side}_chunks")).cast("int").alias("c"),
                        F.col(f"{side}_chunks").alias("n"))
    met = dealt.repartition("id", "c").join(F.broadcast(fixed.withColumnRenamed("id", "_f")), F.col("_o") == F.col("_f")) if few \
        else dealt.join(fixed.withColumnRenamed("id", "_f"), F.col("_o") == F.col("_f"))
    # 1, the factors, and what is left of the rating
    met = met.select("id", "c", "n", F.concat(F.array(F.lit(1.0)), F.slice("w", 2, width - 1), F.array(F.col("y") - F.col("w")[0])).alias("v"))
    if not few:
        met = met.mapInArrow(lambda batches: _combined(batches, width), met.schema).repartition("id", "c")
    met = met.sortWithinPartitions("id", "c")
    id_type = met.schema["id"].dataType
    out = T.StructType([T.StructField("id", id_type), T.StructField("w", T.ArrayType(T.DoubleType())), T.StructField("sums", T.ArrayType(T.DoubleType()))])

    def total(v, lengths):
        if (lengths == width + 1).all():
            x = v.reshape(-1, width + 1)
            return products(x[:, :-1], x[:, -1])
        ends = np.cumsum(lengths)
        parts = [v[e - n:e] for e, n in zip(ends, lengths)]
        x = np.array([p for p in parts if len(p) == width + 1]).reshape(-1, width + 1)
        return products(x[:, :-1], x[:, -1]) + sum(p for p in parts if len(p) != width + 1)

    def run(batches):
        import pyarrow as pa
        kept = None  # the last group may go on in the next batch
        for batch in chain((b for b in batches if b.num_rows), [None]):
            if batch is not None:
                ids, c, n = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
                offsets = batch.column(3).offsets.to_numpy()
                v, offsets = batch.column(3).flatten().to_numpy(), offsets - offsets[0]
                cuts = [0, *[i for i in range(1, len(ids)) if ids[i] != ids[i - 1] or c[i] != c[i - 1]], len(ids)]
                groups = [(ids[a], c[a], n[a], total(v[offsets[a]:offsets[b]], np.diff(offsets[a:b + 1]))) for a, b in zip(cuts, cuts[1:]) if b > a]
            else:
                groups = []
            if kept and groups and groups[0][:2] == kept[:2]:
                groups[0] = (*kept[:3], kept[3] + groups[0][3])
            elif kept:
                groups.insert(0, kept)
            kept = groups.pop() if groups and batch is not None else None
            if groups:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g in groups], to_arrow_type(id_type)),
                     pa.array([solve(g[3], reg) if g[2] == 1 else None for g in groups], pa.list_(pa.float64())),
                     pa.array([None if g[2] == 1 else g[3] for g in groups], pa.list_(pa.float64()))], names=out.names)

    parts = laid_out(met.mapInArrow(run, out), "factors")
    sums = (parts.filter("sums IS NOT NULL").select("id", F.posexplode("sums").alias("at", "v")).groupBy("id", "at").agg(F.sum("v").alias("v"))
            .groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda s: s["v"]).alias("sums")))

    def finish(batches):
        import pyarrow as pa
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([solve(np.array(s), reg) for s in batch.column(1).to_pylist()], pa.list_(pa.float64()))],
                                             names=["id", "w"])

    hot = laid_out(sums.mapInArrow(finish, T.StructType(out.fields[:2])), "hot-factors")
    return parts.filter("w IS NOT NULL").select("id", "w").unionByName(hot)


@dataclass
class Biased:
    """A fitted model: the mean, and (id, w) of users and items, w = bias, factors."""
    mean: float
    users: DataFrame
    items: DataFrame

    def predict(self, pairs: DataFrame, user: str, item: str, out: str = "est", lo: float = 1.0, hi: float = 5.0) -> DataFrame:
        """``pairs`` plus ``out``, clipped; an unknown user or item has no bias and no factors."""
        u = self.users.select(F.col("id").alias("_uid"), F.col("w").alias("_uw"))
        i = self.items.select(F.col("id").alias("_iid"), F.col("w").alias("_iw"))
        both = pairs.join(u, F.col(user) == F.col("_uid"), "left").join(i, F.col(item) == F.col("_iid"), "left")
        dot = F.aggregate(F.zip_with(F.slice("_uw", 2, F.size("_uw")), F.slice("_iw", 2, F.size("_iw")), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        est = F.lit(self.mean) + F.coalesce(F.col("_uw")[0], F.lit(0.0)) + F.coalesce(F.col("_iw")[0], F.lit(0.0)) + F.coalesce(dot, F.lit(0.0))
        return both.withColumn(out, F.least(F.greatest(est, F.lit(lo)), F.lit(hi))).select(*pairs.columns, out)


def start(key: Column, rank: int) -> Column:
    """Bias 0 and seeded factors in ±0.1, from a hash of the key."""
    noise = [(F.pmod(F.xxhash64(key, F.lit(k)), F.lit(2001)) - 1000) / 10_000.0 for k in range(rank)]
    return F.array(F.lit(0.0), *noise)


def biased_factors(ratings: DataFrame, user: str, item: str, rating: str, rank: int = 50, reg: float = 0.05, rounds: int = 8) -> Biased:
    """Fit on ratings (rows with a null take no part); ids of any type."""
    spark = ratings.sparkSession
    ship(spark)
    r = ratings.select(F.col(user).alias("user"), F.col(item).alias("item"), F.col(rating).cast("double").alias("r")).dropna()
    mean = r.select(F.avg("r")).first()[0] or 0.0
    rows = r.withColumn("y", F.col("r") - mean).drop("r")
    for side in ("user", "item"):
        size = r.groupBy(F.col(side).alias("_id")).agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias(f"{side}_chunks"))
        rows = rows.join(size, F.col(side) == F.col("_id")).drop("_id")
    rows = laid_out(rows, "ratings")
    items = laid_out(rows.select(F.col("item").alias("id")).distinct().withColumn("w", start(F.col("id"), rank)), "start")
    few_items = items.limit(FEW + 1).count() <= FEW
    few_users = rows.select("user").distinct().limit(FEW + 1).count() <= FEW
    users, first = None, scratch_mark(spark)
    for _ in range(rounds):
        done = scratch_mark(spark)
        users = half_step(rows, items, "user", "item", reg, rank + 1, few_items)
        items = half_step(rows, users, "item", "user", reg, rank + 1, few_users)
        clear_scratch(spark, first, done)  # the round before
    return Biased(mean, users, items)
