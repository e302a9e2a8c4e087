"""Exact top-k inner-product search with MaxScore over integer vectors.

A vector is a document whose terms are its dimensions, split by sign: the
posting list of (dimension, +) holds the vectors with a positive value there,
that of (dimension, -) the ones with a negative value.  For a query the lists
on which a product is positive are its terms, and a term's bound is the
query's weight times the largest weight of the list; the opposite lists only
lower a score (bound 0).

Vectors are dealt to shards of about ``SHARD`` rows and queries to blocks of
``BLOCK``; every block meets every shard (a stated query set against all
rows).  In a shard, per query:

1. the documents at the head of the query's strongest lists are scored in full;
   their k-th best score is the first threshold;
2. terms are ordered by bound; the longest tail whose bounds sum to less than
   the threshold is non-essential: a document that occurs on no essential list
   cannot compete;
3. essential postings are traversed and summed;
4. the other dimensions are probed in order of weight for the documents that
   stay competitive (score so far + bounds still to come >= threshold).

Shard results are merged by a ranked window per query.  Nothing is
approximate: a document is left only when its bound is below k known scores.

Rules: vectors that are null, hold a null or a non-finite component, or are
empty take no part, as rows or as queries; vectors of other lengths count as
padded with zeros; a query's own id is no candidate; equal rows (id and
vector) count once; ties go to the smaller id; fewer than k candidates give
all of them; an empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD, BLOCK, HEAD = 4096, 4096, 64


def quantized(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, null where the vector takes no part."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when((F.size(x) > 0) & ~bad, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


class Postings:
    """The signed posting lists of one shard, heaviest weights first for the head."""

    def __init__(self, vectors):
        import numpy as np
        self.v = vectors
        self.columns = np.ascontiguousarray(vectors.T)
        self.lists, self.most = [], []
        for col in self.columns:
            both = []
            for sign in (1, -1):
                at = np.flatnonzero(col * sign > 0)
                both.append((at, col[at], at[np.argsort(-np.abs(col[at]), kind="stable")[:HEAD]]))
            self.lists.append(both)
            self.most.append([np.abs(w).max() if len(w) else 0 for _, w, _ in both])

    def search(self, q, k: int, own, ids):
        """Row numbers and scores of the k best vectors for ``q``, ids unequal ``own``."""
        import numpy as np
        dims = np.flatnonzero(q)
        out = ids != own
        bound = np.array([abs(q[d]) * self.most[d][int(q[d] < 0)] for d in dims], dtype=self.v.dtype)
        order = dims[np.argsort(-bound, kind="stable")]
        bound = np.sort(bound)[::-1]
        rest = np.concatenate([np.cumsum(bound[::-1])[::-1], [0]])  # bounds of the terms from here on
        heads = [self.lists[d][int(q[d] < 0)][2] for d in order[:4]]
        some = np.unique(np.concatenate(heads)) if heads else np.empty(0, np.int64)
        some = some[out[some]]
        best = np.sort(self.v[some] @ q)[::-1]
        least = best[k - 1] if len(best) >= k else None
        # the essential terms: as many of the strongest as it takes for the tail to fall below the threshold
        essential = len(order) if least is None or least <= 0 else int(np.argmax(rest < least))
        score, seen = np.zeros(len(self.v), self.v.dtype), np.zeros(len(self.v), bool)
        for d in order[:essential]:
            side = int(q[d] < 0)
            at, w, _ = self.lists[d][side]
            score[at] += q[d] * w
            seen[at] = True
            at, w, _ = self.lists[d][1 - side]  # the opposite list only lowers scores
            score[at] += q[d] * w
        if least is None or least <= 0:
            seen[:] = True
        live = np.flatnonzero(seen & out)
        score = score[live]
        for i in range(essential, len(order)):
            if least is not None:
                stay = score + rest[i] >= least
                live, score = live[stay], score[stay]
            score = score + q[order[i]] * self.columns[order[i]][live]
        if len(score) > k:
            cut = np.partition(score, len(score) - k)[len(score) - k]
            live, score = live[score >= cut], score[score >= cut]
        top = np.lexsort((ids[live], -score))[:k]
        return live[top], score[top]


def _matrix(table, column: str):
    """(ids, integer matrix) of an Arrow table; short vectors padded with zeros."""
    import numpy as np
    flat = table.column(column).combine_chunks()
    ends = flat.offsets.to_numpy()
    size = np.diff(ends)
    out = np.zeros((len(size), int(size.max(initial=0))), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(ends[-1] - ends[0]) - np.repeat(ends[:-1] - ends[0], size)] = \
        flat.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
    return table.column("vec_id").to_numpy(), out


def _upto(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(max(1, n) - 1).cast("long"))


def top_k(df: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
          scale: int = 256, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k best rows for every query row."""
    rows = (df.select(F.col(key).cast("long").alias("vec_id"), is_query.alias("_q"), quantized(F.col(vector), scale).alias("v"))
            .filter(F.col("v").isNotNull() & F.col("vec_id").isNotNull()))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_q").cast("long")).alias("q")).first()
    shards, blocks = -(-size["n"] // shard), -(-(size["q"] or 0) // block)
    rows = rows.dropDuplicates(["vec_id", "v"])
    place = F.xxhash64("vec_id", "v")
    docs = rows.select(F.pmod(place, F.lit(max(1, shards))).alias("s"),
                       F.explode(_upto(blocks)).alias("b"), "vec_id", "v")
    queries = rows.filter("_q").select(
        F.explode(_upto(shards)).alias("s"),
        F.pmod(place, F.lit(max(1, blocks))).alias("b"), "vec_id", "v")

    def run(left, right):
        import numpy as np
        import pyarrow as pa
        ids, v = _matrix(left, "v")
        qids, q = _matrix(right, "v")
        found = []
        if len(ids) and len(qids):
            wide = max(v.shape[1], q.shape[1])
            v, q = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (v, q))
            if float(np.abs(v).max(initial=0)) * float(np.abs(q).max(initial=0)) * wide < 2 ** 53:
                v, q = v.astype(np.float64), q.astype(np.float64)  # exact, and faster than int64
            index = Postings(v)
            for own, x in zip(qids, q):
                at, score = index.search(x, k, own, ids)
                found.append((np.full(len(at), own), ids[at], score.astype(np.int64)))
        cols = [np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(3)]
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

    near = (docs.groupBy("s", "b").cogroup(queries.groupBy("s", "b"))
            .applyInArrow(run, "query_id long, vec_id long, score long"))
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
