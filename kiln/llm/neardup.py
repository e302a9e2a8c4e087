"""MinHash near-duplicate detection: one-permutation hashing with optimal
densification, banded buckets, star-shaped candidate edges, exact confirmation.

1. One pass over the texts gives every document its number of distinct
   shingles, a 128-bit digest of its shingle set and ``BANDS`` band keys.  A
   single hash per shingle falls into one of BANDS x ROWS bins, each bin keeps
   its minimum, and an empty bin borrows from the first occupied one of a fixed
   random order of its own (optimal densification).
2. Documents with equal sets form a class; only its smallest doc_id goes on, so
   a thousand copies cost one entry.
3. Members of a band bucket are paired with the bucket's hub, a different
   pseudo-random member in every bucket: pairs grow with the number of members,
   never with its square, and a document meets up to BANDS hubs.
4. Pairs are confirmed on the full shingle sets (``100 * inter >= 75 * union``).
5. Links are contracted to connected components.  Members that their bucket's
   hub has not settled go into finer buckets, of every two bands they share
   with others, and meet one settled member of each (or another open one): up
   to 496 hubs, the more alike the likelier.
6. Members of buckets that still hold several components are compared exactly:
   an overlap of 75 % needs a common shingle among the rarest few of both sets,
   how few depends on both sizes.  Rare ones give pairs; documents that share
   a hot one form crowds, cut into cells that are compared cell by cell.

So every pair that shares a bucket and is 75 % alike is in one component.  At a similarity of 0.75 a pair shares no bucket with probability
(1 - 0.75**4)**32, about 5e-6.

Rules: texts are taken whole; null, empty and white-space texts have no
shingles and link with nothing; fewer than five words make one shingle; rows
with one doc_id are one document; a row without doc_id takes part in its
class, and its component is the class's; an empty table gives an empty
result; other columns pass by."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import materialize
from kiln.llm.url_filter import MAX_BLOCKS, _block, _mask, bloom_filter
from kiln.session import clear_scratch, cut_lineage, scratch_mark

BANDS, ROWS, WIDTH, PERCENT = 32, 4, 5, 75
#: Size classes of the exact turn and how far apart two similar sets' classes can be; members up to
#: which a shingle gives pairs; documents and shingles of a crowd's cell.
STEP, APART, PAIRED, CELL, CELL_SHINGLES = 1.05, 6, 16, 512, 500_000
_BINS = BANDS * ROWS
_MASK = (1 << 64) - 1


def _mix(x):
    """A 64-bit finaliser on a uint64 array."""
    import numpy as np
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_UP = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingles(text: bytes, width: int = WIDTH):
    """Sorted distinct 64-bit hashes of the word shingles of a UTF-8 text."""
    import numpy as np
    import xxhash
    words = text.translate(_UP).split()  # splits at 0x20 and 0x09-0x0D only
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))] if words else [], dtype=np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n, h = len(w) - width + 1, np.uint64(0)
    with np.errstate(over="ignore"):
        for i in range(width):
            h = h * np.uint64(0x9E3779B97F4A7C15) + w[i:i + n]
        return np.unique(_mix(h))


def probe_order(bins: int = _BINS):
    """For every bin the fixed random order in which it borrows."""
    import numpy as np
    rng = np.random.default_rng(20_17)
    return np.stack([rng.permutation(bins) for _ in range(bins)])


def band_keys(sets, order, bands: int = BANDS, rows: int = ROWS):
    """Band keys (int64) of a sorted non-empty shingle set."""
    import numpy as np
    bins = bands * rows
    shift = np.uint64(64 - bins.bit_length() + 1)
    first = np.searchsorted(sets, np.arange(bins, dtype=np.uint64) << shift)
    there = np.minimum(first, len(sets) - 1)
    full = (first < len(sets)) & ((sets[there] >> shift) == np.arange(bins, dtype=np.uint64))
    sig = sets[there]
    empty = np.flatnonzero(~full)
    if len(empty):
        donors = order[empty]
        sig[empty] = sig[donors[np.arange(len(empty)), full[donors].argmax(axis=1)]]
    with np.errstate(over="ignore"):
        h = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for i in range(rows):
            h = _mix(h ^ sig.reshape(bands, rows)[:, i])
    return h.view(np.int64)


def prints(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, n_shingles, set_id (binary, null for an empty set), bands (array<bigint>)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash
        order = probe_order()
        for batch in batches:
            counts, ids, bands, offsets = [], [], [], [0]
            for t in batch.column(1):
                s = shingles(t.as_py() or b"")
                counts.append(len(s))
                ids.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                if len(s):
                    bands.append(band_keys(s, order))
                offsets.append(offsets[-1] + (BANDS if len(s) else 0))
            flat = pa.array(np.concatenate(bands) if bands else np.empty(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)],
                names=["doc_id", "n_shingles", "set_id", "bands"])

    return (docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("t"))
            .mapInArrow(run, "doc_id long, n_shingles long, set_id binary, bands array<bigint>"))


def full_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(rep, shingle set) of the wanted documents; a Bloom filter of their ids
    keeps the other texts out of the shuffle, the joins on rep that follow
    drop its few false hits."""
    blocks = max(1, min(MAX_BLOCKS, wanted.count() * 16 // 64 + 1))
    h = F.xxhash64(F.col(key).cast("long"))
    word, mask = F.element_at(bloom_filter(wanted.select(F.xxhash64("rep").alias("_k")), "_k", blocks),
                              (_block(h, blocks) + 1).cast("int")), _mask(h)
    near = (docs.select(F.col(key).cast("long").alias("rep"), F.col(text).cast("binary").alias("t"), h.alias("_h"))
            .filter(F.col("rep").isNotNull() & (word.bitwiseAND(mask) == mask)).select("rep", "t")
            .dropDuplicates())

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            sets = [shingles(t.as_py() or b"").view(np.int64) for t in batch.column(1)]
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            flat = np.concatenate([np.empty(0, np.int64), *sets])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))],
                names=["rep", "shingles"])

    return near.mapInArrow(run, "rep long, shingles array<bigint>")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.  Plain equi-joins:
    Spark splits the side on which a hot centre repeats."""
    a, b = (sets.select(F.col("rep").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab")
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(b, "b").join(a, "a")
            .filter(100 * both >= percent * (F.size("sa") + F.size("sb") - both)).select("a", "b").distinct())


def moves(edges: DataFrame, turn: int) -> DataFrame:
    """(old, new): every node of ``edges`` that moves to its neighbour that comes
    first in the turn's random order, if that comes before the node itself."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rank = F.xxhash64("b", F.lit(turn))
    near = both.groupBy("a").agg(F.min_by("b", rank).alias("new"), F.min(rank).alias("h"))
    return near.filter(F.col("h") < F.xxhash64("a", F.lit(turn))).select(F.col("a").alias("old"), "new")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of an undirected link table (a, b), by
    contraction: each round every node moves to its neighbour that comes first
    in a fresh random order, links are renamed and collapse, and the rounds end
    when none is left (their number grows with the logarithm of the nodes).  A
    round writes the links that are left; the nodes follow the moves of all
    rounds, which those links determine, in one plan at the end."""
    rounds = []
    edges = cut_lineage(links.select("a", "b").filter("a <> b").distinct())
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node"))
    while not edges.isEmpty():
        move = moves(edges, len(rounds) + 1)
        rounds.append(move)
        one = edges.join(move, edges["a"] == move["old"], "left").select(F.coalesce("new", "a").alias("a"), "b")
        two = one.join(move, one["b"] == move["old"], "left").select("a", F.coalesce("new", "b").alias("b"))
        edges = cut_lineage(two.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    for move in rounds:
        nodes = nodes.join(move, nodes["root"] == move["old"], "left").select("node", F.coalesce("new", "root").alias("root"))
    return cut_lineage(nodes)


def merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, root) once ``links`` are added: only links between
    different components are contracted again."""
    ends = links.select("a", "b")
    for x in "ab":
        ends = (ends.join(comps.select(F.col("node").alias(x), F.col("root").alias("r")), x, "left")
                .withColumn(x, F.coalesce("r", x)).drop("r"))
    over = components(ends)
    moved = over.select(F.col("node").alias("root"), F.col("root").alias("to"))
    old = comps.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return cut_lineage(old.union(over.join(comps, "node", "left_anti").select("node", "root")))


def star_pairs(members: DataFrame) -> DataFrame:
    """Candidate pairs of buckets: (key, rep, comp, open) rows in, one hub per
    bucket against its open members of other components out.  The hub is a
    settled member if there is one, the first in an order of the bucket's own;
    a group limit keeps all other members out of the shuffle."""
    first = F.row_number().over(Window.partitionBy("key").orderBy("open", F.xxhash64("rep", "key"), "rep"))
    hubs = (members.withColumn("_nth", first).filter(F.col("_nth") == 1)
            .select("key", F.col("rep").alias("hub"), F.col("comp").alias("hub_comp")))
    return (members.filter("open").join(hubs, "key").filter("comp <> hub_comp")
            .select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct())


def unsettled(members: DataFrame, comps: DataFrame) -> DataFrame:
    """The members of the buckets of three or more that still hold several
    components; open are those outside the component of the bucket's hub."""
    named = (members.join(comps, members["rep"] == comps["node"], "left")
             .select("key", "rep", F.coalesce("root", "rep").alias("comp")))
    hub = F.min(F.struct(F.xxhash64("rep", "key").alias("h"), F.col("rep"), F.col("comp")))
    mixed = (named.groupBy("key").agg(hub.alias("hub"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("n"))
             .filter("lo <> hi AND n > 2").select("key", F.col("hub.comp").alias("hub_comp")))
    return named.join(mixed, "key").select("key", "rep", "comp", (F.col("comp") != F.col("hub_comp")).alias("open"))


def finer(members: DataFrame) -> DataFrame:
    """The members of pairs of buckets: documents that share two bands (at most
    BANDS * (BANDS - 1) / 2 keys each) are more alike than those that share one."""
    per = members.groupBy("rep", "comp").agg(F.array_sort(F.collect_list(F.struct("key", "open"))).alias("k"))
    pairs = F.flatten(F.transform("k", lambda x, i: F.transform(
        F.slice("k", i + 2, F.size("k")), lambda y: F.struct(F.xxhash64(x["key"], y["key"]).alias("key"), (x["open"] | y["open"]).alias("open")))))
    return per.select("rep", "comp", F.explode(pairs).alias("p")).select("p.key", "rep", "comp", "p.open")


def _spread(hit):
    """The first index of every index's component in a symmetric boolean matrix."""
    import numpy as np
    label = np.arange(len(hit))
    while True:
        near = np.minimum(label, np.where(hit, label[None, :], len(hit)).min(axis=1, initial=len(hit)))
        near = near[near]
        if np.array_equal(near, label):
            return label
        label = near


def cell_links(reps, comps, sizes, tokens, side, percent: int = PERCENT):
    """Links between the documents of side 0 and of side 1, or within side 0 if
    there is no other; of linked ones each meets the first only."""
    import numpy as np
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if (side == 1).any() else left
    ends = np.cumsum([0, *map(len, tokens)])
    word, at = np.unique(np.concatenate([np.empty(0, np.int64), *tokens]), return_inverse=True)
    row = np.repeat(np.arange(len(tokens)), np.diff(ends))
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    inter = np.zeros((len(left), len(right)), np.float32)
    place = np.full((2, len(tokens)), -1)
    place[0, left], place[1, right] = np.arange(len(left)), np.arange(len(right))
    for lo in range(0, len(word), 4096):  # the shingles in slices, so that the matrices stay small
        a, b = np.searchsorted(at, [lo, lo + 4096])
        one, two = np.zeros((len(left), 4096), np.float32), np.zeros((len(right), 4096), np.float32)
        for m, p in ((one, place[0]), (two, place[1])):
            there = p[row[a:b]] >= 0
            m[p[row[a:b][there]], at[a:b][there] - lo] = 1
        both = one.any(axis=0) & two.any(axis=0)
        inter += one[:, both] @ two[:, both].T
    total = sizes[left][:, None] + sizes[right][None, :]
    hit = (100 * inter.astype(np.int64) >= percent * (total - inter.astype(np.int64))) & (comps[left][:, None] != comps[right][None, :])
    whole = np.zeros((len(tokens), len(tokens)), bool)
    whole[np.ix_(left, right)] = hit
    first = _spread(whole | whole.T)
    moved = np.flatnonzero(first != np.arange(len(first)))
    return reps[moved], reps[first[moved]]


def exact_links(left: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) that join all members of ``left`` (rep, comp) that are similar
    enough and not yet of one component; some stand for a chain of links."""
    n, size = F.col("n"), F.size("tokens")
    items = materialize(sets.join(left.select("rep", "comp").distinct(), "rep"), "near-open")
    tokens = items.select("rep", F.explode("shingles").alias("s"))
    shared = tokens.groupBy("s").agg(F.count(F.lit(1)).alias("f")).filter("f > 1")  # the others are in no overlap
    ranked = tokens.join(shared, "s").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("f", "s"))).alias("o"))
    docs = materialize(items.select("rep", "comp", F.size("shingles").cast("long").alias("n")).join(ranked, "rep").select(
        "rep", "comp", "n", F.floor(F.log(n) / F.log(F.lit(STEP))).alias("c"), F.col("o.s").alias("tokens")), "near-ordered")

    # the rarest shingles of a set that a similar set of a size class must meet
    met = docs.withColumn("j", F.explode(F.sequence(F.col("c") - APART, F.col("c") + APART)))
    least = F.greatest(F.floor(F.pow(F.lit(STEP), F.col("j")) * (1 - 1e-9)), F.ceil(percent * n / F.lit(100)))
    need = F.ceil(percent * (n + least) / F.lit(100 + percent) - F.lit(1e-9))
    met = met.withColumn("p", (size - need + 1).cast("int")).filter("p > 0")
    at = materialize(met.select("rep", "comp", "c", "j", F.explode(F.slice("tokens", F.lit(1), F.col("p"))).alias("s")).select(
        "rep", "comp", F.xxhash64(F.least("c", "j"), F.greatest("c", "j"), "s").alias("key")), "near-prefixes")
    groups = at.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("rep").alias("lead"), F.min("comp").alias("lo"),
                                   F.max("comp").alias("hi")).filter("lo <> hi").select("key", "m", "lead")
    met = materialize(at.join(groups, "key"), "near-met")
    rare = met.filter(F.col("m") <= PAIRED)
    pairs = (rare.select("key", F.col("rep").alias("a"), F.col("comp").alias("ca"))
             .join(rare.select("key", F.col("rep").alias("b"), F.col("comp").alias("cb")), "key")
             .filter("a < b AND ca <> cb").select("a", "b").distinct())
    links = confirm(materialize(pairs, "near-pairs"), sets, percent)
    hot = met.filter(F.col("m") > PAIRED).select(F.col("rep").alias("a"), F.col("lead").alias("b")).distinct()
    return links if hot.isEmpty() else links.union(crowd_links(docs, components(hot), percent))


def crowd_links(docs: DataFrame, crowds: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links within crowds (node, root): cells of one size class each, every two
    cells of a crowd whose sizes allow it compared in a task of their own."""
    inside = docs.join(crowds, docs["rep"] == crowds["node"]).select(F.col("root").alias("crowd"), "c", "rep", "comp", "n", "tokens")
    counts = materialize(inside.groupBy("crowd", "c").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / F.lit(CELL)), F.ceil(F.sum(F.size("tokens")) / F.lit(CELL_SHINGLES)), F.lit(1)).alias("g")), "near-crowds")
    cells = counts.select("crowd", "c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("g") - 1)).alias("h"))
    two = cells.select("crowd", F.col("c").alias("d"), F.col("h").alias("k"))
    units = (cells.join(two, "crowd").filter((F.col("d") - F.col("c")).between(0, APART) & ((F.col("d") > F.col("c")) | (F.col("k") >= F.col("h"))))
             .withColumn("unit", F.concat_ws(":", "crowd", "c", "h", "d", "k")))
    placed = inside.join(counts, ["crowd", "c"]).withColumn("h", F.pmod(F.xxhash64("rep"), F.col("g"))).drop("g")
    row = ["unit", "rep", "comp", "n", "tokens"]
    one = placed.join(units, ["crowd", "c", "h"]).select(*row, F.lit(0).alias("side"))
    other = units.filter("d > c OR k > h").select("crowd", F.col("d").alias("c"), F.col("k").alias("h"), "unit")
    both = one.union(placed.join(other, ["crowd", "c", "h"]).select(*row, F.lit(1).alias("side")))

    def run(unit):
        import numpy as np
        import pandas as pd
        side = unit["side"].to_numpy()
        if not (side == 0).any():
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        alone = unit["unit"].iloc[0].split(":")
        if alone[1:3] != alone[3:5] and not (side == 1).any():
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        a, b = cell_links(unit["rep"].to_numpy(), unit["comp"].to_numpy(), unit["n"].to_numpy(),
                          [np.asarray(t, np.int64) for t in unit["tokens"]], side, percent)
        return pd.DataFrame({"a": a, "b": b})

    return both.groupBy("unit").applyInPandas(run, "a long, b long").distinct()


def buckets(classes: DataFrame) -> DataFrame:
    """(key, rep) of the band buckets that hold at least two classes; a
    partial aggregate counts them, a hot bucket is split by the join."""
    rows = classes.filter("rep IS NOT NULL").select("rep", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo <> hi").select("key")
    return rows.join(shared, "key", "left_semi")


def link(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    known = materialize(prints(docs, key, text), "near-prints")
    classes = materialize(known.filter("set_id IS NOT NULL").groupBy("set_id").agg(
        F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands")), "near-classes")
    members = materialize(buckets(classes), "near-buckets")
    sets = materialize(full_sets(docs, members.select("rep").distinct(), key, text), "near-sets")
    single = members.withColumns({"comp": F.col("rep"), "open": F.lit(True)})
    links = cut_lineage(confirm(materialize(star_pairs(single), "near-pairs"), sets))
    comps = components(links)
    left = materialize(unsettled(members, comps), "near-unsettled")
    if not left.isEmpty():
        comps = merged(comps, confirm(materialize(star_pairs(finer(left)), "near-pairs"), sets))
        left = materialize(unsettled(members, comps), "near-unsettled")
        if not left.isEmpty():
            comps = merged(comps, exact_links(left, sets))
    least = comps.groupBy("root").agg(F.min("node").alias("component_id"))
    named = comps.join(least, "root").select("node", "component_id")
    of_set = (classes.join(named, classes["rep"] == named["node"], "left")
              .select("set_id", F.coalesce("component_id", "rep").alias("component_id")))
    out = known.select("doc_id", "n_shingles", "set_id").join(of_set, "set_id", "left")
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without near duplicates: of every component the document with
    the smallest id stays, once.  Rows without an id cannot be told apart by it
    and stay."""
    spark = docs.sparkSession
    mark = scratch_mark(spark)
    linked = link(docs, key, text)
    end = scratch_mark(spark)
    kept = materialize(linked.filter("kept AND doc_id IS NOT NULL")
                       .groupBy(F.col("doc_id").alias("_kept")).agg(F.count(F.lit(1)).alias("_rows")), "near-kept")
    clear_scratch(spark, mark, end)  # what follows reads ``kept`` and the documents only
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(key).cast("long").alias("_id"), F.xxhash64(text).alias("_h"))
    met = rows.join(kept, F.col("_id") == F.col("_kept"))
    out = met.filter("_rows = 1").select("_row.*")
    if not kept.filter("_rows > 1").isEmpty():  # rows that share an id: the first by a hash of the text
        first = met.filter("_rows > 1").groupBy("_kept").agg(F.min_by("_row", "_h").alias("_row"))
        out = out.unionByName(first.select("_row.*"))
    if not docs.filter(F.col(key).isNull()).isEmpty():
        out = out.unionByName(docs.filter(F.col(key).isNull()))
    return out
