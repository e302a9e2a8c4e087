"""Language-model scoring with a hidden Markov model trained by Baum-Welch.

Words are hashed to 64 bits (two words in 10**10 share a hash with a
probability below 0.001) and counted over all training documents.  The model
emits classes: the ``OWN`` most frequent words and the end of a document are
classes of their own, the others fall into 256 classes by last byte and
length, and inside a class a word has the share (c + 0.5) / (class total + 0.5),
the last 0.5 being the unseen word's.  So

    log10 P(text) = log10 P(classes; forward recursion) + sum log10 P(word | class)

is the probability of the whole sequence over the same open vocabulary as the
unigram base score.

Counts of the ``LISTED`` most frequent words travel in one broadcast of fixed
size; every other word of a document meets its count in a join on the hash,
whatever the vocabulary.  Baum-Welch runs its forward and backward recursions
in the tasks, over all documents of a task at once, and only expected counts
(classes x states numbers a task) are shuffled and added up.  Every round goes
over every training document, from a seeded model until the log-probability
of all of them gains less than ``SETTLED`` of itself.  Both
recursions run through whole texts, in training and in every score.

Rules: a null text is the empty text, whose one token is the end; without
training documents N and V are 0 and the model is uniform over its classes;
repeated rows are learnt and scored each; other columns pass through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.llm.common import materialize

OWN, TAILS, LISTED, STATES = 8192, 256, 65_000, 8
CLASSES = 1 + OWN + TAILS  # class 0 is the end of a document
SEED, SCALED = 5, 8  # the recursions are scaled at every SCALED-th step: far from underflow for probabilities of 1e-30 a step
CHUNK, POOL = 400_000, 20  # tokens walked at once, and how many such lots are sorted by length before
HELD, BLOCK = 600_000, 64  # more tokens than HELD (a very long text) are walked in blocks of so many steps
SETTLED = 1e-4  # gain in log-probability, as a share of it, below which the rounds end
PRIOR = 200.0  # pseudo-tokens by which a state's emissions lean on the class frequencies
_UP = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words(texts: list):
    """(hash, tail class) of the distinct words of UTF-8 texts, and each text's words as places in these, in order."""
    from collections import defaultdict
    from itertools import count

    import numpy as np
    import xxhash
    seen = defaultdict(count().__next__)
    at = []
    for t in texts:
        w = (t or b"").translate(_UP).split()  # splits at 0x20 and 0x09-0x0D only
        at.append(np.fromiter(map(seen.__getitem__, w), np.int64, len(w)))
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, seen), np.uint64, len(seen)).view(np.int64)
    size = np.fromiter(map(len, seen), np.int64, len(seen))
    last = np.frombuffer(bytes([x[-1] for x in seen]), np.uint8)
    return h, ((last & 31).astype(np.int16) * 8 + np.minimum(size, 15) // 2).astype(np.int16), at


def counted(docs: DataFrame, text: str) -> DataFrame:
    """(h, tail, c) of all words of ``docs``: counted per batch, then per hash."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            h, tail, at = words([t.as_py() for t in batch.column(0)])
            c = np.bincount(np.concatenate([np.empty(0, np.int64), *at]), minlength=len(h))
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(tail), pa.array(c.astype(np.int64))], names=["h", "tail", "c"])

    parts = docs.select(F.col(text).cast("binary").alias("t")).mapInArrow(run, "h long, tail short, c long")
    return parts.groupBy("h").agg(F.min("tail").alias("tail"), F.sum("c").alias("c"))


class Vocabulary:
    """What every task knows of the words: the listed ones with their counts,
    and the class totals.  Its size is fixed by LISTED and CLASSES."""

    def __init__(self, counts: DataFrame, documents: int):
        import numpy as np
        # the listed words lie above a quantile of the counts, so that only they come to the driver
        total = counts.count()
        floor = counts.agg(F.percentile_approx("c", 1 - LISTED / total, 100_000)).first()[0] if total > LISTED else 0
        found = sorted(counts.filter(F.col("c") > floor).collect(), key=lambda r: (-r["c"], r["h"]))
        top = found[:LISTED]
        self.documents = documents
        h = np.array([r["h"] for r in top], dtype=np.int64)
        c = np.array([r["c"] for r in top], dtype=np.int64)
        tail = np.array([r["tail"] for r in top], dtype=np.int64)
        own = np.arange(len(top)) < OWN
        per = counts.groupBy("tail").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect()
        tokens, kinds = np.zeros(TAILS), np.zeros(TAILS)
        for r in per:
            tokens[r["tail"]], kinds[r["tail"]] = r["c"], r["n"]
        self.tokens = int(tokens.sum()) + documents
        self.kinds = int(kinds.sum()) + (documents > 0)
        tokens -= np.bincount(tail[own], weights=c[own], minlength=TAILS)
        kinds -= np.bincount(tail[own], minlength=TAILS)
        self.tail_total = np.log10(tokens + 0.5 * kinds + 0.5)
        self.class_tokens = np.zeros(CLASSES)
        self.class_tokens[0] = documents
        self.class_tokens[1:1 + own.sum()] = c[own]
        self.class_tokens[1 + OWN:] = tokens
        order = np.argsort(h)
        self.h, self.rank, self.weight = h[order], order, np.log10(c[order] + 0.5)
        self.least = int(c[-1]) if len(found) > LISTED else floor  # every word counted more often is listed

    @property
    def unit(self) -> float:
        """log10 of the base score's denominator."""
        import math
        return math.log10(self.tokens + 0.5 * (self.kinds + 1))


def encoded(docs: DataFrame, vocabulary, keep: list[str], text: str) -> DataFrame:
    """Per document: ``classes`` (binary, uint16 each, the end included), the
    distinct unlisted words with their counts, and the sums that the listed
    words already settle."""
    fields = [docs.schema[c] for c in keep]

    def run(batches):
        import numpy as np
        import pyarrow as pa
        v = vocabulary.value
        end = float(np.log10(v.documents + 0.5))
        for batch in batches:
            seqs, n, known, base, inner, rest, many, offsets = [], [], [], [], [], [], [], [0]
            every, tails, places = words([t.as_py() for t in batch.column(batch.num_columns - 1)])
            at = np.minimum(np.searchsorted(v.h, every), max(len(v.h) - 1, 0))
            hits = (v.h[at] == every) if len(v.h) else np.zeros(len(every), bool)
            ranks = np.where(hits, v.rank[at], LISTED) if len(v.h) else np.full(len(every), LISTED)
            weights = v.weight[at] if len(v.h) else np.zeros(len(every))
            classes = np.where(ranks < OWN, 1 + ranks, 1 + OWN + tails).astype("<u2")
            for i in places:
                h, hit, own = every[i], hits[i], ranks[i] < OWN
                weight = weights[i][hit]
                seqs.append(np.append(classes[i], np.zeros(1, "<u2")).tobytes())
                n.append(len(h) + 1)
                known.append(int(hit.sum()) + (v.documents > 0))
                base.append(float(weight.sum()) + end)
                inner.append(float(weight[~own[hit]].sum()) - float(v.tail_total[tails[i][~own]].sum()))
                u, c = np.unique(h[~hit], return_counts=True)
                rest.append(u)
                many.append(c)
                offsets.append(offsets[-1] + len(u))
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.empty(0, k), *x]).astype(k)))
                     for x, k in ((rest, np.int64), (many, np.int32))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(seqs, pa.binary()), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                 pa.array(base, pa.float64()), pa.array(inner, pa.float64()), *lists],
                names=[*keep, "classes", "n_tokens", "listed", "base", "inner", "rest", "many"])

    schema = T.StructType([*fields, *T._parse_datatype_string(
        "classes binary, n_tokens long, listed long, base double, inner double, rest array<bigint>, many array<int>").fields])
    return docs.select(*keep, F.col(text).cast("binary").alias("_hmm_text")).mapInArrow(run, schema)


class Model:
    """Start, transition and emission probabilities (classes x states)."""

    def __init__(self, start, move, emit):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def initial(cls, class_tokens, states: int = STATES, seed: int = SEED):
        import numpy as np
        rng = np.random.default_rng(seed)
        emit = (class_tokens[:, None] + 0.5) * np.exp(rng.normal(0, 1, (len(class_tokens), states)))
        move = np.full((states, states), 0.1 / max(states - 1, 1))
        np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(0))

    @classmethod
    def maximised(cls, start, move, emit, class_tokens):
        """The model of expected counts."""
        share = (class_tokens + 0.5) / (class_tokens + 0.5).sum()
        emit = emit + PRIOR * share[:, None]
        start, move = start + 1.0, move + 1.0
        return cls(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


class _Texts:
    """Class sequences, longest first, walked one place of all texts at a time.
    Arrays are states x tokens, ordered by place, then text."""

    def __init__(self, model: Model, seqs):
        import numpy as np
        n = np.array([len(s) // 2 for s in seqs], np.int64)
        self.order = np.argsort(-n, kind="stable")
        self.flat, self.size = np.frombuffer(b"".join(seqs), "<u2"), n[self.order]
        self.starts = (np.cumsum(n) - n)[self.order]
        steps = int(n.max()) if len(n) else 0
        self.live = np.searchsorted(-self.size, -np.arange(steps + 1), "left").tolist()  # texts with a token at this place
        self.emit, self.move, self.first = np.ascontiguousarray(model.emit.T), np.ascontiguousarray(model.move.T), model.start[:, None]
        self.width = BLOCK if len(self.flat) > HELD else max(steps, 1)
        self.blocks = range(0, steps, self.width)

    def block(self, t0: int):
        """(classes, emissions, the places' bounds) of the block from place ``t0``."""
        import numpy as np
        t1 = min(t0 + self.width, len(self.live) - 1)
        at = np.concatenate([[0], np.cumsum(self.live[t0:t1])])
        n = np.minimum(self.size[:self.live[t0]], t1) - t0
        text = np.repeat(np.arange(len(n)), n)
        t = np.arange(at[-1]) - np.repeat(np.cumsum(n) - n, n)
        classes = np.empty(at[-1], np.intp)
        classes[at[t] + text] = self.flat[self.starts[text] + t0 + t]
        return classes, self.emit.take(classes, axis=1, mode="clip"), at.tolist()

    def forward(self, alpha, t0: int, e, at):
        """Scaled forward probabilities of a block after ``alpha``, and per place the
        divisors and the first text they hold for: all texts at every SCALED-th
        place, else those that end.  ``e`` is divided alike."""
        import numpy as np
        out, scales = np.empty_like(e), []
        for t, a, b in zip(range(t0, t0 + len(at)), at, at[1:]):
            n, low = b - a, 0 if t % SCALED == SCALED - 1 else self.live[t + 1]
            x, now = e[:, a:b], out[:, a:b]
            if t:
                np.matmul(self.move, alpha[:, :n], out=now)
                now *= x
            else:
                np.multiply(self.first, x, out=now)
            if low < n:
                c = now[:, low:].sum(0)
                now[:, low:] /= c
                x[:, low:] /= c
                scales.append((low, n, c))
            alpha = now
        return out, scales


def likelihood(model: Model, seqs):
    """Natural log-probability of every class sequence: scaled forward
    recursion, one step for all texts that are long enough."""
    import numpy as np
    texts = _Texts(model, seqs)
    total, alpha = np.zeros(len(seqs)), None
    for t0 in texts.blocks:
        _, e, at = texts.block(t0)
        alphas, scales = texts.forward(alpha, t0, e, at)
        alpha = alphas[:, at[-2]:]
        for low, n, c in scales:
            total[low:n] += np.log(c)
    back = np.empty_like(total)
    back[texts.order] = total
    return back


def expected(model: Model, seqs, into):
    """Adds the expected start, transition and emission counts of the sequences
    and returns their log-probability.  The forward recursion is kept for the
    backward one; of more than HELD tokens, at every BLOCK-th token only, and run
    again from there when the backward one arrives."""
    import numpy as np
    start, move, emit = into
    texts = _Texts(model, seqs)
    states, total, borders = len(model.start), 0.0, [None]
    for t0 in texts.blocks[:-1]:
        _, e, at = texts.block(t0)
        borders.append(texts.forward(borders[-1], t0, e, at)[0][:, at[-2]:].copy())
    ahead, moved = np.ones((states, 0)), np.zeros((states, states))
    for t0 in reversed(texts.blocks):
        before = borders.pop()
        classes, e, at = texts.block(t0)
        gamma, scales = texts.forward(before, t0, e, at)
        total += sum(float(np.log(c).sum()) for _, _, c in scales)
        beta = np.ones_like(e)  # 1 where a text ends
        for i in reversed(range(len(at) - 1)):
            np.matmul(model.move, ahead, out=beta[:, at[i]:at[i] + ahead.shape[1]])
            ahead = e[:, at[i]:at[i + 1]]
            ahead *= beta[:, at[i]:at[i + 1]]
        # places with the same texts lie end to end: their transitions are one product
        live = np.diff(at)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(live)) + 1, [len(live)]]).tolist()
        for i, k in zip(cuts, cuts[1:]):
            a, b, n = at[i], at[k], at[i + 1] - at[i]
            last = gamma[:, at[i - 1]:] if i else before
            if last is not None:
                moved += last[:, :n] @ e[:, a:a + n].T
            moved += gamma[:, a:b - n] @ e[:, a + n:b].T
        gamma *= beta
        if t0 == 0:
            start += gamma[:, :at[1]].sum(1)
        for s in range(states):
            emit[:, s] += np.bincount(classes, weights=gamma[s], minlength=len(emit))
    move += model.move * moved
    return total


def _chunks(batches, column: int, tokens: int = CHUNK):
    """Class sequences in groups of about so many tokens and of like lengths, as a
    group takes as many steps as its longest has tokens."""
    def cut(pool):
        pool.sort(key=len)
        held, size = [], 0
        for s in pool:
            held.append(s)
            size += len(s) // 2
            if size >= tokens:
                yield held
                held, size = [], 0
        if held:
            yield held

    pool, size = [], 0
    for batch in batches:
        for s in batch.column(column):
            pool.append(s.as_py())
            size += len(pool[-1]) // 2
            if size >= POOL * tokens:
                yield from cut(pool)
                pool, size = [], 0
    yield from cut(pool)


def baum_welch(model: Model, sequences: DataFrame, class_tokens) -> tuple[Model, float]:
    """One round over all ``sequences`` (column ``classes``): the next model and
    the natural log-probability of all of them under the given one."""
    import numpy as np
    states = len(model.start)
    shared = sequences.sparkSession.sparkContext.broadcast(model)
    names = [f"g{s}" for s in range(states)]

    def run(batches):
        import pyarrow as pa
        into = (np.zeros(states), np.zeros((states, states)), np.zeros((CLASSES, states)))
        total = sum(expected(shared.value, seqs, into) for seqs in _chunks(batches, 0))
        start, move, emit = into
        some = np.flatnonzero(emit.any(axis=1))
        if len(some):
            rows = np.concatenate([emit[some], move, start[None], np.full((1, states), total)])
            at = np.concatenate([some, -1 - np.arange(states), [-1 - states, -2 - states]])
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *(pa.array(np.ascontiguousarray(rows[:, s])) for s in range(states))],
                                             names=["row", *names])

    summed = (sequences.select("classes").mapInArrow(run, ", ".join(["row long", *(f"{n} double" for n in names)]))
              .groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).collect())  # at most classes + states + 2 rows
    total = 0.0
    start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros((CLASSES, states))
    for r in summed:
        values = [r[n] for n in names]
        if r["row"] >= 0:
            emit[r["row"]] = values
        elif r["row"] >= -states:
            move[-1 - r["row"]] = values
        elif r["row"] == -1 - states:
            start[:] = values
        else:
            total = values[0]
    shared.unpersist()
    return Model.maximised(start, move, emit, class_tokens), total


def trained(sequences: DataFrame, vocabulary: Vocabulary, documents: int) -> Model:
    """Rounds over all ``sequences`` until their log-probability settles."""
    model, last = Model.initial(vocabulary.class_tokens), None
    while documents:
        model, total = baum_welch(model, sequences, vocabulary.class_tokens)
        if last is not None and total - last <= SETTLED * abs(last):
            break
        last = total
    return model


def score(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, held_out (not ``train``), n_tokens, n_known,
    train_tokens, base_score, score."""
    import numpy as np
    spark = docs.sparkSession
    marked = docs.select(F.col(key), F.col(text).alias("_text"), F.coalesce(train, F.lit(False)).alias("_train"))
    counts = materialize(counted(marked.filter("_train"), "_text"), "hmm-counts")
    documents = marked.filter("_train").count()
    vocabulary = Vocabulary(counts, documents)
    shared = spark.sparkContext.broadcast(vocabulary)
    texts = materialize(encoded(marked, shared, [key, "_train"], "_text").withColumn("_rid", F.monotonically_increasing_id()), "hmm-texts")
    model = spark.sparkContext.broadcast(trained(texts.filter("_train"), vocabulary, documents))

    # words outside the broadcast list meet their counts
    rest = texts.select("_rid", F.explode(F.arrays_zip("rest", "many")).alias("_w")).select("_rid", F.col("_w.rest").alias("h"), "_w.many")
    rare = counts.filter(F.col("c") <= vocabulary.least).select("h", "c").hint("shuffle_hash")
    met = rest.join(rare, "h").groupBy("_rid").agg(
        F.sum(F.col("many") * (F.log10(F.col("c") + 0.5) - F.lit(float(np.log10(0.5))))).alias("_more"), F.sum("many").alias("_rare"))

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            seqs = batch.column(1).to_pylist()
            ll = likelihood(model.value, seqs) / np.log(10)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ll, pa.float64())], names=["_rid", "_ll"])

    walked = texts.select("_rid", "classes").mapInArrow(run, "_rid long, _ll double")
    plain = texts.select(F.col(key), "_rid", "_train", "n_tokens", "listed", "base", "inner",
                         F.aggregate("many", F.lit(0).cast("long"), lambda a, x: a + x).alias("_n"))
    more = F.coalesce("_more", F.lit(0.0)) + F.col("_n") * F.lit(float(np.log10(0.5)))
    return (plain.join(walked, "_rid").join(met, "_rid", "left").select(
        F.col(key), (~F.col("_train")).alias("held_out"), "n_tokens",
        (F.col("listed") + F.coalesce("_rare", F.lit(0))).alias("n_known"), F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(vocabulary.unit)).alias("base_score"),
        (F.col("_ll") + F.col("inner") + more).alias("score")))
