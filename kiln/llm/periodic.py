"""Runs (maximal periodic stretches of words) by maximal-pair enumeration.

A run with smallest period q that starts at word s and is L words long is a pair
of places (s, s + q) whose next L - q words agree while the words in front and
behind differ: a maximal pair, found without any extension.  The suffixes of
each text are grouped by doubling (1, 4, 8, ... equal words), which gives the
suffix array and, read from the longest step down, the LCP of its neighbours.
The LCP-interval tree is walked bottom-up.  Every interval holds the places of
its suffixes in text order together with the class of the word to their left;
when two children meet, each place of the smaller one looks at its neighbours in
the larger one.  Places of one interval that lie within its LCP / 3 form a
progression in the smallest period, so the neighbours decide: a pair of different
left-word classes at distance q is a run if LCP + q >= max(shortest, exponent * q).

Only LCPs of a least length (five words, for runs of at least six words and four
periods) can make runs, and only groups of places that lie near enough, so the tree is
built for those; both tests are exact.

Rules: words are maximal runs of anything but ASCII white space; a null text has
no words; texts are taken whole; rows are independent; repeated rows get equal
results; an empty table gives an empty one; other columns pass through, but for
columns named like the results."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.llm.token_counts import slices, texts_of

#: Bytes of text handled at once (a longer text is handled alone).
SLICE = 2_000_000
#: A multiplier that mixes words into one 64-bit number; equal numbers are only candidates.
MIX = np.uint64(0x9E3779B97F4A7C15)
STEP = 4


class Codes(dict):
    """Numbers words in order of first use."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def lay_out(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Word codes of all texts, a border of its own in front of and behind each
    (more at the very end, so that every place has ``2 * STEP`` behind it), and
    each text's first place."""
    codes = Codes()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = 1 + np.cumsum(lengths + 1) - (lengths + 1)
    flat = np.full(int(lengths.sum()) + len(texts) + 2 * STEP, -1, np.int64)
    for at, words in zip(starts.tolist(), texts):
        flat[at:at + len(words)] = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
    borders = np.flatnonzero(flat < 0)
    flat[borders] = len(codes) + np.arange(len(borders))
    return flat, starts


def candidates(flat: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Places whose next ``STEP`` words occur again in their text (and, rarely, others)."""
    n = len(flat) - 2 * STEP + 1
    if n < 2:
        return np.empty(0, np.int64)
    mixed = text_of[:n].astype(np.uint64)
    for k in range(STEP):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX + flat[k:n + k].astype(np.uint64)
    mixed *= MIX
    order = np.argsort(mixed)
    same = mixed[order[1:]] == mixed[order[:-1]]
    shared = np.zeros(n, bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    return np.flatnonzero(shared)


def suffix_array(flat: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidate places, and those ``STEP`` behind them, in the order of their
    suffixes, text by text, and the LCP of each with the one before (0 for the
    first and between texts)."""
    places = candidates(flat, text_of)
    if not len(places):
        return places, places
    places = np.union1d(places, places + STEP)
    index = np.full(len(flat) + 1, -1, np.int64)
    index[places] = np.arange(len(places))
    wide = np.int64(len(flat) + 1)
    pairs = np.concatenate([flat[places] * wide + flat[places + 1], flat[places + 2] * wide + flat[places + 3]])
    codes = np.unique(pairs, return_inverse=True)[1]
    fours = np.unique(codes[:len(places)] * np.int64(len(pairs)) + codes[len(places):], return_inverse=True)[1]
    _, group, counts = np.unique(text_of[places] * wide + fours, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts)[group]
    levels, step = [rank.astype(np.int32)], STEP
    live = np.flatnonzero(counts[group] > 1)
    while len(live):
        # agreeing words hold no border, so the place a step further is in the same text; it stands
        # STEP behind a candidate, so it has a rank
        second = rank[index[places[live] + step]]
        order = np.lexsort((second, rank[live]))
        live, first, second = live[order], rank[live[order]], second[order]
        new = np.append(True, first[1:] != first[:-1])
        split = new | np.append(True, second[1:] != second[:-1])
        at = np.arange(len(live))
        rank = rank.copy()
        rank[live] = first + np.maximum.accumulate(np.where(split, at, 0)) - np.maximum.accumulate(np.where(new, at, 0))
        levels.append(rank.astype(np.int32))
        group = np.cumsum(split) - 1
        live = live[np.bincount(group)[group] > 1]
        step *= 2
    order = places[np.argsort(rank)]
    left, right = order[:-1].copy(), order[1:].copy()
    for k in range(len(levels) - 1, -1, -1):
        a, b = index[left], index[right]
        agree = (a >= 0) & (b >= 0) & (levels[k][a] == levels[k][b])
        left += agree * (STEP << k)
        right += agree * (STEP << k)
    going = text_of[left] == text_of[right]
    for _ in range(STEP - 1):
        going &= flat[left] == flat[right]
        left += going
        right += going
    return order, np.append(0, left - order[:-1])


def near(order: np.ndarray, lcp: np.ndarray, least: int, exponent: int) -> np.ndarray:
    """First entries of the groups (LCP ``least`` and more) two of whose places lie
    near enough for a run, with the end behind each: rows (first, end)."""
    head = np.flatnonzero(lcp < least)
    ends = np.append(head[1:], len(order))
    group = np.repeat(np.arange(len(head)), ends - head)
    at = np.lexsort((order, group))
    gap = np.append(np.diff(order[at]), 0)
    gap[np.append(group[1:] != group[:-1], True)] = len(order) + order.max() + 1
    closest = np.minimum.reduceat(gap, head)
    inner = lcp.copy()
    inner[head] = 0
    deepest = np.maximum.reduceat(inner, head)
    good = (ends - head > 1) & ((exponent - 1) * closest <= deepest)
    return np.stack([head[good], ends[good]], 1)


def group_runs(places: list[int], lcp: list[int], left: list[int], shortest: int, exponent: int, found: dict) -> None:
    """Walk one group's LCP-interval tree bottom-up; ``found[(start, length)]``
    gets the smallest period.  ``lcp[i]`` belongs to places[i - 1] and places[i];
    ``left[i]`` is the left-word class of places[i]."""
    times = exponent - 1
    cls = dict(zip(places, left))

    def pair(i: int, j: int, depth: int) -> None:
        q = j - i
        if times * q <= depth and depth + q >= shortest and cls[i] != cls[j] and q < found.get((i, depth + q), q + 1):
            found[(i, depth + q)] = q

    def meet(a: list[int], b: list[int], depth: int) -> list[int]:
        if len(a) < len(b):
            a, b = b, a
        if len(b) * 8 > len(a) and len(b) > 8:
            inside = set(b)
            both = sorted(a + b)
            for i, j in zip(both, both[1:]):
                if (i in inside) != (j in inside):
                    pair(i, j, depth)
            return both
        spots = [bisect_left(a, x) for x in b]
        for x, at in zip(b, spots):
            if at:
                pair(a[at - 1], x, depth)
            if at < len(a):
                pair(x, a[at], depth)
        for x, at in zip(reversed(b), reversed(spots)):
            a.insert(at, x)
        return a

    stack: list[tuple[int, list[int]]] = []
    node = [places[0]]
    for place, depth in zip(places[1:], lcp[1:]):
        while stack and stack[-1][0] > depth:
            d, kin = stack.pop()
            node = meet(kin, node, d)
        if stack and stack[-1][0] == depth:
            stack[-1] = (depth, meet(stack[-1][1], node, depth))
        else:
            stack.append((depth, node))
        node = [place]
    while stack:
        d, kin = stack.pop()
        node = meet(kin, node, d)


def least_lcp(shortest: int, exponent: int) -> int:
    """The shortest LCP of the two places that make a run, over all periods."""
    return min(max(shortest - q, (exponent - 1) * q) for q in range(1, max(shortest, 2)))


def runs_of(texts: list[list[bytes]], shortest: int = 6, exponent: int = 4) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each text, by start, then period."""
    flat, starts = lay_out(texts)
    text_of = np.searchsorted(starts, np.arange(len(flat)), "right")
    order, lcp = suffix_array(flat, text_of)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(order):
        return out
    found: dict[tuple[int, int], int] = {}
    for first, end in near(order, lcp, least_lcp(shortest, exponent), exponent).tolist():
        part = order[first:end]
        group_runs(part.tolist(), lcp[first:end].tolist(), flat[part - 1].tolist(), shortest, exponent, found)
    for (place, length), period in sorted((k, q) for k, q in found.items()):
        t = int(text_of[place]) - 1
        out[t].append((place - int(starts[t]), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run repeats (all behind its first period), joined by one space."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change)[:-1] == 0
    return b" ".join(w for w, k in zip(words, kept.tolist()) if k)


RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def periodic_runs(df: DataFrame, text: Column | str = "text", shortest: int = 6, exponent: int = 4,
                  keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all) plus ``runs`` (array of start, length, period, by
    start, then period) and ``collapsed`` (the text without repeated periods).
    A run has at least ``shortest`` words and ``exponent`` (3 or more) periods."""
    if exponent < 3 or least_lcp(shortest, exponent) < STEP:
        raise ValueError(f"exponent must be 3 or more, and runs must need {STEP} equal words at their period's distance")
    made = [T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
    keep = [c for c in (df.columns if keep is None else keep) if c not in ("runs", "collapsed")]
    schema = T.StructType([*(df.schema[c] for c in keep), *made])

    def run(batches):
        import pyarrow as pa
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in RUN.names]))
        for batch in batches:
            offsets, data = texts_of(batch.column(batch.num_columns - 1))
            for i, j in slices(offsets, SLICE):
                words = [bytes(data[a:b]).split() for a, b in zip(offsets[i:j], offsets[i + 1:j + 1])]
                runs = runs_of(words, shortest, exponent)
                texts = [collapsed(w, r).decode() for w, r in zip(words, runs)]
                sizes = np.fromiter(map(len, runs), np.int32, len(runs))
                rows = np.array([r for rs in runs for r in rs], np.int64).reshape(-1, 3)
                lists = pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes)).astype(np.int32),
                                                 pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], names=RUN.names))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns[:-1]), lists.cast(kind), pa.array(texts)],
                                                 names=schema.names)

    source = df[text] if isinstance(text, str) else text
    return df.select(*keep, source.alias("_runs_text")).mapInArrow(run, schema)


def longest(runs: Column) -> Column:
    """The run of the greatest exact length / period; ties: smallest start, then
    period (the order of the array).  Null without runs."""
    def better(best, r):
        return F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best)
    return F.when(F.size(runs) > 0, F.reduce(F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))), F.get(runs, F.lit(0)), better))
