"""Token counts of whole texts by rank-synchronous array merging.

A ``tokenizers`` file names a normalizer, a pre-tokenizer and a byte-level BPE
table.  Texts are cut at ASCII white space (which the pre-tokenizer drops), and
the distinct words of a slice of texts are normalised and pre-tokenised once by
the library's own parts.  The distinct pre-tokens lie one behind another in
ragged numpy arrays.  In every round each sequence applies its lowest-rank pair,
everywhere it stands in that sequence and for all sequences at once; sequences
without a mergeable pair leave with their number of symbols.  A sequence of more
than ``LONG`` symbols goes through the same rounds, but its pairs are kept in
lists by rank, so that a round touches the merged places only.

Rules: a null text is the empty text (no bytes, no tokens); texts are counted
whole; strings of special tokens inside a text count as that one token, as is
the library's default, and no token is added in front or behind; rows are
independent, so repeated rows get equal counts; an empty table gives an empty
one; other columns pass through, but for columns named like the results."""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: No merge: above every rank.
NONE = np.iinfo(np.int32).max
#: Symbols of a sequence from which its pairs are kept by rank; bytes of text handled at once; distinct words remembered by a task.
LONG, SLICE, REMEMBERED = 4_096, 4_000_000, 400_000


class Merges:
    """The merge table as sorted arrays: pair of symbol ids -> rank and product."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab = model["vocab"]
        if model.get("type") != "BPE" or model.get("dropout") or model.get("ignore_merges") or model.get("byte_fallback") \
                or model.get("continuing_subword_prefix"):
            raise ValueError("only plain BPE tables are counted")
        end = model.get("end_of_word_suffix") or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right, made = (np.array([vocab[x] for x in xs], np.int64)
                             for xs in ([a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs]))
        self.width = max(vocab.values()) + 1
        keys = left * self.width + right
        keys, at = np.unique(keys[::-1], return_index=True)  # the last of equal pairs holds, as in a map
        at = len(pairs) - 1 - at
        self.keys, self.ranks, self.made = keys, at.astype(np.int32), made[at]
        #: Every product is only used by later merges: equal pairs of a round may then be merged together.
        by = np.full(self.width, -1, np.int64)
        np.maximum.at(by, self.made, self.ranks)
        self.ordered = bool(((by[left[at]] < at) & (by[right[at]] < at)).all())
        size = max(ord(c) for c in vocab if len(c) == 1) + 1
        self.inner, self.last = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        for c, i in vocab.items():
            if len(c) == 1:
                self.inner[ord(c)] = i
                self.last[ord(c)] = vocab.get(c + end, -1)

    def symbols(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbol ids of the pre-tokens, one behind another, and their lengths."""
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        points = np.frombuffer("".join(tokens).encode("utf-32-le"), "<u4")
        ids = self.inner[points]
        ends = np.cumsum(lengths) - 1
        ids[ends] = self.last[points[ends]]
        if len(ids) and ids.min() < 0:
            raise ValueError("a symbol is not in the vocabulary")
        return ids, lengths

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NONE`` without a merge) and product of each pair."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE), self.made[at]


def every_other(hits: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Of each chain of overlapping hits the first, third, ...: a symbol merges
    once, leftmost first.  ``joined``: the hit overlaps the one before."""
    at = np.arange(len(hits))
    first = np.maximum.accumulate(np.where(joined, 0, at))
    return hits[(at - first) % 2 == 0]


def count_long(ids: np.ndarray, table: Merges) -> int:
    """Surviving symbols of one long sequence."""
    n = len(ids)
    ids = ids.copy()
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    rank, made = np.full(n, NONE, np.int32), np.zeros(n, np.int64)
    alive = n
    lists: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def rate(places: np.ndarray) -> None:
        paired = places[after[places] < n]
        rank[places] = NONE
        rank[paired], made[paired] = table.look_up(ids[paired], ids[after[paired]])
        paired = paired[rank[paired] < NONE]
        paired = paired[np.argsort(rank[paired], kind="stable")]
        ranks, starts = np.unique(rank[paired], return_index=True)
        for r, part in zip(ranks.tolist(), np.split(paired, starts[1:])):
            if r not in lists:
                lists[r] = []
                heapq.heappush(heap, r)
            lists[r].append(part)

    rate(np.arange(n))
    while heap:
        r = heapq.heappop(heap)
        hits = np.unique(np.concatenate(lists.pop(r)))
        hits = hits[rank[hits] == r]
        if not len(hits):
            continue
        if table.ordered:
            hits = every_other(hits, np.append(False, after[hits[:-1]] == hits[1:]))
        else:
            lists[r] = [hits[1:]]
            heapq.heappush(heap, r)
            hits = hits[:1]
        gone = after[hits]
        ids[hits] = made[hits]
        rank[gone] = NONE
        after[hits] = after[gone]
        inside = after[hits] < n
        before[after[hits][inside]] = hits[inside]
        alive -= len(hits)
        touched = np.concatenate([hits, before[hits]])
        rate(np.unique(touched[touched >= 0]))
    return alive


def count_symbols(ids: np.ndarray, lengths: np.ndarray, table: Merges, long: int = LONG) -> np.ndarray:
    """Surviving symbols of each sequence; ``ids`` holds them one behind another."""
    out = np.array(lengths)
    starts = np.cumsum(lengths) - lengths
    for i in np.flatnonzero(lengths > long):
        out[i] = count_long(ids[starts[i]:starts[i] + lengths[i]], table)
    seq = np.flatnonzero((lengths > 1) & (lengths <= long))
    ids = ids[np.repeat(np.isin(np.arange(len(lengths)), seq), lengths)]
    lengths = lengths[seq]
    rank, made = table.look_up(ids[:-1], ids[1:]) if len(ids) else (np.empty(0, np.int32), np.empty(0, np.int64))
    rank, made = np.append(rank, NONE)[:len(ids)], np.append(made, 0)[:len(ids)]
    rank[np.cumsum(lengths) - 1] = NONE
    while len(seq):
        starts = np.cumsum(lengths) - lengths
        low = np.minimum.reduceat(rank, starts)
        open_ = low < NONE
        out[seq[~open_]] = lengths[~open_]
        keep = np.repeat(open_, lengths)
        ids, rank, made, seq, low, lengths = ids[keep], rank[keep], made[keep], seq[open_], low[open_], lengths[open_]
        if not len(seq):
            break
        hits = np.flatnonzero(rank == np.repeat(low, lengths))
        owner = np.repeat(np.arange(len(seq)), lengths)
        if table.ordered:
            hits = every_other(hits, np.append(False, hits[:-1] + 1 == hits[1:]))
        else:
            hits = hits[np.append(True, owner[hits[1:]] != owner[hits[:-1]])]
        ids[hits] = made[hits]
        stay = np.ones(len(ids), bool)
        stay[hits + 1] = False
        lengths = lengths - np.bincount(owner[hits], minlength=len(seq))
        moved = np.cumsum(stay) - 1
        ids, rank, made = ids[stay], rank[stay], made[stay]
        places = moved[hits]
        ends = np.cumsum(lengths) - 1
        last = np.zeros(len(ids), bool)
        last[ends] = True
        rank[places[last[places]]] = NONE
        touched = np.concatenate([places, places - 1])
        touched = touched[touched >= 0]
        touched = touched[~last[touched]]
        rank[touched], made[touched] = table.look_up(ids[touched], ids[touched + 1])
    return out


class Counter:
    """Token counts of texts under one tokenizer file; remembers distinct words."""

    def __init__(self, content: str, long: int = LONG):
        from tokenizers import Tokenizer
        spec = json.loads(content)
        self.table, self.long = Merges(spec), long
        parts = Tokenizer.from_str(json.dumps({**spec, "added_tokens": [], "post_processor": None, "truncation": None,
                                               "padding": None, "model": {**spec["model"], "vocab": {}, "merges": []}}))
        self.normalizer, self.pre_tokenizer = parts.normalizer, parts.pre_tokenizer
        added = spec.get("added_tokens") or []
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in added):
            raise ValueError("added tokens must be plain strings without white space")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.known: dict[bytes, int] = {}

    def pre_tokens(self, word: str) -> tuple[list[str], int]:
        """Pre-tokens of a word and the special tokens in it."""
        parts = self.special.split(word) if self.special else [word]
        tokens = [t for part in parts[::2] if part
                  for t, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(part) if self.normalizer else part)]
        return [t for t in tokens if t], len(parts) // 2

    def learn(self, words: list[bytes]) -> None:
        """Count the tokens of new distinct words."""
        index: dict[str, int] = {}
        used, owner = [], []
        totals = np.zeros(len(words), np.int64)
        for w, word in enumerate(words):
            tokens, totals[w] = self.pre_tokens(word.decode())
            for t in tokens:
                used.append(index.setdefault(t, len(index)))
                owner.append(w)
        if used:
            counts = count_symbols(*self.table.symbols(list(index)), self.table, self.long)
            np.add.at(totals, np.array(owner), counts[np.array(used)])
        self.known.update(zip(words, totals.tolist()))

    def count(self, texts: list[bytes]) -> np.ndarray:
        """Tokens of each UTF-8 text."""
        split = [t.split() for t in texts]  # bytes.split(): ASCII white space
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = set().union(*split).difference(self.known)
        if new:
            self.learn(list(new))
        known = self.known.__getitem__
        return np.fromiter((sum(map(known, words)) for words in split), np.int64, len(texts))


@lru_cache(maxsize=2)
def counter(content: str) -> Counter:
    return Counter(content)


def texts_of(column) -> tuple[np.ndarray, memoryview]:
    """Byte offsets and bytes of an Arrow string column (nulls: no bytes)."""
    import pyarrow as pa
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    return offsets, memoryview(column.buffers()[2] or b"")


def slices(offsets: np.ndarray, limit: int):
    """(first, end) ranges of rows of about ``limit`` bytes; a row is never cut."""
    at, rows = 0, len(offsets) - 1
    while at < rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, end
        at = end


def token_counts(df: DataFrame, tokenizer_file: str, text: str = "text", limit: int = 2048, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all) plus ``n_bytes`` (UTF-8), ``n_tokens`` and
    ``over_limit`` (more than ``limit`` tokens).

    The file is read on the driver and sent as one broadcast; its size is the
    vocabulary's, whatever the data."""
    with open(tokenizer_file, encoding="utf-8") as f:
        content = df.sparkSession.sparkContext.broadcast(f.read())
    made = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    names = {f.name for f in made}
    keep = [c for c in (df.columns if keep is None else keep) if c not in names]
    schema = T.StructType([*(df.schema[c] for c in keep), *made])

    def run(batches):
        import pyarrow as pa
        count = counter(content.value).count
        for batch in batches:
            offsets, data = texts_of(batch.column(batch.num_columns - 1))
            tokens = [count([bytes(data[a:b]) for a, b in zip(offsets[i:j], offsets[i + 1:j + 1])]) for i, j in slices(offsets, SLICE)]
            tokens = np.concatenate(tokens) if tokens else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit)],
                                             names=schema.names)

    return df.select(*keep, df[text].alias("_count_text")).mapInArrow(run, schema)
