"""Token counts, the filter audit and word runs against plain versions."""

import hashlib
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from .conftest import ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
rng = random.Random(11)


def rows(df):
    return [r.asDict() for r in df.collect()]


# 11 token counts

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    from kiln.llm.queries import tokenizer_file
    t = Tokenizer.from_file(tokenizer_file())
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def content():
    from kiln.llm.queries import tokenizer_file
    with open(tokenizer_file(), encoding="utf-8") as f:
        return f.read()


ODD = ["", " ", "<|startoftext|>x<|ENDOFTEXT|> a<|endoftext|><|endoftext|>", "<|endof text|> a<|endoftext|", "İstanbul ΑΣ ǅ don't 'S 123٣",
       "é é ́a 漢字かな　x\x1c\x85y z​", "\x00a b ﻿", "a" * 5_000, "ab" * 6_000, "漢" * 3_000,
       "\U0001F600" * 2_000, "1" * 9_000, "\t\r\n\x0b\x0c mixed white"]


def test_token_counts_equal_the_library(llm, odd, none, library):
    from kiln.llm.queries import tokenizer_file
    from kiln.llm.token_counts import token_counts
    got = token_counts(odd, tokenizer_file(), keep=["doc_id", "n_tokens", "text", "rows"])
    assert got.columns == ["doc_id", "text", "rows", "n_bytes", "n_tokens", "over_limit"]
    assert len(rows(got)) == len(ROWS)
    for r in rows(got):
        want = library(r["text"] or "")
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((r["text"] or "").encode()), want, want > 2048)
    more = llm.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    assert {r["doc_id"]: r["n_tokens"] for r in rows(token_counts(more, tokenizer_file()))} == {i: library(t) for i, t in enumerate(ODD)}
    assert token_counts(none, tokenizer_file()).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("abetoin  <|>'é漢́"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=6))
def test_counter_equals_the_library(texts):
    from tokenizers import Tokenizer
    from kiln.llm.queries import tokenizer_file
    from kiln.llm.token_counts import counter
    with open(tokenizer_file(), encoding="utf-8") as f:
        count = counter(f.read()).count
    t = Tokenizer.from_file(tokenizer_file())
    assert count([x.encode() for x in texts]).tolist() == [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


def test_every_merge_path_counts_alike(content, library):
    from kiln.llm.token_counts import Counter
    words = ["".join(rng.choices("etaoinshr", k=rng.randint(1, 90))) for _ in range(80)] + ["a" * 33, "abab" * 9, "x", "aaab" * 5]
    want = [library(w) for w in words]
    for long, ordered in ((4_096, True), (3, True), (4_096, False), (3, False)):
        c = Counter(content, long)
        assert c.table.ordered
        c.table.ordered = ordered
        assert c.count([w.encode() for w in words]).tolist() == want


def test_a_long_sequence_takes_few_rounds(content):
    from kiln.llm.token_counts import Counter, count_long
    c = Counter(content)
    ids, _ = c.table.symbols(["".join(rng.choices("etaoinshr", k=60_000))])
    calls = []
    look_up = c.table.look_up
    c.table.look_up = lambda a, b: calls.append(len(a)) or look_up(a, b)
    count_long(ids, c.table)
    assert sum(calls) < 4 * len(ids)  # places touched, not rounds times length


# 12 filter audit

def plain_audit(docs, good, toxic):
    def fails(i, text):
        words = WORD.findall(text)
        caps = len(re.findall("[A-Z]", text))
        return (len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * caps > 10 * len(text), bool(re.search("[#$%&*|]", text)),
                i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs))
    table = [(p or "", fails(i, t or ""), i in good, i in toxic) for i, t, p in docs]
    out = []
    for part in {r[0] for r in table}:
        mine = [r for r in table if r[0] == part]
        lost = dict.fromkeys(range(5), 0)
        for order in permutations(range(5)):
            left = mine
            for step, f in enumerate(order):
                gone = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                lost[f] += len(gone)
                out.append([part, "".join("ABCDE"[i] for i in order), step + 1, len(left), len(gone), sum(r[1][f] for r in mine) - len(gone),
                            sum(r[1][f] and sum(r[1]) == 1 for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone), f])
        for row in out:
            if row[0] == part:
                row[-1] = lost["ABCDE".index(row[1][row[2] - 1])]
    return sorted(map(tuple, out))


def audit_docs():
    docs = [(1, "Fine words only " * 40, "en"), (2, "Fine words only " * 40, "en"), (2, "Fine words only " * 40, "en"), (3, " ".join(f"w{i}" for i in range(120)), "en"),
            (4, " ".join(f"w{i}" for i in range(120)), "de"), (5, None, "de"), (6, "", None), (None, "", None), (None, "SHOUT #1", "en"), (7, "SHOUT #1", ""), (8, "a|b", "xx"),
            (9, " ".join(f"Z{i}" for i in range(200)), "yy"), (-3, "x" * 100_000, "en"), (10, "Éé \U0001F600 A", "en"), (2, "other text", "en")]
    return docs + [(100 + i, rng.choice(["ok " * 150, "A b c", f"num {i} " * 60, " ".join(f"t{i}-{k}" for k in range(130)), "pay $5"]), rng.choice(["en", "de"])) for i in range(150)]


COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def run_audit(llm, docs, labels):
    from kiln.llm.filter_audit import audit
    from kiln.llm.queries import audit_filters
    df = llm.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("failing", F.lit("clash")).withColumn("id", F.lit(1)).repartition(4)
    marks = llm.createDataFrame(labels, "doc_id long, quality int, toxic int").select("doc_id", (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    return sorted(tuple(r[c] for c in COLUMNS) for r in rows(audit(df, audit_filters(), "E", marks, ["good", "toxic"])))


def test_audit_equals_brute_force(llm):
    docs = audit_docs()
    labels = [(i, int(i % 2 == 0), int(i % 3 == 0)) for i, _, _ in docs if i is not None and i > 1 and i % 5] + [(1, None, None), (None, 1, 1), (1, 1, 0)]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    assert run_audit(llm, docs, labels) == plain_audit(docs, good, toxic)


def test_audit_of_no_rows_and_of_one_hot_id(llm):
    assert run_audit(llm, [], []) == []
    docs = [(7, "pay $5", "en")] * 400 + [(8, " ".join(f"w{i}" for i in range(120)), "en")] * 100
    assert run_audit(llm, docs, [(7, 1, 1)]) == plain_audit(docs, {7}, {7})


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 15), st.integers(0, 3), st.integers(1, 5)), max_size=30))
def test_range_sizes_equal_sets(entries):
    from kiln.llm.filter_audit import range_sizes
    failing, marks, weight = (np.array([e[i] for e in entries], np.int64) for i in range(3))
    got = range_sizes(failing, marks, weight, 4, 2)
    for s in range(16):
        for f in range(4):
            added = [e for e in entries if e[0] >> f & 1 and not e[0] & s]
            want = [sum(e[2] for e in added), sum(e[2] for e in entries if e[0] & (s | 1 << f)), *[sum(e[2] for e in added if e[1] >> m & 1) for m in range(2)]]
            assert got[s, f].tolist() == ([0] * 4 if s >> f & 1 else want)


# 13 word runs

def plain_runs(w, shortest=6, exponent=4):
    found = {}
    for q in range(1, len(w)):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(shortest, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def some_words():
    k = rng.choice([1, 2, 2, 3, 5])
    w = [bytes([97 + rng.randrange(k)]) for _ in range(rng.randint(0, 60))]
    if rng.random() < .6:
        at = rng.randint(0, len(w))
        w = w[:at] + [bytes([97 + rng.randrange(k)]) for _ in range(rng.randint(1, 7))] * rng.randint(2, 9) + w[at:]
        w = w * rng.choice([1, 1, 2, 5])
    return w


@pytest.mark.parametrize("shortest,exponent", [(6, 4), (6, 3), (10, 5)])
def test_runs_equal_brute_force(shortest, exponent):
    from kiln.llm.periodic import runs_of
    for _ in range(60):
        texts = [some_words() for _ in range(5)]
        assert runs_of(texts, shortest, exponent) == [plain_runs(t, shortest, exponent) for t in texts]


def test_runs_of_very_long_texts():
    from kiln.llm.periodic import runs_of
    line = [b"%d" % i for i in range(12)]
    far = [x for _ in range(20_000) for x in [b"x%d" % rng.randrange(10**6), *line]]
    assert runs_of([[b"a"] * 150_000, line * 9_000, far]) == [[(0, 150_000, 1)], [(0, 108_000, 12)], []]


def planted(i, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(("" if i is None else str(i)).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]


def digests(i, text):
    w = planted(i, text)
    runs = plain_runs(w) if len(w) < 3_000 else [(s, n, q) for s, n, q in quick_runs(w)]
    drop = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    return (i, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in drop).encode()).hexdigest())


def quick_runs(w):
    """Plain runs of a long text whose periods are at most 40."""
    w = np.unique(np.array(w), return_inverse=True)[1]
    found = {}
    for q in range(1, 41):
        same = np.concatenate([[0], (w[:-q] == w[q:]).astype(int), [0]])
        at, to = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
        for i, j in zip(at.tolist(), to.tolist()):
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def test_run_query_equals_brute_force(llm, tmp_path):
    from kiln.llm.queries import QUERIES
    docs = [(i, t) for i, t, _ in ROWS if not (t and len(t) > 60_000 and planted(i, t) != WORD.findall(t))]
    docs += [(1000 + i, rng.choice([" ", "\n", "\t "]).join(x.decode() for x in some_words())) for i in range(250)] + [(None, "a b a b a b a b a b"), (1000, "a")]
    llm.createDataFrame(docs, "doc_id long, text string").withColumn("runs", F.lit(1)).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = [tuple(r[c] for c in names) for r in rows(QUERIES["op13_word_runs"](llm, str(tmp_path)))]
    def key(r):
        return tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted([digests(i, t) for i, t in docs], key=key)
    assert sum(r[1] > 0 for r in got) > 50


def test_runs_keep_columns_and_empty_tables(llm, odd, none):
    from kiln.llm.periodic import periodic_runs
    got = periodic_runs(odd.withColumn("collapsed", F.lit(1)))
    assert got.columns == [*odd.columns, "runs", "collapsed"] and got.count() == len(ROWS)
    by = {r["doc_id"]: r for r in rows(got)}
    assert [tuple(x) for x in by[15]["runs"]] == [(0, 1500, 3)] and by[15]["collapsed"] == "a b c"
    assert [tuple(x) for x in by[10]["runs"]] == [(0, 24_000, 3)] and by[5]["collapsed"] == ""
    assert periodic_runs(none).count() == 0
