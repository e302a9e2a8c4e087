"""Each operator against a plain version, over odd rows and over no rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from .conftest import ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(df):
    return [r.asDict() for r in df.collect()]


# 1 MaxScore

def plain_top(vectors, k):
    ints = {i: [math.floor(256 * float(x)) for x in v] for i, v in vectors}
    out = []
    for q in ints:
        if q % 2 == 0:
            best = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("shard,block,k", [(16, 7, 5), (4096, 4096, 3), (40, 4, 200)])
def test_maxscore_equals_brute_force(llm, shard, block, k):
    from kiln.llm.maxscore import top_k
    rng = np.random.default_rng(3)
    vectors = [(i, [float(x) for x in np.round(rng.normal(0, .2, 8), 2)]) for i in range(120)]
    vectors += [(200 + i, vectors[4][1]) for i in range(30)]  # ties
    vectors += [(300, [0.0] * 8), (302, [-.5] * 8)]
    bad = [(400, None), (402, []), (404, [1.0, None]), (406, [float("nan")] * 8), (408, [float("inf")] * 8), (None, [1.0] * 8)]
    df = llm.createDataFrame([*vectors, *bad, vectors[0]], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 2 == 0, k, shard=shard, block=block).collect())
    assert got == plain_top(vectors, k)
    assert top_k(df.limit(0), F.col("vec_id") % 2 == 0, k).count() == 0


def test_maxscore_probes_fewer_documents_than_all(llm):
    from kiln.llm.maxscore import Postings
    rng = np.random.default_rng(0)
    v = rng.integers(-3, 4, (2000, 16)) * (rng.random((2000, 16)) < .2)
    v[:40] *= 30
    index, ids = Postings(v.astype(float)), np.arange(2000)
    for q in v[50:90].astype(float):
        at, score = index.search(q, 5, -1, ids)
        assert np.array_equal(np.sort(v @ q)[::-1][:5], score)


# 2 rule ensemble

def test_rule_ensemble_learns_and_handles_odd_rows(llm, odd, none):
    from kiln.llm import quality
    good = [(100 + i, f"some calm text number {i} that says a little, and ends.") for i in range(60)]
    junk = [(200 + i, "BUY!! NOW!! CHEAP!! " * (3 + i % 5)) for i in range(60)]
    docs = llm.createDataFrame([*good, *junk], "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    labels = llm.createDataFrame([(i, int(i < 200)) for i, _ in good + junk if i % 3] + [(None, 1), (999, None)], "doc_id long, quality int")
    got = {r["doc_id"]: r["score"] for r in rows(quality.score(docs, labels))}
    assert all(got[i] > .7 for i, _ in good) and all(got[i] < .3 for i, _ in junk)
    assert all(0 <= s <= 1 for s in got.values())
    assert quality.score(docs, labels).count() == docs.count()
    assert quality.score(none, labels).count() == 0
    assert {r["score"] for r in rows(quality.score(odd, labels.limit(0)))} == {0.5}


def test_tree_paths():
    from kiln.llm.quality import paths
    text = """DecisionTree
  If (feature 0 <= 0.5)
   If (feature 0 <= 0.25)
    Predict: 0.0
   Else (feature 0 > 0.25)
    Predict: 1.0
  Else (feature 0 > 0.5)
   Predict: 1.0"""
    assert paths(text) == {((0, False, .5),), ((0, False, .25),), ((0, False, .5), (0, True, .25)), ((0, True, .5),)}


# 3 BPE

def test_bpe_equals_library_and_round_trips(odd, none):
    import tiktoken  # noqa: F401
    from kiln.llm.bpe import decode, encode, encoding
    from kiln.llm.queries import bpe_file, bpe_pattern
    enc = encoding(open(bpe_file(), "rb").read(), bpe_pattern())
    want = Counter()
    for i, t, _ in ROWS:
        ids = enc.encode_ordinary(t or "")
        want[i, len(ids), np.array(ids, "<u4").tobytes(), (t or "").encode()] += 1
    coded = encode(odd, bpe_file(), bpe_pattern(), decoded="decoded")
    assert Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"]), bytes(r["decoded"])) for r in rows(coded)) == want
    again = decode(coded.drop("decoded"), bpe_file(), bpe_pattern())
    assert Counter(bytes(r["decoded"]) for r in rows(again)) == Counter((t or "").encode() for _, t, _ in ROWS)
    assert encode(none, bpe_file(), bpe_pattern()).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "\u3000", "\x1c", "\x85", "a", "don't", "'s", "12", "!?", "\u00e9", "\U0001F600", " x"]), max_size=60))
def test_bpe_pieces_never_cross_a_match(parts):
    import regex
    from kiln.llm import bpe
    from kiln.llm.queries import bpe_pattern
    white = bpe.WHITE
    text = "".join(parts)
    cut = list(bpe.pieces(text, 7))
    assert "".join(p for p, _ in cut) == text
    pattern = regex.compile(bpe_pattern().replace(r"\s", f"[{white}]").replace(r"\S", f"[^{white}]").replace(f"[^[{white}]", f"[^{white}"))
    assert [m for p, _ in cut for m in pattern.findall(p)] == pattern.findall(text)


def test_bpe_takes_a_white_run_the_library_cannot():
    from kiln.llm.bpe import encode_text, encoding
    from kiln.llm.queries import bpe_file, bpe_pattern
    enc = encoding(open(bpe_file(), "rb").read(), bpe_pattern())
    text = "a" + " " * 2_000_000 + "b"
    assert enc.decode_bytes(encode_text(enc, text).tolist()) == text.encode()
    short = "a" + " " * 9_000 + "b"
    assert encode_text(enc, short).tolist() == enc.encode_ordinary(short)


# 4 sharding

def test_ring_shards(llm, odd, none):
    from kiln.llm.sharding import assign
    got = rows(assign(odd, 4))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in ROWS)
    per = Counter(r["shard"] for r in got)
    assert max(per.values()) - min(per.get(s, 0) for s in range(4)) <= 1
    for s in per:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(per[s]))
    assert sorted(map(str, got)) == sorted(map(str, rows(assign(odd.repartition(1), 4))))
    assert assign(none, 4).count() == 0


def test_ring_hot_key_and_movement(llm):
    from kiln.llm.sharding import assign
    df = llm.range(6000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    got = rows(assign(df, 5))
    assert sorted(Counter(r["shard"] for r in got).values()) == [1200] * 5
    plain = llm.range(6000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    a, b = ({r["doc_id"]: r["shard"] for r in rows(assign(plain, n))} for n in (16, 17))
    moved = sum(a[i] != b[i] for i in a)
    assert moved < 6000 * .3  # 1/17 must move, the rest is overflow that settles elsewhere
    assert all(r["hops"] > 0 or r["shard"] == r["home_shard"] for r in rows(assign(plain, 16)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=6, max_size=6))
def test_settle_places_every_row_once(counts):
    from kiln.llm.sharding import quotas, settle
    owner, quota = [0, 1, 2, 0, 2, 1], quotas(sum(counts), 3)
    out = settle(counts, owner, quota)
    for a, n in enumerate(counts):
        spans = sorted((p["lo"], p["hi"]) for p in out if p["arc"] == a)
        assert [x for lo, hi in spans for x in range(lo, hi)] == list(range(n))
    for s in range(3):
        slots = sorted(x for p in out if p["shard"] == s for x in range(p["slot0"], p["slot0"] + p["hi"] - p["lo"]))
        assert slots == list(range(quota[s]))


# 5 mixing

def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        if not rest:
            return {s: 3.0 * sizes[s] for s in names}
        left = total - sum(3 * sizes[s] for s in full)
        level = left / sum(weight[s] for s in rest)
        over = {s for s in rest if level * weight[s] > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= over


def test_mixing_meets_targets(llm, odd, none):
    from kiln.llm.mixing import mix, repeated, taken
    rng = np.random.default_rng(1)
    more = [(1000 + i, " ".join(["w"] * int(rng.integers(1, 40))), f"s{int(rng.integers(0, 6)) ** 2 % 7}") for i in range(800)]
    more += [(5000, "same words again and again", "s1")] * 300
    docs = llm.createDataFrame([*((i, t, s) for i, t, s in ROWS), *more], "doc_id long, text string, source string")
    sizes = Counter()
    for i, t, s in [*ROWS, *more]:
        sizes[s] += len(WORD.findall(t or ""))
    want, got = plain_targets(sizes), rows(taken(mix(docs)))
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in got) == Counter((i, len(WORD.findall(t or "")), s) for i, t, s in [*ROWS, *more])
    per = Counter()
    for r in got:
        per[r["source"]] += r["taken"]
        assert r["taken"] <= 3 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
    for s in sizes:
        if s not in ("d", "\U0001F600"):  # sources of a few large documents cannot be fitted
            assert abs(per[s] - want[s]) <= 8
    assert sorted(map(str, got)) == sorted(map(str, rows(taken(mix(docs.repartition(5))))))
    full = repeated(docs)
    assert full.columns == docs.columns
    assert sum(len(WORD.findall(r["text"] or "")) for r in rows(full)) == sum(r["taken"] for r in got)
    assert mix(none).count() == 0 and repeated(none).count() == 0 and repeated(odd).columns == odd.columns


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 4), max_size=6), st.integers(0, 60))
def test_subset_sum_is_best(items, budget):
    from kiln.llm.mixing import subset_sum
    reach = {0}
    for n, c in items.items():
        reach = {x + n * j for x in reach for j in range(c + 1)}
    got = subset_sum(list(items.items()), budget)
    assert all(got[n] <= items[n] for n in got)
    assert sum(n * c for n, c in got.items()) == max(x for x in reach if x <= budget)


def test_one_huge_document_leaves_no_budget_unused():
    from kiln.llm.mixing import fit
    lengths, counts = [*range(50, 150), 10_000_000], [1_000] * 100 + [1]
    for budget in (6_000_000, 9_000_000, 9_950_000):
        take = fit(lengths, counts, budget, "s")
        assert sum(n * k for n, k in zip(lengths, take)) == budget
        assert all(0 <= k <= c for k, c in zip(take, counts))
    assert fit([0, 7], [5, 0], 10, "s") == [0, 0]


# 6 fingerprints

def test_fingerprints(odd, none):
    from kiln.llm.sketch import fingerprints
    got = rows(fingerprints(odd))
    assert len(got) == len(ROWS)
    assert Counter((r["doc_id"], r["n_chars"]) for r in got) == Counter((i, len(t or "")) for i, t, _ in ROWS)
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
    one = [r for r in got if r["doc_id"] in (1, 2)]
    assert len({r["fingerprint"] for r in one}) == 1
    by = {r["doc_id"]: r for r in got if r["doc_id"]}
    texts = {i: t or "" for i, t, _ in ROWS}
    assert by[15]["edited_sha256"] == hashlib.sha256((texts[15][:1500] + texts[14][:1500]).encode()).hexdigest()
    assert by[4]["near_edited"] == 1.0 and by[5]["near_next"] == 1.0
    assert fingerprints(none).count() == 0


def test_next_document_across_ranges(llm, monkeypatch):
    from kiln.llm import sketch
    monkeypatch.setattr(sketch, "RANGE_ROWS", 10)
    monkeypatch.setattr(sketch, "CHUNK_CHARS", 50)
    texts = [f"line {i}\n" * (1 + i % 7) for i in range(95)]
    df = llm.createDataFrame([(i * 3 - 20, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["edited_sha256"] for r in rows(sketch.fingerprints(df))}
    for i, t in enumerate(texts):
        assert got[i * 3 - 20] == hashlib.sha256(sketch.edited(t, texts[i - 1]).encode()).hexdigest()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abcdefghij"), max_size=40), st.lists(st.sampled_from("abcdefxyz"), max_size=40)), min_size=1, max_size=5))
def test_peeling_recovers_the_difference(pairs):
    from kiln.llm.sketch import Sets, differences, peel, sketches
    a, b = (Sets(["\n".join(p[i]).encode() for p in pairs]) for i in (0, 1))
    at = np.arange(len(pairs))
    want = [sum(((Counter(x) - Counter(y)) + (Counter(y) - Counter(x))).values()) for x, y in pairs]
    assert differences(a, at, b, at).tolist() == want
    table = tuple(x - y for x, y in zip(sketches(a, at, 3 * 256), sketches(b, at, 3 * 256)))
    row, key, side, done = peel(table, 3 * 256)
    for i in at[done]:
        ka, kb = set(a.keys[a.ends[i]:a.ends[i + 1]].tolist()), set(b.keys[b.ends[i]:b.ends[i + 1]].tolist())
        assert {(int(k), int(s)) for r, k, s in zip(row, key, side) if r == i} == {(k, 1) for k in ka - kb} | {(k, -1) for k in kb - ka}


# 7 near duplicates

def plain_components(docs):
    sets, parent = {}, {}
    for i, t in docs:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        parent[i] = i

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                a, b = top(x), top(y)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in ids}


def test_near_duplicates_equal_brute_force(llm):
    from kiln.llm.neardup import deduplicated, link
    rng = np.random.default_rng(5)
    docs, i = [], 0
    for g in range(40):
        base = [f"w{int(x)}" for x in rng.integers(0, 3000, int(rng.integers(1, 120)))]
        for _ in range(int(rng.integers(1, 8))):
            w = list(base)
            for _ in range(int(rng.integers(0, 3))):
                w[int(rng.integers(0, len(w)))] = f"x{int(rng.integers(0, 9999))}"
            docs.append((i, " ".join(w)))
            i += 1
    df = llm.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows(link(df))}
    want = plain_components(docs)
    assert got == {k: (n, c, c == k) for k, (n, c) in want.items()}
    assert {r["doc_id"] for r in rows(deduplicated(df))} == {k for k, (_, c) in want.items() if c == k}


def test_near_duplicates_in_a_crowd_below_the_threshold(llm):
    from kiln.llm.neardup import link
    rng = np.random.default_rng(11)

    def tail(n):
        return [f"w{x}" for x in rng.integers(0, 10**12, n)]

    head, texts, pairs = [f"t{i}" for i in range(169)], [], []
    for i in range(2000):  # 165 common shingles of 200: 0.70
        texts.append(head + (texts[-1][169:178] if i % 20 == 1 else []) + tail(26 if i % 20 == 1 else 35))
        if i % 20 == 1:  # 174 of 200: 0.77
            pairs.append((i - 1, i))
    df = llm.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in link(df).collect()}
    want = {i: i for i in range(2000)} | {b: a for a, b in pairs}
    assert got == want


def test_exact_links_of_a_hot_crowd_equal_brute_force(llm, monkeypatch):
    from kiln.llm import neardup
    monkeypatch.setattr(neardup, "CELL", 16)
    rng = np.random.default_rng(5)
    base, sets = rng.integers(0, 2**60, 200), {}
    for i in range(90):  # every document keeps its own part of the common shingles
        keep = base[rng.random(200) > rng.choice([.05, .09, .2])]
        sets[i] = np.unique(np.append(keep, rng.integers(0, 2**60, rng.integers(5, 40))))
    like = np.array([[len(np.intersect1d(a, b)) / len(np.union1d(a, b)) for b in sets.values()] for a in sets.values()])
    edges = {(i, j) for i in range(90) for j in range(i) if like[i, j] >= .75}
    left = llm.createDataFrame([(i, i) for i in sets], "rep long, comp long")
    docs = llm.createDataFrame([(i, [int(x) for x in v]) for i, v in sets.items()], "rep long, shingles array<bigint>")
    got = {(max(r), min(r)) for r in neardup.exact_links(left, docs).collect()}

    def roots(edges):
        root = {i: i for i in sets}

        def find(i):
            while root[i] != i:
                i = root[i]
            return i
        for a, b in edges:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        return {i: find(i) for i in sets}
    assert 0 < len(edges) < 90 * 89 // 2 and roots(got) == roots(edges)


def test_near_duplicates_odd_rows(odd, none):
    from kiln.llm.neardup import deduplicated, link
    got = rows(link(odd))
    assert len(got) == len(ROWS)
    by = {r["doc_id"]: r for r in got if r["doc_id"]}
    assert [by[i]["component_id"] for i in (1, 2, 3)] == [1, 1, 1]
    assert [(by[i]["n_shingles"], by[i]["component_id"], by[i]["kept"]) for i in (4, 5, 6)] == [(0, i, True) for i in (4, 5, 6)]
    kept = Counter(r["doc_id"] for r in rows(deduplicated(odd)))
    assert kept[1] == 1 and not kept[2] and not kept[3] and kept[None] == 2 and kept[9] == 1
    assert link(none).count() == 0 and deduplicated(none).count() == 0


def test_components_of_a_long_chain(llm):
    from kiln.llm.neardup import components
    links = llm.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    roots = {}
    for r in rows(components(links)):
        roots.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(len, roots.values())) == [2, 201]


# 8 URL filter

def test_url_rules(llm, none):
    from kiln.llm.queries import URL_RULES
    from kiln.llm.url_filter import judge
    urls = [None, "", "nothing", "http://", "https://Example.ORG/es/x", "http://a.b.example.org/en/12?q#f", "http://example.org?x", "ftp://x.com/fr/",
            "http://com/de/", "http://notexample.org/es/", "a://b://c.org/", "http://x.net/es/", "http://example.org/en/2", "http://example.org/en/2"]
    rules = llm.createDataFrame(list(URL_RULES), "verdict string, host string, path string")
    pages = llm.createDataFrame([(i % 9, u) for i, u in enumerate(urls)], "page_id long, url string").withColumn("rule", F.lit(1)).withColumn("r_host", F.lit("q"))

    def plain(u):
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].translate(LOWER), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *(max(fits)[1:] if fits else (None, "allow")))
    got = Counter((r["url"], r["host"], r["path"], r["rule"], r["verdict"]) for r in rows(judge(pages, rules)))
    assert got == Counter((u, *plain(u)) for u in urls)
    assert {r["verdict"] for r in rows(judge(pages, rules.limit(0), default="block"))} == {"block"}
    assert judge(pages.limit(0), rules).count() == 0


def test_bloom_filter_has_no_false_negatives(llm):
    from kiln.llm.url_filter import _block, _mask, bloom_filter
    keys = llm.range(3000).select(F.xxhash64("id").alias("k"))
    bloom, blocks = bloom_filter(keys, "k", 750), 750
    word, mask = F.element_at(bloom, (_block(F.col("k"), blocks) + 1).cast("int")), _mask(F.col("k"))
    hit = (word.bitwiseAND(mask) == mask).cast("int")
    assert keys.agg(F.min(hit)).first()[0] == 1
    others = llm.range(10_000, 20_000).select(F.xxhash64("id").alias("k"))
    assert others.agg(F.avg(hit)).first()[0] < .05


# 9 HMM

def test_hmm_scores(llm, odd, none):
    from kiln.llm.common import crc_bucket
    from kiln.llm.hmm import score
    train = crc_bucket(F.col("doc_id"), 5) != 1
    got = rows(score(odd, train))
    tokens = [(i, [*WORD.findall((t or "").translate(LOWER)), None]) for i, t, _ in ROWS]
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in tokens}
    c = Counter(w for i, ws in tokens if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), len(ws), sum(c[w] > 0 for w in ws), round(sum(math.log10((c[w] + .5) / (n + .5 * (v + 1))) for w in ws), 4), held[i]) for i, ws in tokens)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 4), r["held_out"]) for r in got) == want
    assert {r["train_tokens"] for r in got} == {n} and all(r["score"] < 0 for r in got)
    assert score(none, train).count() == 0
    assert {round(r["base_score"], 9) for r in rows(score(odd, F.lit(False)))} == {0.0}


def test_expected_counts_equal_plain_forward_backward():
    from kiln.llm import hmm
    rng = np.random.default_rng(8)
    texts = [rng.integers(0, 30, n) for n in (1, 63, 64, 65, 130, 300)]
    tokens = np.bincount(np.concatenate(texts), minlength=hmm.CLASSES).astype(float)
    model = hmm.Model.initial(tokens, states=3)
    model.move = np.array([[.98, .01, .01], [.01, .98, .01], [.01, .01, .98]])
    into = (np.zeros(3), np.zeros((3, 3)), np.zeros((hmm.CLASSES, 3)))
    hmm.expected(model, [t.astype("<u2").tobytes() for t in texts], into)
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((hmm.CLASSES, 3))
    for x in texts:
        alpha, beta = [model.start * model.emit[x[0]]], [np.ones(3)]
        for o in x[1:]:
            a = alpha[-1] @ model.move * model.emit[o]
            alpha.append(a / a.sum())
        for o in x[:0:-1]:
            b = model.move @ (model.emit[o] * beta[0])
            beta.insert(0, b / b.sum())
        gamma = [a * b / (a * b).sum() for a, b in zip(alpha, beta)]
        start += gamma[0]
        for o, g in zip(x, gamma):
            emit[o] += g
        for t in range(1, len(x)):
            xi = np.outer(alpha[t - 1], model.emit[x[t]] * beta[t]) * model.move
            move += xi / xi.sum()
    assert all(np.allclose(a, b) for a, b in zip(into, (start, move, emit)))


def test_texts_are_walked_in_lots_of_like_lengths(monkeypatch):
    import pyarrow as pa

    from kiln.llm import hmm
    rng = np.random.default_rng(3)
    seqs = [rng.integers(0, 30, 900 if i % 100 == 50 else int(rng.integers(1, 30))).astype("<u2").tobytes() for i in range(400)]
    lots = list(hmm._chunks([pa.RecordBatch.from_arrays([pa.array(seqs, pa.binary())], names=["classes"])], 0, 1500))
    assert sorted(s for lot in lots for s in lot) == sorted(seqs)
    assert sum(max(map(len, lot)) // 2 for lot in lots) < 2 * 900 + 30 * len(lots)  # not 900 steps in every lot
    tokens = np.bincount(np.frombuffer(b"".join(seqs), "<u2"), minlength=hmm.CLASSES).astype(float)
    model = hmm.Model.initial(tokens, states=3)
    found = []
    for held in (hmm.HELD, 0):  # kept whole, and in blocks run again
        monkeypatch.setattr(hmm, "HELD", held)
        into = (np.zeros(3), np.zeros((3, 3)), np.zeros((hmm.CLASSES, 3)))
        found.append((sum(hmm.expected(model, lot, into) for lot in lots), *into))
        assert hmm.likelihood(model, seqs).sum() == pytest.approx(found[-1][0])
    assert all(np.allclose(a, b) for a, b in zip(*found))


def test_words_are_hashed_once_a_batch(monkeypatch):
    import xxhash

    from kiln.llm import hmm
    plain, seen = xxhash.xxh3_64_intdigest, []
    monkeypatch.setattr(xxhash, "xxh3_64_intdigest", lambda w: seen.append(w) or plain(w))
    h, tail, at = hmm.words([b"One two ONE", None, b"two\tthree"])
    assert seen == [b"one", b"two", b"three"] and [list(i) for i in at] == [[0, 1, 0], [], [1, 2]]
    assert h.tolist() == [np.uint64(plain(w)).astype(np.int64) for w in seen] and len(tail) == 3


def test_every_training_round_sees_every_document(llm, monkeypatch):
    from types import SimpleNamespace

    from kiln.llm import hmm
    rng = np.random.default_rng(4)
    seqs = [np.append(rng.integers(1, 9, 20), 0).astype("<u2").tobytes() for _ in range(20)]
    df = llm.createDataFrame([(s,) for s in seqs], "classes binary").crossJoin(llm.range(200)).select("classes").repartition(4)
    tokens = 200.0 * np.bincount(np.frombuffer(b"".join(seqs), "<u2"), minlength=hmm.CLASSES)
    seen, plain = [], hmm.baum_welch

    def counted(model, sequences, class_tokens):
        seen.append(sequences.count())
        return plain(model, sequences, class_tokens)
    monkeypatch.setattr(hmm, "baum_welch", counted)
    model = hmm.trained(df, SimpleNamespace(class_tokens=tokens), 4000)
    assert set(seen) == {4000} and len(seen) > 2
    ll = hmm.likelihood(model, seqs).sum()
    assert abs(hmm.likelihood(plain(model, df, tokens)[0], seqs).sum() - ll) <= 2 * hmm.SETTLED * abs(ll)


def test_forward_is_exact_and_training_raises_likelihood():
    from kiln.llm import hmm
    rng = np.random.default_rng(2)
    seqs = [np.append(rng.choice([1, 2, 3] if i % 2 else [4, 5, 6], int(rng.integers(1, 150))), 0).astype("<u2").tobytes() for i in range(40)]
    tokens = np.bincount(np.frombuffer(b"".join(seqs), "<u2"), minlength=hmm.CLASSES).astype(float)
    model = hmm.Model.initial(tokens, states=3)
    plain = []
    for s in seqs:
        a = None
        total = 0.0
        for o in np.frombuffer(s, "<u2"):
            a = (model.start if a is None else a @ model.move) * model.emit[o]
            total += math.log(a.sum())
            a = a / a.sum()
        plain.append(total)
    assert np.allclose(hmm.likelihood(model, seqs), plain)
    last = sum(plain)
    for _ in range(5):
        into = (np.zeros(3), np.zeros((3, 3)), np.zeros((hmm.CLASSES, 3)))
        hmm.expected(model, seqs, into)
        assert into[2].sum() == pytest.approx(sum(len(s) // 2 for s in seqs)) and into[0].sum() == pytest.approx(len(seqs))
        assert into[1].sum() == pytest.approx(sum(len(s) // 2 - 1 for s in seqs))
        model = hmm.Model.maximised(*into, tokens)
    assert hmm.likelihood(model, seqs).sum() > last


# 10 personal data

def luhn(d):
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def plain_spans(t):
    out = []
    for kind, p in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) < 256 for x in m[0].split("."))
                    or kind == "card" and 13 <= len(d) <= 19 and luhn(d) or kind == "phone" and 9 <= len(d) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


PARTS = ["a", "B9", "@", ".", "..", "_", "%", "-", " ", "  ", "1", "25", "255", "256", "0007", "+", "+4", "(", ")", "4111 1111 1111 1111", "4111-1111-1111-1111",
         "10.0.0.1", "x@y.z", "a@b.c_d@e.f", "\u00e9", "\U0001F600", "\n", "123456789012", "+1 (386) 555-3733"]


def test_base_spans_equal_plain_patterns(llm):
    from kiln.llm.pii import base_spans, listed
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(PARTS, int(rng.integers(0, 30)))) for _ in range(1500)] + [t or "" for _, t, _ in ROWS]
    df = llm.createDataFrame([(t,) for t in texts], "t string").select("t", listed(base_spans(F.col("t"))).alias("s"))
    assert [(r["t"], r["s"]) for r in rows(df)] == [(t, plain_spans(t)) for t in texts]


def test_long_runs_do_not_hurt(llm):
    from kiln.llm.pii import base_spans, listed
    texts = ["a" * 300_000 + " @", "1" * 300_000 + ".", "a@b" + ".c" * 50_000, "+1" + " " * 100_000, "1 " * 50_000]
    df = llm.createDataFrame([(t,) for t in texts], "t string").select(listed(base_spans(F.col("t"))).alias("s"))
    assert [r["s"] for r in rows(df)] == ["", "", "email:0:100003", "", ""]


def test_disclosing_terms_are_found_and_removed(llm, odd, none):
    from kiln.llm.pii import detect, sanitised
    told = [(i, f"report {i} mentions zanzibar office bob@corp.example.com today number {i}") for i in range(6)]
    plain = [(100 + i, f"report {i} mentions another office today number {i} and so on") for i in range(200)]
    df = llm.createDataFrame([*told, *plain], "doc_id long, text string")
    got = {r["doc_id"]: r for r in rows(detect(df).select("*", sanitised(F.col("text"), F.col("spans")).alias("clean")))}
    for i, t in told:
        words = {t[s["start"]:s["end"]] for s in got[i]["spans"] if s["kind"] == 4}
        assert words == {"zanzibar"}
        assert got[i]["clean"] == t.replace("zanzibar", "").replace("bob@corp.example.com", "[EMAIL]")
    assert all(not got[i]["spans"] and got[i]["clean"] == t for i, t in plain)
    found = rows(detect(odd))
    assert len(found) == len(ROWS) and detect(none).count() == 0
    by = {r["doc_id"]: r for r in found}
    assert [s["kind"] for s in by[8]["spans"]][:3] == [0, 1, 2]


# the pipeline

def test_pipeline_stages(llm, tmp_path):
    import corpus_pipeline as c
    from kiln.llm.common import materialize, read
    sf = "/root/testdata/sf0.001"
    docs = read(llm, sf, "documents")
    before, start = docs, docs.columns
    for name, stage in c.STAGES:
        after = materialize(stage(llm, before, sf), f"test-{name}")
        if name == "quality":
            labels = {r["doc_id"]: r["quality"] for r in rows(read(llm, sf, "labels"))}
            kept = {r["doc_id"] for r in rows(after)}
            judged = [(i in kept) == bool(labels[i]) for i in labels]
            assert sum(judged) >= .97 * len(judged)
        if name == "near_duplicates":
            want = plain_components([(r["doc_id"], r["text"]) for r in rows(before)])
            assert {r["doc_id"] for r in rows(after)} == {i for i, (_, top) in want.items() if top == i}
        if name == "pii":
            assert after.count() == before.count() and not any(plain_spans(r["text"]) for r in rows(after))
        if name == "mix":
            a, b = (Counter(r["doc_id"] for r in rows(x)) for x in (before, after))
            assert set(b) <= set(a) and max(b.values()) <= 3
        if name == "bpe":
            texts = Counter((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in rows(before))
            assert Counter((r["doc_id"], r["decoded_sha256"]) for r in rows(after)) == texts
        else:
            assert after.columns == start
        before = after


def test_pipeline_odd_and_empty_tables(llm, odd, none):
    import corpus_pipeline as c
    docs = odd.withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
    for name, stage in c.STAGES:
        for df in (docs, docs.limit(0)):
            out = stage(llm, df, "/root/testdata/sf0.001")
            out.count()
            assert name == "bpe" or out.columns == docs.columns
