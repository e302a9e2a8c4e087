"""Rule search against brute force over all conjunctions."""

from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.operators import explain, rules


def table(spark, n=400):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(n):
        a, b, c = float(rng.integers(0, 30)), float(rng.normal()), "xyz"[rng.integers(0, 3)]
        hit = (a > 20 and c == "y") or rng.random() < 0.1
        rows.append((None if i % 19 == 0 else a, b, None if i % 23 == 0 else c, 5.0, bool(hit) if i % 31 else None))
    return rows, spark.createDataFrame(rows, "a double, b double, c string, one double, hit boolean")


def brute(rows, bins, max_terms, least):
    names = ["a", "b", "c", "one"]
    terms = []
    for col in ("a", "b", "one"):
        x = [r[names.index(col)] for r in rows if r[names.index(col)] is not None]
        cuts = sorted({round(float(q), 6) for q in np.quantile(x, [i / bins for i in range(1, bins)])})
        ends = [None, *cuts, None]
        for i in range(len(ends) - 1):
            for j in range(i + 1, len(ends)):
                if (i, j) != (0, len(ends) - 1):
                    lo, hi = ends[i], ends[j]
                    text = " AND ".join([f"{col} > {lo!r}"] * (lo is not None) + [f"{col} <= {hi!r}"] * (hi is not None))
                    ok = {k for k, r in enumerate(rows) if (v := r[names.index(col)]) is not None
                          and (lo is None or v > lo) and (hi is None or v <= hi)}
                    terms.append((("a", "b", "one", "c").index(col), text, ok))
    for v in "xyz":
        terms.append((3, f"c = '{v}'", {k for k, r in enumerate(rows) if r[2] == v}))
    hits = {k for k, r in enumerate(rows) if r[4]}
    out = []
    for size in range(1, max_terms + 1):
        for combo in combinations(sorted(terms, key=lambda t: t[0]), size):
            if len({t[0] for t in combo}) < size:
                continue
            covered = set.intersection(*[t[2] for t in combo])
            if covered and len(covered) >= least * len(rows):
                out.append((-Fraction(len(covered & hits), len(covered)), -len(covered), size, " AND ".join(t[1] for t in combo)))
    return sorted(out)


def test_exhaustive_pairs_agree_with_brute_force(spark):
    rows, df = table(spark)
    want = brute(rows, 5, 2, 0.02)
    got, total = rules.search_rules(df, F.col("hit"), ["a", "b", "one"], ["c"], bins=5, max_terms=2, beam=10_000, min_coverage=0.02)
    assert total == len(rows)
    assert [(-Fraction(h, n), -n, len(r), " AND ".join(map(str, r))) for r, n, h in got] == want


def test_beam_finds_the_planted_rule_and_its_counts_hold(spark):
    _, df = table(spark)
    out = rules.rule_search(df, F.col("hit"), ["a", "b"], ["c"], bins=6, beam=15, min_coverage=0.05, top=5).collect()
    assert [r["rank"] for r in out] == [1, 2, 3, 4, 5]
    assert "c = 'y'" in out[0]["rule"] and "a > " in out[0]["rule"]
    found, total = rules.search_rules(df, F.col("hit"), ["a", "b"], ["c"], bins=6, beam=15, min_coverage=0.05)
    for rule, n, h in found[:4]:
        s = explain.rule_stats(df, F.coalesce(rules.rule_column(rule), F.lit(False)), F.coalesce(F.col("hit"), F.lit(False))).first()
        assert (s["n_covered"], s["coverage"], s["precision"]) == (n, pytest.approx(n / total), pytest.approx(h / n))


def test_empty_and_repeated_rows(spark):
    _, df = table(spark, 120)
    assert rules.rule_search(df.filter("b > 1e9"), F.col("hit"), ["a", "b"], ["c"]).count() == 0
    once = rules.rule_search(df, F.col("hit"), [], ["c"], max_terms=1).collect()
    twice = rules.rule_search(df.unionAll(df), F.col("hit"), [], ["c"], max_terms=1).collect()
    assert [(r["rule"], r["precision"]) for r in once] == [(r["rule"], r["precision"]) for r in twice]
    assert [2 * r["n_covered"] for r in once] == [r["n_covered"] for r in twice]
    single = rules.rule_search(df, F.col("hit"), ["one"], []).collect()
    assert [(r["rule"], r["coverage"]) for r in single] == [("one <= 5.0", 1.0)]
