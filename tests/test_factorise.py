"""Biased factorisation against plain alternating least squares."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.operators import factorise, metrics


def ratings(users=30, items=25, seed=0, noise=0.1):
    rng = np.random.default_rng(seed)
    bu, bi, p, q = rng.normal(0, .5, users), rng.normal(0, .5, items), rng.normal(0, .6, (users, 2)), rng.normal(0, .6, (items, 2))
    return [(u, f"i{i}", float(np.clip(3 + bu[u] + bi[i] + p[u] @ q[i] + rng.normal(0, noise), 1, 5)))
            for u in range(users) for i in range(items) if u == 0 or rng.random() < .6]


def plain(rows, starts, reg, rounds):
    mean = np.mean([r for *_, r in rows])
    items, users = dict(starts), {}

    def half(fixed, mine, theirs):
        out = {}
        for key in {x[mine] for x in rows}:
            own = [x for x in rows if x[mine] == key]
            x = np.array([[1.0, *fixed[o[theirs]][1:]] for o in own])
            y = np.array([o[2] - mean - fixed[o[theirs]][0] for o in own])
            out[key] = np.linalg.solve(x.T @ x + reg * len(own) * np.eye(x.shape[1]), x.T @ y)
        return out

    for _ in range(rounds):
        users = half(items, 0, 1)
        items = half(users, 1, 0)
    return mean, users, items


@pytest.mark.parametrize("chunk", [4096, 5])
def test_equals_plain_least_squares(spark, monkeypatch, chunk):
    """Also with users and items cut into chunks of five ratings."""
    monkeypatch.setattr(factorise, "CHUNK", chunk)
    rows = ratings()
    df = spark.createDataFrame(rows, "u long, i string, r double").repartition(3)
    starts = {r.i: list(r.w) for r in df.select("i").distinct().withColumn("w", factorise.start(F.col("i"), 3)).collect()}
    mean, users, items = plain(rows, starts, 0.05, 3)
    got = factorise.biased_factors(df, "u", "i", "r", rank=3, reg=0.05, rounds=3)
    assert got.mean == pytest.approx(mean)
    assert {r.id for r in got.users.collect()} == users.keys()
    assert all(np.allclose(r.w, users[r.id], atol=1e-8) for r in got.users.collect())
    assert all(np.allclose(r.w, items[r.id], atol=1e-8) for r in got.items.collect())


@pytest.mark.parametrize("few", [0, 8192])
def test_half_step_shuffles_sums_or_ratings_without_vectors(spark, monkeypatch, few):
    """With many rows on both sides, sums of a batch stand for its ratings; otherwise the
    vectors are met where the ratings were dealt to.  Both are plain least squares."""
    monkeypatch.setattr(factorise, "FEW", few)
    rows = ratings(40, 6)
    df = spark.createDataFrame(rows, "u long, i string, r double").repartition(2)
    starts = {r.i: list(r.w) for r in df.select("i").distinct().withColumn("w", factorise.start(F.col("i"), 2)).collect()}
    _, users, items = plain(rows, starts, 0.05, 2)
    got = factorise.biased_factors(df, "u", "i", "r", rank=2, reg=0.05, rounds=2)
    assert all(np.allclose(r.w, users[r.id], atol=1e-8) for r in got.users.collect())
    assert all(np.allclose(r.w, items[r.id], atol=1e-8) for r in got.items.collect())
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"id": ["a"] * 9 + ["b"], "c": [0] * 10, "n": [1] * 10, "v": [[1.0, float(k), 2.0] for k in range(10)]})
    out = pa.Table.from_batches(factorise._combined([batch], 2)).to_pylist()
    assert [(r["id"], len(r["v"])) for r in out] == [("b", 3), ("a", 7)]
    assert out[1]["v"] == list(factorise.products(np.array([[1.0, k] for k in range(9)]), np.full(9, 2.0)))


def test_beats_the_mean_and_handles_the_unknown(spark):
    rows = ratings(60, 40, 3)
    df = spark.createDataFrame(rows, "u long, i string, r double").withColumn("b", F.pmod(F.xxhash64("u", "i"), F.lit(4)))
    train, test = df.filter("b > 0"), df.filter("b = 0")
    model = factorise.biased_factors(train, "u", "i", "r", rank=4, reg=0.02, rounds=5)
    mae = metrics.mae(model.predict(test, "u", "i"), "r", "est").first()["mae"]
    mean = train.agg(F.avg("r")).first()[0]
    bias = factorise.biased_factors(train, "u", "i", "r", rank=1, reg=5.0, rounds=5)  # hardly any factor
    assert mae < metrics.mae(test.withColumn("m", F.lit(mean)), "r", "m").first()["mae"] / 2
    assert mae < metrics.mae(bias.predict(test, "u", "i"), "r", "est").first()["mae"]
    odd = spark.createDataFrame([(999, "i1"), (1, "new"), (999, "new"), (None, None)], "u long, i string")
    est = {(r.u, r.i): r.est for r in model.predict(odd, "u", "i").collect()}
    assert est[999, "new"] == pytest.approx(mean) and est[None, None] == pytest.approx(mean) and all(1 <= e <= 5 for e in est.values())
    nulls = spark.createDataFrame([(1, "a", None), (None, "a", 2.0), (1, "a", 4.0)], "u long, i string, r double")
    assert factorise.biased_factors(nulls, "u", "i", "r", rank=2, rounds=1).users.count() == 1
    assert factorise.biased_factors(nulls.limit(0), "u", "i", "r", rank=2, rounds=1).users.count() == 0
