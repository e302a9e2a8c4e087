"""Hand-made edge tables (null, tie, constant, single-row cases)."""

import datetime as dt
import math
import os
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kiln.functions.dates import iso_week, next_week_number, parse_dmy2
from kiln.operators import aggs, clean, features, labels, lrmfp, metrics, splits, windows
from kiln.plans.ordering import exact_quantiles, global_cumsum, global_row_number


def test_priority_quantile_fallback_4_vs_5_rows(spark):
    rows = [(1, float(x)) for x in (1, 2, 3, 4)] + [(2, float(x)) for x in (10, 20, 30, 40, 50)]
    df = spark.createDataFrame(rows, "customer_id long, weekly_items double")
    out = {(r.customer_id, r.weekly_items): r.priority for r in labels.assign_priority(df).collect()}
    g = np.quantile([r[1] for r in rows], [0.2, 0.4, 0.6, 0.8])
    # client 1 has 4 rows → global quantiles
    exp1 = {x: ("Very Low" if x <= g[0] else "Low" if x <= g[1] else "Medium" if x <= g[2] else "High"
                if x <= g[3] else "Very High") for x in (1.0, 2.0, 3.0, 4.0)}
    assert all(out[(1, x)] == exp1[x] for x in exp1)
    # client 2 has 5 rows → own quintiles: one per label
    assert [out[(2, float(x))] for x in (10, 20, 30, 40, 50)] == ["Very Low", "Low", "Medium", "High", "Very High"]


def test_priority_all_equal_and_null(spark):
    df = spark.createDataFrame([(1, 5.0)] * 6 + [(1, None)], "customer_id long, weekly_items double")
    got = [r.priority for r in labels.assign_priority(df).collect()]
    assert got.count("Very Low") == 6 and got.count("Very High") == 1  # null → default branch


def test_mode_ties_smallest(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", None), ("b", None)], "k string, v string")
    out = {r.k: r.m for r in aggs.group_mode(df, ["k"], "v", "m").collect()}
    assert out == {"a": "x"}  # all-null group has no mode


def test_lrmfp_single_and_same_day(spark):
    rows = [(1, dt.datetime(2024, 1, 1, 10), 1.0, 2.0), (1, dt.datetime(2024, 1, 1, 15), 1.0, 4.0),
            (1, dt.datetime(2024, 1, 11), 2.0, 1.5), (2, dt.datetime(2024, 1, 5), 1.0, 3.0),
            (None, dt.datetime(2024, 2, 1), 1.0, 1.0)]
    df = spark.createDataFrame(rows, "customer_id long, invoice_date timestamp_ntz, quantity double, price double")
    out = {r.customer_id: r for r in lrmfp.lrmfp(df).collect()}
    assert set(out) == {1, 2}
    gaps = [0, 10]
    assert out[1].Length == 10 and out[1].Recency == 21 and out[1].Frequency == 3
    assert out[1].Periodicity == round(float(np.std(gaps)), 1)
    assert out[1].Monetary == round((2.0 + 4.0 + 3.0) / 3, 2)
    assert out[2].Periodicity == 0.0 and out[2].Frequency == 1


def test_lrmfp_half_even_monetary(spark):
    # mean 1.005 exactly in decimal → half-even keeps 1.00; 1.015 → 1.02
    rows = [(1, dt.datetime(2024, 1, 1), 1.0, 1.0), (1, dt.datetime(2024, 1, 2), 1.0, 1.01),
            (2, dt.datetime(2024, 1, 1), 1.0, 1.01), (2, dt.datetime(2024, 1, 2), 1.0, 1.02)]
    df = spark.createDataFrame(rows, "customer_id long, invoice_date timestamp_ntz, quantity double, price double")
    out = {r.customer_id: r.Monetary for r in lrmfp.lrmfp(df).collect()}
    assert out == {1: 1.0, 2: 1.02}


def test_iso_week_without_year(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2024, 12, 31),), (dt.date(2024, 1, 1),)], "d date")
    assert [r[0] for r in df.select(iso_week("d")).collect()] == [1, 1, 1]
    assert [r[0] for r in df.select(next_week_number(F.col("d"))).collect()][:2] == [52, 53]


def test_two_digit_year_pivot(spark):
    df = spark.createDataFrame([("31/12/68",), ("01/01/69",), ("15/06/99",)], "s string")
    assert [r[0] for r in df.select(parse_dmy2(F.col("s"))).collect()] == [
        dt.date(2068, 12, 31), dt.date(1969, 1, 1), dt.date(1999, 6, 15)]


def test_constant_column_scalers(spark):
    df = spark.createDataFrame([(1.0, 3.0), (1.0, 5.0)], "a double, b double")
    mm = features.MinMaxScaler(["a", "b"]).fit(df).transform(df).collect()
    assert [r.a for r in mm] == [0.0, 0.0] and sorted(r.b for r in mm) == [0.0, 1.0]
    ss = features.StandardScaler(["a"]).fit(df).transform(df).collect()
    assert [r.a for r in ss] == [0.0, 0.0]


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)], "x double")
    h = {r.bin: r.n for r in aggs.equal_width_histogram(df, "x", 5).collect()}
    assert h == dict(zip(range(1, 6), np.histogram(np.arange(11.0), bins=5)[0].tolist()))


def test_id_encoder_unseen(spark):
    fit = spark.createDataFrame([(1,), (10,), (2,)], "id long")
    enc = features.IdEncoder(["id"]).fit(fit)
    got = {r.k: r.id for r in enc.transform(spark.createDataFrame([(1, 1), (10, 10), (2, 2), (7, 7)], "k long, id long"))
           .collect()}
    assert got == {1: 0, 10: 1, 2: 2, 7: 3}


def test_one_hot_drop_first_and_unknown(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "t string")
    oh = features.OneHotDropFirst(["t"]).fit(df)
    assert sorted(c for c in oh.transform(df).columns) == ["t_b", "t_c"]
    with pytest.raises(Exception):
        oh.transform(spark.createDataFrame([("z",)], "t string")).collect()


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": rng.integers(0, 7, 400), "x": rng.normal(size=400).round(3)})
    df = spark.createDataFrame(pdf)
    got = exact_quantiles(df, "x", [0.2, 0.5, 0.9], by=["g"]).toPandas().set_index("g").sort_index()
    want = pdf.groupby("g")["x"].quantile([0.2, 0.5, 0.9]).unstack()
    assert np.allclose(got.values, want.values)


def test_global_row_number_and_cumsum(spark):
    df = spark.createDataFrame([(i % 13, i) for i in range(200)], "a long, b long")
    rn = global_row_number(df, ["a", "b"], out="rn").toPandas().sort_values("rn")
    assert rn.rn.tolist() == list(range(200))
    assert rn[["a", "b"]].values.tolist() == sorted(rn[["a", "b"]].values.tolist())
    cs = global_cumsum(df, ["b"], "a", out="c").toPandas().sort_values("b")
    assert cs.c.tolist() == np.cumsum(cs.a).tolist()


def test_splits_disjoint_and_complete(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(300)], "k long, y int")
    s = splits.stratified_holdout(df, "y", "k", 0.2).toPandas()
    assert len(s) == 300 and (s.groupby("y").split.apply(lambda x: (x == "test").sum()) == 20).all()
    o = splits.ordered_holdout(df, ["k"]).toPandas().sort_values("k")
    assert (o.split.iloc[-30:] == "test").all() and (o.split.iloc[-84:-30] == "val").all()
    f = splits.stratified_folds(df, "y", "k", 5).toPandas()
    assert f.groupby(["y", "fold"]).size().eq(20).all()


def test_precision_recall_zero_denominators(spark):
    pred = spark.createDataFrame([(1, "a", 2.0, 1.0), (1, "b", 1.0, 1.0), (2, "a", 4.0, 5.0)],
                                 "u long, i string, est double, true double")
    r = metrics.precision_recall_at_k(pred, "u", "est", "true", [10], [3.5], item="i").first()
    assert r.precision_at_k == pytest.approx(0.5) and r.recall_at_k == pytest.approx(0.5)


def test_auc_matches_rank_formula(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.random(300), 1)  # many ties
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": s}))
    got = metrics.roc_auc(df, "y", "s").first()[0]
    ranks = pd.Series(s).rank().values
    npos = y.sum()
    want = (ranks[y == 1].sum() - npos * (npos + 1) / 2) / (npos * (len(y) - npos))
    assert got == pytest.approx(want)


def test_keep_first_and_precedence(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 5, "z")], "k long, o long, v string")
    assert {r.k: r.v for r in clean.keep_first(df, ["k"], ["o"]).collect()} == {1: "a", 2: "z"}


def test_gap_stats_same_day(spark):
    rows = [(1, dt.datetime(2024, 1, 1)), (1, dt.datetime(2024, 1, 1)), (1, dt.datetime(2024, 1, 4))]
    df = spark.createDataFrame(rows, "k long, d timestamp_ntz")
    r = windows.gap_stats(df, "k", "d").first()
    assert r.n == 3 and r.gap_mean == pytest.approx(1.5) and r.gap_std == pytest.approx(1.5)


def test_ansi_safe_degenerate_inputs(spark):
    one_day = spark.createDataFrame([(dt.datetime(2024, 1, 1),)] * 3, "d timestamp_ntz")
    assert aggs.mean_distinct_gap(one_day, "d").first()[0] is None
    from kiln.operators import explain
    df = spark.createDataFrame([(1,), (2,)], "x int")
    r = explain.rule_stats(df, F.col("x") > 5, F.col("x") > 0).first()
    assert r.coverage == 0.0 and r.precision is None
    nulls = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), None, None)],
                                  "customer_id long, invoice_date timestamp_ntz, quantity double, price double")
    assert lrmfp.lrmfp(nulls).first().Monetary is None


def test_grouped_auc_matches_single(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": np.repeat([0, 1, 2], 100), "y": rng.integers(0, 2, 300), "s": np.round(rng.random(300), 1)})
    df = spark.createDataFrame(pdf)
    got = {r.g: r.roc_auc for r in metrics.roc_auc_by(df, "g", "y", "s").collect()}
    for g in (0, 1, 2):
        want = metrics.roc_auc(df.filter(F.col("g") == g), "y", "s").first()[0]
        assert got[g] == pytest.approx(want)


def test_hot_group_is_spread(spark):
    # one key holds a third of the rows: its values lie in many cells (quantiles) and, where rows
    # are numbered, in many ranges on (key, value); the results stay exact
    from kiln.plans.ordering import _counted_cells
    rows = [(0, float(i)) for i in range(3000)] + [(k, float(i)) for k in range(1, 60) for i in range(100)]
    df = spark.createDataFrame(rows, "g long, x double")
    cells = _counted_cells(df, "x", ["g"]).filter("g = 0").groupBy("_cell").count().collect()
    assert len(cells) > 20 and max(r["count"] for r in cells) < 3000 / 10
    numbered = global_row_number(df, ["g", "x"], out="rn", num_partitions=8)  # the sort stage of rank_within_group
    assert numbered.filter("g = 0").select(F.spark_partition_id()).distinct().count() > 1
    q = {r.g: r.q50 for r in exact_quantiles(df, "x", [0.5], by=["g"], names=["q50"]).collect()}
    assert q[0] == 1499.5 and q[7] == 49.5


def test_quantiles_of_odd_values_and_weights(spark):
    """NaN is the greatest value, infinities and huge ranges are values, weights stand for rows."""
    inf, nan = float("inf"), float("nan")
    rows = [(None, 1e300), (None, -1e300), (None, 1e-300), ("n", nan), ("n", 1.0), ("n", 2.0), ("i", inf), ("i", -inf), ("i", 0.0), ("e", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: (r.q0, r.q50, r.q100, r.n) for r in exact_quantiles(df, "x", [0, .5, 1], by=["g"], names=["q0", "q50", "q100"], count_col="n").collect()}
    assert got[None] == (-1e300, 1e-300, 1e300, 3) and got["i"] == (-inf, 0.0, inf, 3)
    assert got["n"][:2] == (1.0, 2.0) and np.isnan(got["n"][2]) and "e" not in got
    w = spark.createDataFrame([(1.0, 3), (2.0, 1), (9.0, 6)], "x double, w long")
    assert exact_quantiles(w, "x", [.1, .3, .5], weight="w").first().asDict() == {"q10": 1.0, "q30": pytest.approx(1.7), "q50": 9.0}
    assert tuple(exact_quantiles(df.limit(0), "x", [.5]).first()) == (None,)
    assert exact_quantiles(df.limit(0), "x", [.5], by=["g"]).count() == 0


def test_rank_within_group_keeps_null_group(spark):
    from kiln.plans.ordering import rank_within_group
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 3.0)], "g string, x double")
    got = sorted((r.g or "", r._pos, r._n) for r in rank_within_group(df, ["g"], ["x"]).collect())
    assert got == [("", 0, 2), ("", 1, 2), ("a", 0, 1)]


def test_priority_quantiles_equal_percentile(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"customer_id": rng.integers(0, 30, 600), "weekly_items": rng.integers(1, 40, 600).astype(float)})
    df = spark.createDataFrame(pdf)
    got = {r[0]: tuple(r[1:]) for r in labels.client_quantiles(df).collect()}
    for c, g in pdf.groupby("customer_id").weekly_items:
        assert (c in got) == (len(g) >= 5)
        if c in got:
            assert got[c] == pytest.approx([g.quantile(p) for p in labels.PROBS])


def test_quantiles_with_one_value_in_half_of_the_rows(spark):
    from kiln.plans.ordering import exact_quantiles
    from pyspark.sql import functions as F
    df = spark.range(4000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 2 == 0, 7.0).otherwise(F.col("id") * 1.0).alias("v"))
    pdf = df.toPandas()
    got = {r["g"]: (r["q25"], r["q50"], r["q90"]) for r in exact_quantiles(df, "v", [.25, .5, .9], by=["g"]).collect()}
    for g, v in pdf.groupby("g").v:
        assert got[g] == pytest.approx(tuple(v.quantile([.25, .5, .9])))
    # the distributed sort sees each distinct value once: no range can be hot
    plan = exact_quantiles(df, "v", [.5])
    assert plan.first()["q50"] == pdf.v.quantile(.5)


def test_scratch_tables_are_removed(spark):
    import os
    from kiln.session import clear_scratch, scratch_path
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    clear_scratch(spark)
    assert not os.path.isdir(local)


def test_forecast_and_lags_are_per_series(spark):
    import datetime as dt
    from kiln.operators import features, forecast
    rows = [(s, dt.date(2024, 1, 1) + dt.timedelta(days=i), base + 2.0 * i) for s, base in (("a", 8.0), ("b", 1008.0)) for i in range(60)]
    df = spark.createDataFrame(rows, "series_id string, ds date, y double")
    p = forecast.additive_forecast(df, "2024-02-15", n_changepoints=0, yearly=0, weekly=0, reg=0.0).toPandas()
    assert np.allclose(p.yhat, p.y)  # each series has its own level
    lag = features.lag_block_train_mean(df, "series_id", "ds", "y", [1], F.col("ds") <= F.lit("2024-01-10").cast("date")).toPandas()
    first = lag.sort_values("ds").groupby("series_id").first().y_lag1
    assert first["a"] == pytest.approx(8 + 9) and first["b"] == pytest.approx(1008 + 9)
    pacf = features.pacf_lags(df, "series_id", "ds", "y", 3).toPandas()
    assert np.allclose(pacf[pacf.series_id == "a"].sort_values("lag").pacf, pacf[pacf.series_id == "b"].sort_values("lag").pacf)
    grid = forecast.grid_search(df, "2024-02-15", [{"reg": 0.0}, {"reg": 10.0}], n_changepoints=0, yearly=0, weekly=0).toPandas()
    assert grid.trial.tolist() == [0, 1]


def test_saved_features_give_equal_vectors(spark, tmp_path):
    from pyspark.ml.functions import vector_to_array
    from kiln.operators.pipeline import feature_pipeline, load_features, save_features
    df = spark.createDataFrame([(float(i) if i % 5 else None, "abc"[i % 3] if i % 7 else None, f"id{i % 9}") for i in range(60)],
                               "x double, c string, k string")
    model = feature_pipeline(["x"], ["c"], ["k"], unknown="keep").fit(df)
    again = load_features(spark, save_features(model, spark, str(tmp_path / "saved")))
    new = df.unionByName(spark.createDataFrame([(1.0, "never seen", "id?")], df.schema))
    a, b = ([tuple(r[0]) for r in m.transform(new).select(vector_to_array("features")).collect()] for m in (model, again))
    assert sorted(a) == sorted(b) and len(a) == 61


def test_elimination_runs_until_nothing_drops(spark):
    from pyspark.ml.classification import DecisionTreeClassifier
    from kiln.operators import explain, models
    rng = np.random.default_rng(0)
    names = [f"x{i}" for i in range(15)]
    x = rng.normal(size=(200, 15))
    pdf = pd.DataFrame(x, columns=names).assign(label=(x[:, 0] > 0).astype(float))
    data = models.assemble(spark.createDataFrame(pdf), names)
    kept, history = explain.recursive_elimination(lambda: DecisionTreeClassifier(maxDepth=2, seed=1), data, names, 0.5)
    assert kept == ["x0"] and history[0][1] == 15 and history[-1][1] == 1 and history[-1][2] > 0.95


def test_one_client_scores_equal_the_whole_scoring(spark, small_dir):
    import __spark_entry__ as entry
    q = entry.queries()
    one = {tuple(r) for r in q["o3_score_one_client"](spark, small_dir).collect()}
    client = next(iter(one))[0]
    assert one == {tuple(r) for r in q["o2_score_candidates"](spark, small_dir).filter(F.col("customer_id") == client).collect()}


def test_one_hot_refuses_an_unbounded_category(spark):
    from kiln.operators.features import OneHotDropFirst
    df = spark.range(12).selectExpr("cast(id % 6 as string) AS c")
    assert len(OneHotDropFirst(["c"], max_categories=6).fit(df).categories["c"]) == 6
    with pytest.raises(ValueError, match="more than 5"):
        OneHotDropFirst(["c"], max_categories=5).fit(df)


def test_fact_join_partitions_grow_with_the_files(spark, small_dir, monkeypatch):
    from kiln.plans.weekly import weekly_data
    from kiln.sources import proxies, tables
    from kiln.sources.tables import join_partitions
    names = ("lineitem", "orders")
    assert join_partitions(spark, small_dir, *names) is None  # small files: Spark's choice
    want = {tuple(r) for r in weekly_data(spark, small_dir).collect()}
    plain = proxies.transactions(spark, small_dir).count()
    monkeypatch.setattr(tables, "COUNTED_FROM", 0)
    monkeypatch.setattr(tables, "PARTITION_BYTES", 8_000)
    n = join_partitions(spark, small_dir, *names)
    size = sum(os.path.getsize(os.path.join(small_dir, f"{t}.parquet")) for t in names)
    assert n == -(-size // 8_000) > 8
    tx = proxies.transactions(spark, small_dir)
    sizes = tx.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 8 and max(r["count"] for r in sizes) < plain / 4 and sum(r["count"] for r in sizes) == plain
    assert {tuple(r) for r in weekly_data(spark, small_dir).collect()} == want


def test_roll_up_and_quantile_counts_are_spread_by_the_files(spark, small_dir, monkeypatch):
    """Large files: the tasks that hold the sums and the counts grow in number, and the labels stay."""
    from kiln.plans.weekly import weekly_priority
    from kiln.sources import tables
    few = sorted(map(tuple, weekly_priority(spark, small_dir).collect()))
    monkeypatch.setattr(tables, "COUNTED_FROM", 0)
    monkeypatch.setattr(tables, "PARTITION_BYTES", 8_000)
    n = tables.join_partitions(spark, small_dir, "lineitem", "orders")
    spread = weekly_priority(spark, small_dir)
    plan = spread._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(rf"RepartitionByExpression \[customer_id#\d+L, week#\d+, product_id#\d+L\], {n}\b", plan)
    assert re.search(rf"RepartitionByExpression \[customer_id#\d+L, weekly_items#\d+\], {n}\b", plan)
    assert sorted(map(tuple, spread.collect())) == few


def test_prepared_rows_of_large_tables_are_reread_in_few_partitions(spark, small_dir, monkeypatch):
    """A pass of a fit has a task per file split, not one per shuffle partition; rows and columns stay."""
    from kiln.plans import q_models
    cached, _, _ = q_models.priority_prepared(spark, small_dir)
    want, names, schema = sorted(map(str, cached.collect())), q_models._feature_names(cached), cached.schema
    cached.unpersist()
    monkeypatch.setattr(q_models, "LAID_OUT_FROM", 0)
    laid, _, _ = q_models.priority_prepared(spark, small_dir)
    assert laid.inputFiles()  # a table: no plan behind it
    assert laid.rdd.getNumPartitions() <= max(4, spark.sparkContext.defaultParallelism)
    assert laid.columns == schema.names and q_models._feature_names(laid) == names
    assert laid.schema["label"].metadata == schema["label"].metadata
    assert sorted(map(str, laid.collect())) == want


@pytest.mark.parametrize("n", [0, 1, 2, 9, 40])
def test_holdout_by_first_column_is_the_sorted_one(spark, n):
    rows = [(None if i % 7 == 6 else i * i % 5, i % 3, i) for i in range(n)]
    df = spark.createDataFrame(rows, "week int, customer int, product int")
    order = ["week", "customer", "product"]
    want = sorted(map(str, splits.ordered_holdout(df, order).collect()))
    assert sorted(map(str, splits.ordered_holdout(df, order, by_first=True).collect())) == want


def test_holdout_by_first_column_cuts_equal_rows(spark):
    df = spark.createDataFrame([(1, "x")] * 25, "week int, k string")
    got = splits.ordered_holdout(df, ["week", "k"], by_first=True).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"train": 17, "val": 5, "test": 3}


def test_laid_out_rows_leave_no_shuffle_files(spark):
    from kiln.session import laid_out
    def shuffles():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = shuffles()
    rows = laid_out(spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count(), "test")
    assert not shuffles() - before
    assert sorted(map(tuple, rows.collect())) == [(i, 143 if i < 6 else 142) for i in range(7)]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_greedy_rule_makes_its_rows_once(spark, small_dir):
    from kiln.plans import q_models
    assert all("rule-rows" in f for f in q_models.n9_greedy_rule(spark, small_dir).inputFiles())


def test_split_of_large_tables_sorts_the_cut_weeks_only(spark, small_dir, monkeypatch):
    from kiln.operators import splits as ops
    from kiln.plans import q_models
    want = sorted(map(str, q_models.priority_split(spark, small_dir).collect()))
    sorted_rows = []
    plain = ops.global_row_number
    monkeypatch.setattr(ops, "global_row_number", lambda df, *a, **k: (sorted_rows.append(df.count()), plain(df, *a, **k))[1])
    monkeypatch.setattr(q_models, "LAID_OUT_FROM", 0)
    laid = q_models.priority_split(spark, small_dir)
    assert sorted(map(str, laid.collect())) == want
    assert sum(sorted_rows) < len(want) / 10


def test_fitted_features_encode_ids_before_vectors_are_made(spark):
    """Fits do not read through the id joins, and the joins do not carry the vectors."""
    from kiln.operators.pipeline import DistributedIdEncoderModel, feature_pipeline
    df = spark.createDataFrame([(1, 2.0, "a"), (2, 3.0, "b"), (3, 5.0, "b")], "customer long, x double, c string")
    fitted = feature_pipeline(["x"], ["c"], ["customer"]).fit(df)
    assert isinstance(fitted.stages[0], DistributedIdEncoderModel)
    assert [list(r.features.toArray().round(6)) for r in fitted.transform(df).orderBy("customer").collect()] == [
        [-1.069045, 0.0, 0.0], [-0.267261, 1.0, 1.0], [1.336306, 1.0, 2.0]]


def test_spread_settings_hold_inside_only(spark):
    from kiln.session import TASKS_PER_CORE, spread
    key = "spark.sql.files.minPartitionNum"
    with spread(spark):
        assert int(spark.conf.get(key)) == TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert spark.conf.get(key, None) is None
    with spread(spark, on=False):
        assert spark.conf.get(key, None) is None
