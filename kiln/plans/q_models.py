"""Queries: models (K1–K7, K9–K11), calibration and curves (M8, M10, M13),
tuning and explanation (N1–N10).  MLlib results are rows-only checks; the
baselines, the trend line, rule statistics and drift have DuckDB oracles."""

from __future__ import annotations

from pyspark import StorageLevel

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from kiln.operators import aggs, boosting, drift, explain, factorise, forecast, metrics, models, rules, treeshap
from kiln.operators.clean import hash_sample
from kiln.operators.splits import ordered_holdout, stratified_folds
from kiln.plans.common import round_doubles, sql_round
from kiln.plans.registry import register
from kiln.plans.sqlparts import LABELLED_CTES, SQL_PANEL, with_ctes
from kiln.plans.weekly import weekly_priority
from kiln.session import clear_scratch, cut_lineage, laid_out, scratch_mark, spread
from kiln.sources import proxies, store
from kiln.sources.tables import table_bytes

NUMERIC = ["week", "size", "price", "acctbal"]
CATEGORICAL = ["customer_type", "brand", "category"]
IDS = ["customer_id", "product_id"]


#: Bytes of the fact tables from which rows that several jobs read are laid out as tables.
LAID_OUT_FROM = 32_000_000


def is_laid_out(spark, d) -> bool:
    return table_bytes(spark, d, "lineitem", "orders") >= LAID_OUT_FROM


def spread_fits(spark, d):
    """For fits of trees over the rows of larger tables, whose tasks answer to each other
    and not to the driver."""
    return spread(spark, is_laid_out(spark, d))


def priority_split(spark, d):
    """Weekly labelled rows with the ordered 72/18/10 holdout (J1).  Of larger tables the
    labelled rows are written once, and the weeks that hold a cut are sorted, not all."""
    rows, order = weekly_priority(spark, d), ["week", "customer_id", "product_id"]
    if is_laid_out(spark, d):
        return ordered_holdout(laid_out(rows, "weekly"), order, by_first=True)
    return ordered_holdout(rows, order)


def train_rows(spark, d):
    """The train rows of the split, for several fit passes."""
    train = priority_split(spark, d).filter(F.col("split") == "train")
    return train if is_laid_out(spark, d) else train.persist(StorageLevel.DISK_ONLY)


def priority_prepared(spark, d):
    """The rows of the split with features and label code.  Of larger tables they are
    written and reread: a fit passes over them hundreds of times, and every task of a
    pass answers to the driver, so the passes get partitions of a file split each,
    without the plan behind them, in place of the session's number of partitions.  The
    labelled rows they were made of are removed then."""
    large, start = is_laid_out(spark, d), scratch_mark(spark)
    with spread_fits(spark, d):
        data, pipe, classes = models.prepare(priority_split(spark, d), NUMERIC, CATEGORICAL, IDS, "priority", keep=not large)
    if large:
        end = scratch_mark(spark)
        data = laid_out(data, "prepared")
        clear_scratch(spark, start, end)
        return data, pipe, classes
    return data.persist(StorageLevel.DISK_ONLY), pipe, classes


SQL_SPLIT = """sl AS (SELECT *, CASE WHEN pos >= n - ceil(n * CAST(0.1 AS DOUBLE)) THEN 'test'
  WHEN pos >= (n - ceil(n * CAST(0.1 AS DOUBLE))) - ceil((n - ceil(n * CAST(0.1 AS DOUBLE))) * CAST(0.2 AS DOUBLE))
  THEN 'val' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY week, customer_id, product_id) - 1 AS pos, count(*) OVER () AS n FROM lab))"""


@register("k1_majority_baseline", sql_round(with_ctes(*LABELLED_CTES, SQL_SPLIT) + """
, maj AS (SELECT priority AS m FROM sl WHERE split = 'train' GROUP BY priority ORDER BY count(*) DESC, priority LIMIT 1)
SELECT split, (SELECT m FROM maj) AS majority, avg(CAST(priority = (SELECT m FROM maj) AS DOUBLE)) AS accuracy
FROM sl GROUP BY split""", ["accuracy"]))
def k1_majority_baseline(spark, d):
    s = priority_split(spark, d)
    m = aggs.group_mode(s.filter(F.col("split") == "train"), None, "priority", "m").select("m").scalar()
    return round_doubles(s.groupBy("split").agg(F.first(m).alias("majority"),
                                               F.avg((F.col("priority") == m).cast("double")).alias("accuracy")))


@register("k1_mean_baseline", sql_round(with_ctes(*LABELLED_CTES, SQL_SPLIT) + """
SELECT split, avg(abs(weekly_items - (SELECT avg(weekly_items) FROM sl WHERE split = 'train'))) AS mae
FROM sl GROUP BY split""", ["mae"]))
def k1_mean_baseline(spark, d):
    s = priority_split(spark, d)
    mean = s.filter(F.col("split") == "train").select(F.avg("weekly_items")).scalar()
    return round_doubles(s.groupBy("split").agg(F.avg(F.abs(F.col("weekly_items") - mean)).alias("mae")))


def _classifier_query(name):
    def q(spark, d):
        data, _, _ = priority_prepared(spark, d)
        with spread(spark, is_laid_out(spark, d) and name not in ("logistic_regression", "linear_svc")):
            model = models.fit_classifier(name, data.filter(F.col("split") == "train"))
        return models.evaluate(model, data)
    return q


for _id, _name in [("k2", "logistic_regression"), ("k3", "linear_svc"), ("k4", "decision_tree"),
                   ("k5", "random_forest"), ("k6", "gradient_boosting")]:
    register(f"{_id}_{_name}")(_classifier_query(_name))


@register("k6_softmax_boosting")
def k6_softmax_boosting(spark, d):
    """Boosting with one softmax over all classes, beside the one-against-rest trees."""
    data, _, classes = priority_prepared(spark, d)
    model = boosting.fit_boosted(data.filter(F.col("split") == "train"), len(classes))
    out = cut_lineage(models.evaluate(model, data.drop("probability", "prediction")))
    data.unpersist()
    return out


@register("k7_gbt_regression")
def k7_gbt_regression(spark, d):
    data, _, _ = priority_prepared(spark, d)
    with spread_fits(spark, d):
        model = models.gbt_regressor(data.filter(F.col("split") == "train"), "weekly_items")
    p = model.transform(data)
    return p.groupBy("split").agg(F.avg(F.abs(F.col("weekly_items") - F.col("prediction"))).alias("mae"))


SQL_TRAIN_T = """tt AS (SELECT series_id, y, CAST(datediff('day', min(ds) OVER (PARTITION BY series_id), ds) AS DOUBLE) AS t, ds FROM panel)"""


@register("k9_linear_trend", sql_round(with_ctes(SQL_PANEL, SQL_TRAIN_T) + """
SELECT series_id, regr_slope(y, t) AS slope, regr_intercept(y, t) AS intercept FROM tt WHERE ds <= DATE '2000-02-29'
GROUP BY series_id""", ["slope", "intercept"], 4))
def k9_linear_trend(spark, d):
    from kiln.operators.windows import elapsed_days
    s = elapsed_days(proxies.daily_panel(spark, d), "ds", key="series_id").withColumn("t", F.col("t").cast("double"))
    train = s.filter(F.col("ds") <= F.lit("2000-02-29").cast("date"))
    return round_doubles(forecast.trend_fit(train, "t", "y", key="series_id"), 4)


CUTOFF = "2000-02-29"


def _sql_fourier_ols(order: int = 5, period: float = 365.0) -> str:
    """Least squares in SQL by Gram–Schmidt: each term is taken out of the terms
    behind it and of the target, with sums over the train rows; what is left of the
    target is the residual of every row."""
    cols = ["one", *[f"{f}{k}" for k in range(1, order + 1) for f in ("s", "c")], "y"]
    made = ", ".join(f"{fn}(2 * pi() * {k} * t / {period}) AS {n}{k}" for k in range(1, order + 1) for fn, n in (("sin", "s"), ("cos", "c")))
    ctes = [SQL_PANEL, SQL_TRAIN_T, f"""g0 AS (SELECT series_id, y AS actual, ds > DATE '{CUTOFF}' AS test,
  CASE WHEN ds <= DATE '{CUTOFF}' THEN 1.0 ELSE 0.0 END AS w, CAST(1 AS DOUBLE) AS one, {made}, y FROM tt)"""]
    for k, q in enumerate(cols[:-1]):
        rest = ", ".join(f"{c} - {q} * sum(w * {c} * {q}) OVER p / sum(w * {q} * {q}) OVER p AS {c}" for c in cols[k + 1:])
        ctes.append(f"g{k + 1} AS (SELECT series_id, actual, test, w, {rest} FROM g{k} WINDOW p AS (PARTITION BY series_id))")
    return with_ctes(*ctes) + f"SELECT series_id, avg(abs(y)) AS mae, 'fourier_n5_p365' AS model FROM g{len(cols) - 1} WHERE test GROUP BY series_id"


def _series_mae(pred):
    return pred.filter("split = 'test'").groupBy("series_id").agg(F.avg(F.abs(F.col("y") - F.col("yhat"))).alias("mae"))


@register("k10_seasonal_regression", sql_round(_sql_fourier_ols(), ["mae"], 3))
def k10_seasonal_regression(spark, d):
    pred = forecast.seasonal_regression(proxies.daily_panel(spark, d), CUTOFF)
    return round_doubles(_series_mae(pred).withColumn("model", F.lit("fourier_n5_p365")), 3)


@register("k11_additive_forecast")
def k11_additive_forecast(spark, d):
    """The four variants of the additive model on the daily series of every order priority."""
    s = proxies.daily_panel(spark, d, orders=True)
    plain, log = forecast.Setting(), forecast.Setting(multiplicative=True)
    out = None
    for names, kw in [(("trend_seasonal", "multiplicative"), {}), (("with_regressor", None), {"regressors": ["x_orders"]}),
                      (("with_lags", None), {"regressors": ["x_orders"], "lags": [1, 7]})]:
        settings = [m for n, m in zip(names, (plain, log)) if n]
        pred = forecast.forecasts(s, CUTOFF, settings, **kw).filter("split = 'test'")
        label = F.array(*[F.lit(n) for n in names if n])[F.col("trial")]
        m = pred.groupBy("series_id", label.alias("variant")).agg(F.avg(F.abs(F.col("y") - F.col("yhat"))).alias("mae"))
        out = m if out is None else out.unionByName(m)
    return out


#: The forecaster's grid (fixed values): 36 combinations.
FORECAST_GRID = [{"changepoint_prior_scale": c, "seasonality_prior_scale": s, "multiplicative": m, "changepoint_range": r}
                 for c in (0.01, 0.1, 0.5) for s in (1.0, 5.0, 10.0) for m in (False, True) for r in (0.8, 0.9)]


@register("n1_grid_search")
def n1_grid_search(spark, d):
    return forecast.grid_search(proxies.daily_panel(spark, d, orders=True), CUTOFF, FORECAST_GRID, regressors=["x_orders"])


def _als_frame(spark, d, keep: bool = False):
    """Ratings with a 70 / 30 split and dense user and item codes of the train
    rows (fitted code tables, so ids of any type and size work).  ``keep``: the ratings
    and the coded rows are written, for callers that read them more than once."""
    from kiln.operators.features import IdEncoder
    from kiln.operators.splits import hash_split
    r = proxies.ratings(spark, d)
    if keep:
        r = laid_out(r, "ratings")
    r = r.withColumn("_k", F.concat_ws("|", F.col("user_id").cast("string"), "item_id"))
    s = hash_split(r, "_k", [("test", 30), ("train", 70)]).withColumns({"user": F.col("user_id"), "item": F.col("item_id")})
    coded = IdEncoder(["user", "item"]).fit(s.filter(F.col("split") == "train")).transform(s)
    coded = coded.withColumns({c: F.col(c).cast("int") for c in ("user", "item")})
    return laid_out(coded, "coded-ratings") if keep else coded


@register("k12_als_nonnegative")
def k12_als_nonnegative(spark, d):
    s = _als_frame(spark, d)
    train = s.filter(F.col("split") == "train")
    model = models.als(train, rank=20, nonnegative=True)
    mean = train.select(F.avg("rating")).scalar()
    p = model.transform(s.filter(F.col("split") == "test"))
    p = p.withColumn("prediction", F.when(F.isnan("prediction"), mean).otherwise(F.col("prediction")))
    return metrics.mae(p, "rating", "prediction").withColumn("model", F.lit("als_nonneg_rank20"))


@register("k13_als_biased")
def k13_als_biased(spark, d):
    """Biases and 50 factors learned together, on the 70 / 30 split of K12."""
    s = _als_frame(spark, d, keep=True)
    model = factorise.biased_factors(s.filter(F.col("split") == "train"), "user_id", "item_id", "rating", rank=50, reg=0.5)
    p = model.predict(s.filter(F.col("split") == "test"), "user_id", "item_id")
    return metrics.mae(p, "rating", "est").withColumn("model", F.lit("als_biased_rank50"))


# ------------------------------------------------------ calibration, curves ----

def _doc_features(spark, d):
    from kiln.sources.tables import read_table
    docs = read_table(spark, d, "documents").select("doc_id", "n_chars", "lang", "source", "text")
    lb = read_table(spark, d, "labels").select("doc_id", F.col("quality").alias("label").cast("double"))
    f = docs.join(lb, "doc_id").select(
        "doc_id", "label", F.log1p("n_chars").alias("log_chars"),
        F.size(F.split("text", r"\s+")).cast("double").alias("n_words"),
        (F.length(F.regexp_replace("text", r"[^0-9]", "")) / F.greatest(F.length("text"), F.lit(1))).alias("digit_share"),
        (F.col("lang") == "en").cast("double").alias("is_en"))
    return models.assemble(f, ["log_chars", "n_words", "digit_share", "is_en"])


def _doc_split(spark, d):
    """(train, test): 30 % of the labelled documents held out per class."""
    from kiln.operators.splits import stratified_holdout
    f = stratified_holdout(_doc_features(spark, d), "label", "doc_id", 0.3)
    return (f.filter(F.col("split") == s).drop("split") for s in ("train", "test"))


@register("m8_platt_calibration")
def m8_platt_calibration(spark, d):
    """Sigmoid calibration on out-of-fold scores of the train rows, judged on held-out rows."""
    train, test = _doc_split(spark, d)
    f = stratified_folds(train, "label", "doc_id", 5)

    def scored(model, rows):
        p = model.transform(rows).select("doc_id", "label", vector_to_array("probability")[1].alias("score"))
        logit = F.log(F.greatest(F.col("score"), F.lit(1e-6)) / F.greatest(1 - F.col("score"), F.lit(1e-6)))
        return models.assemble(p.withColumn("logit", logit), ["logit"])

    def forest(rows):
        return RandomForestClassifier(numTrees=30, maxDepth=5, seed=42).fit(rows)

    oof = None
    for k in range(5):
        p = scored(forest(f.filter(F.col("fold") != k)), f.filter(F.col("fold") == k))
        oof = p if oof is None else oof.unionByName(p)
    cal = LogisticRegression(maxIter=50).fit(oof)
    out = cal.transform(scored(forest(train), test)).withColumn("p_cal", vector_to_array("probability")[1])
    return out.agg(F.avg(F.pow(F.col("score") - F.col("label"), 2)).alias("brier_raw"),
                   F.avg(F.pow(F.col("p_cal") - F.col("label"), 2)).alias("brier_calibrated"))


@register("m10_learning_curve")
def m10_learning_curve(spark, d):
    from kiln.operators.splits import hash_bucket
    data, _, _ = priority_prepared(spark, d)
    train = data.filter(F.col("split") == "train").withColumn("_b", hash_bucket(F.col("customer_id") * 1000003
                                                                                 + F.col("product_id")))
    val = data.filter(F.col("split") == "val")
    out = None
    for frac in (20, 40, 60, 80, 100):
        with spread_fits(spark, d):
            m = DecisionTreeClassifier(maxDepth=8, seed=42).fit(train.filter(F.col("_b") < frac))
        r = metrics.classification_summary(m.transform(val), "label", "prediction").select(
            F.lit(frac).alias("train_pct"), "accuracy", "macro_f1")
        out = r if out is None else out.unionByName(r)
    return out


@register("m13_leaderboard")
def m13_leaderboard(spark, d):
    data, _, _ = priority_prepared(spark, d)
    return models.leaderboard(data, list(models.CLASSIFIERS))


# ------------------------------------------------------------ tuning, explain ----

def _forest_runs(spark, d):
    """The random search over forests on these tables, logged in the shared folder under
    a run id of the data and the trials; what is logged already is not fitted again."""
    space = {"numTrees": (10, 60), "maxDepth": (3, 10), "subsamplingRate": (0.5, 1.0)}
    trials = explain.random_search_space(space, 30)
    tables = [f"{d}/{t}.parquet" for t in ("lineitem", "orders", "customer", "part")]
    folder, run_id = store.shared_folder(spark, "runs-priority-rf"), store.version_of(spark, tables, trials, NUMERIC, CATEGORICAL, IDS)
    if all(store.published(spark, f"{folder}/run_id={run_id}/trial_id={i}") for i in range(len(trials))):
        return store.read_log(spark, folder, explain.RUN_SCHEMA, run_id)
    data, _, _ = priority_prepared(spark, d)
    try:
        with spread_fits(spark, d):
            return explain.run_trials(lambda **p: RandomForestClassifier(seed=42, **p), data.filter(F.col("split") == "train"),
                                      data.filter(F.col("split") == "val"), trials, folder, "priority_rf", run_id)
    finally:
        data.unpersist()


@register("n2_random_search")
def n2_random_search(spark, d):
    return _forest_runs(spark, d).drop("run_id")


@register("n3_best_run")
def n3_best_run(spark, d):
    return explain.best_run(_forest_runs(spark, d))


def _feature_names(data):
    attrs = data.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    names = {}
    for group in attrs.values():
        for a in group:
            names[a["idx"]] = a["name"]
    return [names.get(i, f"f{i}") for i in range(len(names))]


@register("n4_recursive_elimination")
def n4_recursive_elimination(spark, d):
    data, _, _ = priority_prepared(spark, d)
    names = _feature_names(data)
    with spread_fits(spark, d):
        kept, history = explain.recursive_elimination(lambda: RandomForestClassifier(numTrees=30, maxDepth=6, seed=42),
                                                      data.filter(F.col("split") == "train"), names)
    data.unpersist()
    # one row per round; the last round's features are the kept ones
    rows = [(r, n, acc, sorted(kept) if r == len(history) - 1 else None) for r, n, acc in history]
    return spark.createDataFrame(rows, "round INT, n_features INT, train_accuracy DOUBLE, kept ARRAY<STRING>")


@register("n5_impurity_importance")
def n5_impurity_importance(spark, d):
    data, _, _ = priority_prepared(spark, d)
    with spread_fits(spark, d):
        m = RandomForestClassifier(numTrees=50, maxDepth=8, seed=42).fit(data.filter(F.col("split") == "train"))
    return explain.importances_frame(spark, m, _feature_names(data))


_DOC_COLS = ["log_chars", "n_words", "digit_share", "is_en"]


@register("n6_permutation_importance")
def n6_permutation_importance(spark, d):
    train, test = (x.drop("features").withColumnRenamed("doc_id", "_rid") for x in _doc_split(spark, d))
    model = RandomForestClassifier(numTrees=30, maxDepth=5, seed=42).fit(models.assemble(train, _DOC_COLS))

    def assemble(df):
        return models.assemble(df.drop("features", "probability", "rawPrediction", "prediction"), _DOC_COLS)

    m = _ScoreWrap(model)
    return explain.permutation_importance(m, test, _DOC_COLS, assemble, "score", "label", repeats=30)


class _ScoreWrap:
    """Model wrapper adding the positive-class probability as ``score``."""

    def __init__(self, model):
        self.model = model

    def transform(self, df):
        return self.model.transform(df).withColumn("score", vector_to_array("probability")[1])


@register("n7_shapley")
def n7_shapley(spark, d):
    train, f = (x.drop("features") for x in _doc_split(spark, d))  # explained: held-out rows
    model = RandomForestClassifier(numTrees=30, maxDepth=5, seed=42).fit(models.assemble(train, _DOC_COLS))

    def predict(df):
        return model.transform(models.assemble(df, _DOC_COLS)).withColumn("p", vector_to_array("probability")[1])

    rows = hash_sample(f, "doc_id", 40)          # explained rows (sampling is the feature)
    background = hash_sample(f.withColumn("_k", -F.col("doc_id")), "_k", 30)
    return explain.shapley_mean_abs(predict, rows, background, _DOC_COLS, "doc_id", n_perm=8)


@register("n7_shapley_by_class")
def n7_shapley_by_class(spark, d):
    """The priority forest, explained exactly on every held-out row."""
    data, _, classes = priority_prepared(spark, d)
    with spread_fits(spark, d):
        model = RandomForestClassifier(numTrees=30, maxDepth=6, seed=42).fit(data.filter(F.col("split") == "train"))
    names = _feature_names(data)
    # the label code after the known classes stands for a label the training rows lack
    got = treeshap.shapley_by_class(model, data.filter(F.col("split") == "test"), IDS + ["week"], names, [*classes, "other"][:model.numClasses])
    got = cut_lineage(got)
    data.unpersist()
    return got


@register("n8_partial_dependence")
def n8_partial_dependence(spark, d):
    train, f = (x.drop("features") for x in _doc_split(spark, d))  # explained: held-out rows
    model = RandomForestClassifier(numTrees=30, maxDepth=5, seed=42).fit(models.assemble(train, _DOC_COLS))

    def predict(df):
        return model.transform(models.assemble(df, _DOC_COLS)).withColumn("p", vector_to_array("probability")[1])

    rows = hash_sample(f, "doc_id", 1000)          # 1,000 explained rows (sampling is the feature)
    bounds = f.agg(*[F.min(c).alias(f"lo_{c}") for c in _DOC_COLS], *[F.max(c).alias(f"hi_{c}") for c in _DOC_COLS]).first()
    from functools import reduce
    from pyspark.sql import DataFrame
    frames = []
    for c in _DOC_COLS:  # every model feature (fewer than five here)
        lo, hi = bounds[f"lo_{c}"], bounds[f"hi_{c}"]
        grid = [lo + (hi - lo) * j / 9 for j in range(10)]
        frames.append(explain.partial_dependence(predict, rows, c, grid))
    return reduce(DataFrame.unionByName, frames)


_RULE_SQL = "size > 25 AND customer_type = 'BUILDING'"


@register("n9_rule_stats", sql_round(with_ctes(*LABELLED_CTES) + f"""
SELECT count_if({_RULE_SQL}) / count(*) AS coverage,
       count_if({_RULE_SQL} AND priority IN ('High', 'Very High')) / count_if({_RULE_SQL}) AS precision,
       CAST(count_if({_RULE_SQL}) AS BIGINT) AS n_covered FROM lab""", ["coverage", "precision"]))
def n9_rule_stats(spark, d):
    lab = weekly_priority(spark, d)
    rule = (F.col("size") > 25) & (F.col("customer_type") == "BUILDING")
    return round_doubles(explain.rule_stats(lab, rule, F.col("priority").isin("High", "Very High")))


@register("n9_greedy_rule")
def n9_greedy_rule(spark, d):
    # every step and the result read the rows
    lab = laid_out(weekly_priority(spark, d).select("size", "customer_type", "price", "priority"), "rule-rows")
    cands = {f"size > {v}": F.col("size") > v for v in (10, 25, 40)}
    cands.update({f"customer_type = {t}": F.col("customer_type") == t
                  for t in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")})
    cands.update({f"price > {v}": F.col("price") > v for v in (1000, 1500)})
    target = F.col("priority").isin("High", "Very High")
    chosen, rule = explain.greedy_rule(lab, target, cands)
    return explain.rule_stats(lab, rule, target).withColumn("rule", F.lit(" AND ".join(chosen)))


def _sql_rule_search(bins: int, top: int, least: float) -> str:
    """All rules of one or two terms over the same intervals and values, row by row."""
    probs = ", ".join(str(i / bins) for i in range(1, bins))
    cuts = " UNION ALL ".join(f"SELECT {i} AS place, '{c}' AS col, unnest(quantile_cont(CAST({c} AS DOUBLE), [{probs}])) AS q FROM lab"
                              for i, c in enumerate(NUMERIC))
    values = " UNION ALL ".join([f"SELECT rid, hit, {i} AS place, CAST({c} AS DOUBLE) AS x, CAST(NULL AS VARCHAR) AS v FROM r" for i, c in enumerate(NUMERIC)]
                                + [f"SELECT rid, hit, {len(NUMERIC) + i} AS place, CAST(NULL AS DOUBLE) AS x, CAST({c} AS VARCHAR) AS v FROM r"
                                   for i, c in enumerate(CATEGORICAL)])
    names = ", ".join(f"({len(NUMERIC) + i}, '{c}')" for i, c in enumerate(CATEGORICAL))
    return with_ctes(*LABELLED_CTES) + f"""
, r AS (SELECT *, row_number() OVER () AS rid, CAST(coalesce(priority IN ('High', 'Very High'), false) AS INTEGER) AS hit FROM lab),
cut AS (SELECT DISTINCT place, col, round(q, 6) AS q FROM ({cuts}) WHERE q IS NOT NULL),
ends AS (SELECT place, col, q FROM cut UNION ALL SELECT DISTINCT place, col, NULL FROM cut),
iv AS (SELECT a.place, a.q AS lo, b.q AS hi, concat_ws(' AND ', CASE WHEN a.q IS NOT NULL THEN a.col || ' > ' || CAST(a.q AS VARCHAR) END,
         CASE WHEN b.q IS NOT NULL THEN a.col || ' <= ' || CAST(b.q AS VARCHAR) END) AS term
       FROM ends a JOIN ends b ON a.place = b.place AND (a.q < b.q OR (a.q IS NULL) <> (b.q IS NULL))),
vals AS ({values}),
nm AS (SELECT * FROM (VALUES {names}) t(place, col)),
m AS (SELECT rid, hit, vals.place, term FROM vals JOIN iv ON iv.place = vals.place AND (lo IS NULL OR x > lo) AND (hi IS NULL OR x <= hi) WHERE x IS NOT NULL
      UNION ALL SELECT rid, hit, vals.place, col || ' = ''' || v || '''' FROM vals JOIN nm ON nm.place = vals.place WHERE v IS NOT NULL),
ru AS (SELECT term AS rule, 1 AS n_terms, count(*) AS n, sum(hit) AS h FROM m GROUP BY place, term
       UNION ALL SELECT a.term || ' AND ' || b.term, 2, count(*), sum(a.hit) FROM m a JOIN m b ON a.rid = b.rid AND a.place < b.place
       GROUP BY a.place, a.term, b.place, b.term),
best AS (SELECT *, row_number() OVER (ORDER BY h / n DESC, n DESC, n_terms, rule) AS rk FROM ru WHERE n >= {least} * (SELECT count(*) FROM r))
SELECT CAST(rk AS INTEGER) AS rank, rule, CAST(n_terms AS INTEGER) AS n_terms, n / (SELECT count(*) FROM r) AS coverage,
       h / n AS precision, CAST(n AS BIGINT) AS n_covered FROM best WHERE rk <= {top}"""


@register("n9_rule_search", sql_round(_sql_rule_search(4, 20, 0.01), ["coverage", "precision"]))
def n9_rule_search(spark, d):
    """The 20 best of all rules of one or two terms over quartile intervals and values."""
    found = rules.rule_search(weekly_priority(spark, d), F.col("priority").isin("High", "Very High"), NUMERIC, CATEGORICAL,
                              bins=4, max_terms=2, beam=2_000, min_coverage=0.01)
    return round_doubles(found)


_P = ("(SELECT o_totalprice AS v FROM orders WHERE o_orderdate {op} DATE '1998-07-01' AND o_totalprice IS NOT NULL)")


def _periods(spark, d):
    """All dated orders, before and from the middle of 1998."""
    from kiln.sources.tables import read_table
    o, cut = read_table(spark, d, "orders"), F.lit("1998-07-01").cast("date")
    return o.filter(F.col("o_orderdate") < cut), o.filter(F.col("o_orderdate") >= cut)


@register("n10_psi", sql_round(f"""
WITH a AS {_P.format(op='<')}, b AS {_P.format(op='>=')}, r AS (SELECT min(v) AS lo, max(v) AS hi FROM a),
u AS (SELECT v, 0 AS p FROM a UNION ALL SELECT v, 1 AS p FROM b),
c AS (SELECT CAST(least(greatest(floor((v - lo) * 10 / (hi - lo)), 0), 9) AS INTEGER) AS bin,
             count_if(p = 0) AS na, count_if(p = 1) AS nb FROM u, r GROUP BY 1)
SELECT sum((greatest(nb / (SELECT count(*) FROM b), 1e-6) - greatest(na / (SELECT count(*) FROM a), 1e-6))
       * ln(greatest(nb / (SELECT count(*) FROM b), 1e-6) / greatest(na / (SELECT count(*) FROM a), 1e-6))) AS psi
FROM c""", ["psi"]))
def n10_psi(spark, d):
    a, b = _periods(spark, d)
    return round_doubles(drift.psi(a, b, "o_totalprice"))


@register("n10_ks", sql_round(f"""
WITH a AS {_P.format(op='<')}, b AS {_P.format(op='>=')},
per AS (SELECT v, count_if(p = 0) AS ca, count_if(p = 1) AS cb FROM (SELECT v, 0 AS p FROM a UNION ALL
        SELECT v, 1 AS p FROM b) GROUP BY v)
SELECT max(abs(fa / (SELECT count(*) FROM a) - fb / (SELECT count(*) FROM b))) AS ks FROM (
  SELECT sum(ca) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fa,
         sum(cb) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fb FROM per)""", ["ks"]))
def n10_ks(spark, d):
    a, b = _periods(spark, d)
    return round_doubles(drift.ks_statistic(a, b, "o_totalprice"))


@register("n10_chi_square", sql_round("""
WITH u AS (SELECT o_orderpriority AS c, CASE WHEN o_orderdate < DATE '1998-07-01' THEN 0 ELSE 1 END AS p FROM orders
           WHERE o_orderdate IS NOT NULL AND o_orderpriority IS NOT NULL),
t AS (SELECT c, count_if(p = 0) AS oa, count_if(p = 1) AS ob FROM u GROUP BY c),
n AS (SELECT count_if(p = 0) AS na, count_if(p = 1) AS nb FROM u)
SELECT sum(pow(oa - (oa + ob) * na / (na + nb), 2) / ((oa + ob) * na / (na + nb))
         + pow(ob - (oa + ob) * nb / (na + nb), 2) / ((oa + ob) * nb / (na + nb))) AS chi2,
       count(*) - 1 AS dof FROM t, n""", ["chi2"]))
def n10_chi_square(spark, d):
    a, b = _periods(spark, d)
    return round_doubles(drift.chi_square(a, b, "o_orderpriority"))
