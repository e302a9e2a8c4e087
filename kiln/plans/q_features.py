"""Queries: fitted feature operators (I2–I10, I13, I16–I18) and splits (J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import aggs, features as ft, splits as sp
from kiln.plans.common import round_doubles, sql_round
from kiln.plans.q_core import SQL_CLIENT_P, client_pending
from kiln.plans.registry import register
from kiln.plans.sqlparts import SQL_DAILY, SQL_PANEL, SQL_RATINGS, SQL_TX, WEEKLY_CTES, with_ctes
from kiln.sources import proxies
from kiln.sources.tables import read_table

_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _i2_sql():
    qs = ", ".join(f"quantile_cont({c}, [0.25, 0.75]) AS q_{c}" for c in _NUM)
    cl = ", ".join(f"greatest(least({c}, q_{c}[2] + 1.5 * (q_{c}[2] - q_{c}[1])), q_{c}[1] - 1.5 * (q_{c}[2] - q_{c}[1]))"
                   f" AS {c}" for c in _NUM)
    return sql_round(f"SELECT l_orderkey, l_linenumber, {cl} FROM lineitem, (SELECT {qs} FROM lineitem)", _NUM)


@register("i2_iqr_clip", _i2_sql())
def i2_iqr_clip(spark, d):
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *_NUM)
    return round_doubles(ft.IQRClipper(_NUM, 1.5).fit(li).transform(li))


@register("i3_simple_imputers", sql_round(with_ctes(SQL_CLIENT_P) + """
SELECT c_custkey, coalesce(v_p, (SELECT avg(v_p) FROM cp)) AS v_p_mean,
       coalesce(v_p, (SELECT quantile_cont(v_p, 0.5) FROM cp)) AS v_p_median,
       coalesce(prio_p, (SELECT prio_p FROM cp WHERE prio_p IS NOT NULL GROUP BY prio_p
                         ORDER BY count(*) DESC, prio_p LIMIT 1)) AS prio_p_mode FROM cp""",
    ["v_p_mean", "v_p_median"]))
def i3_simple_imputers(spark, d):
    cp = client_pending(spark, d).select("c_custkey", "v_p", "prio_p")
    mean = ft.SimpleImputer(["v_p"], "mean").fit(cp)
    med = ft.SimpleImputer(["v_p"], "median").fit(cp)
    mode = ft.SimpleImputer(["prio_p"], "most_frequent").fit(cp)
    out = cp.select("c_custkey", F.col("v_p").alias("v_p_mean"), F.col("v_p").alias("v_p_median"),
                    F.col("prio_p").alias("prio_p_mode"))
    out = out.withColumns({"v_p_mean": F.coalesce("v_p_mean", F.lit(mean.values["v_p"])),
                           "v_p_median": F.coalesce("v_p_median", F.lit(med.values["v_p"])),
                           "prio_p_mode": F.coalesce("prio_p_mode", F.lit(mode.values["prio_p"]))})
    return round_doubles(out)


@register("i4_group_mode_imputer", with_ctes(SQL_CLIENT_P) + """
, gm AS (SELECT c_mktsegment, prio_p AS m FROM (SELECT c_mktsegment, prio_p, row_number() OVER (
           PARTITION BY c_mktsegment ORDER BY count(*) DESC, prio_p) AS rn
         FROM cp WHERE prio_p IS NOT NULL GROUP BY c_mktsegment, prio_p) WHERE rn = 1)
SELECT cp.c_custkey, cp.c_mktsegment, coalesce(cp.prio_p, gm.m, (SELECT prio_p FROM cp WHERE prio_p IS NOT NULL
  GROUP BY prio_p ORDER BY count(*) DESC, prio_p LIMIT 1), 'Unknown') AS prio_p
FROM cp LEFT JOIN gm ON cp.c_mktsegment = gm.c_mktsegment""")
def i4_group_mode_imputer(spark, d):
    cp = client_pending(spark, d).select("c_custkey", "c_mktsegment", "prio_p")
    return ft.GroupModeImputer(["prio_p"], "c_mktsegment").fit(cp).transform(cp)


@register("i6_minmax_scaler", sql_round("SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"CASE WHEN max({c}) OVER () = min({c}) OVER () THEN 0.0 ELSE ({c} - min({c}) OVER ()) / "
    f"(max({c}) OVER () - min({c}) OVER ()) END AS {c}" for c in _NUM) + " FROM lineitem", _NUM))
def i6_minmax_scaler(spark, d):
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *_NUM)
    return round_doubles(ft.MinMaxScaler(_NUM).fit(li).transform(li))


@register("i7_standard_scaler", sql_round("SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1) AS {c}" for c in _NUM)
    + " FROM lineitem", _NUM))
def i7_standard_scaler(spark, d):
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *_NUM)
    return round_doubles(ft.StandardScaler(_NUM).fit(li).transform(li))


_SEGMENTS_AFTER_FIRST = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("i8_one_hot_drop_first", "SELECT c_custkey, " + ", ".join(
    f"CAST(c_mktsegment = '{v}' AS INTEGER) AS c_mktsegment_{v}" for v in _SEGMENTS_AFTER_FIRST) + " FROM customer")
def i8_one_hot_drop_first(spark, d):
    c = read_table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return ft.OneHotDropFirst(["c_mktsegment"]).fit(c).transform(c)


@register("i9_rare_categories", """
SELECT doc_id, CASE WHEN lang IS NULL OR lang IN (SELECT lang FROM documents WHERE lang IS NOT NULL GROUP BY lang
  HAVING count(*) / (SELECT count(*) FROM documents) >= 0.12) THEN lang ELSE 'infrequent_sklearn' END AS lang
FROM documents""")
def i9_rare_categories(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "lang")
    return ft.RareCategoryGrouper("lang", 0.12).fit(docs).transform(docs)


@register("i10_id_encoder", """
WITH fit AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS k FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'),
codes AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS code FROM fit)
SELECT c.c_custkey, coalesce(codes.code, (SELECT count(*) FROM fit)) AS c_code
FROM customer c LEFT JOIN codes ON CAST(c.c_custkey AS VARCHAR) = codes.k""")
def i10_id_encoder(spark, d):
    fit = (read_table(spark, d, "orders").filter(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
           .select(F.col("o_custkey").alias("c_custkey")))
    enc = ft.IdEncoder(["c_custkey"]).fit(fit)
    c = read_table(spark, d, "customer").select("c_custkey", F.col("c_custkey").alias("c_code"))
    return enc.transform(c.withColumnRenamed("c_custkey", "_id").withColumnRenamed("c_code", "c_custkey")) \
        .withColumnRenamed("c_custkey", "c_code").withColumnRenamed("_id", "c_custkey")


_BLOCKS = [("year", 365.0, 5), ("week", 7.0, 3)]
_FCOLS = [f"{b}_{f}{k}" for b, p, n in _BLOCKS for k in range(1, n + 1) for f in ("sin", "cos")]


def _i13_sql():
    terms = ", ".join(f"{f}(2 * pi() * {k} * t / {p}) AS {b}_{f}{k}" for b, p, n in _BLOCKS
                      for k in range(1, n + 1) for f in ("sin", "cos"))
    return sql_round(with_ctes(SQL_DAILY) + f"""SELECT ds, t, {terms} FROM (
  SELECT ds, CAST(datediff('day', (SELECT min(ds) FROM daily), ds) AS INTEGER) AS t FROM daily)""", _FCOLS)


@register("i13_fourier_block", _i13_sql())
def i13_fourier_block(spark, d):
    from kiln.operators.windows import elapsed_days
    s = elapsed_days(proxies.daily_series(spark, d).select("ds"), "ds")
    return round_doubles(ft.fourier_block(s, "t", _BLOCKS))


_LAGS = range(1, 8)


@register("i16_lags_train_mean", sql_round(with_ctes(SQL_PANEL) + "SELECT p.series_id, ds, y, " + ", ".join(
    f"coalesce(lag(y, {L}) OVER (PARTITION BY p.series_id ORDER BY ds), m.mu) AS y_lag{L}" for L in _LAGS) + """ FROM panel p
LEFT JOIN (SELECT series_id, avg(y) AS mu FROM panel WHERE ds <= DATE '2000-02-29' GROUP BY series_id) m
  ON p.series_id IS NOT DISTINCT FROM m.series_id""", ["y"] + [f"y_lag{L}" for L in _LAGS], 4))
def i16_lags_train_mean(spark, d):
    out = ft.lag_block_train_mean(proxies.daily_panel(spark, d), "series_id", "ds", "y", _LAGS,
                                  F.col("ds") <= F.lit("2000-02-29").cast("date"))
    return round_doubles(out, 4)


_PACF_STEPS = ["q1 AS (SELECT series_id, n, r, [r[1]] AS phi, [r[1]] AS pacf FROM rho)"]
for _k in range(2, 8):
    _kk = (f"((r[{_k}] - list_sum([phi[j] * r[{_k} - j] for j in range(1, {_k})])) "
           f"/ (1 - list_sum([phi[j] * r[j] for j in range(1, {_k})])))")
    _PACF_STEPS.append(f"""s{_k} AS (SELECT *, {_kk} AS kk FROM q{_k - 1}),
q{_k} AS (SELECT series_id, n, r, list_append([phi[j] - kk * phi[{_k} - j] for j in range(1, {_k})], kk) AS phi,
  list_append(pacf, kk) AS pacf FROM s{_k})""")


@register("i17_pacf_lags", sql_round(with_ctes(SQL_PANEL) + """
, c AS (SELECT series_id, ds, y - avg(y) OVER (PARTITION BY series_id) AS x FROM panel),
l AS (SELECT series_id, x, """ + ", ".join(f"lag(x, {k}) OVER (PARTITION BY series_id ORDER BY ds) AS l{k}" for k in range(1, 8)) + """ FROM c),
rho AS (SELECT series_id, count(*) AS n, [""" + ", ".join(f"sum(x * l{k}) / sum(x * x)" for k in range(1, 8)) + """] AS r FROM l GROUP BY series_id),
""" + ",\n".join(_PACF_STEPS) + """,
e AS (SELECT series_id, n, unnest(range(1, 8)) AS lag, unnest(pacf) AS pacf, 1.96 / sqrt(n) AS bound FROM q7)
SELECT series_id, CAST(lag AS INTEGER) AS lag, pacf, CASE WHEN max(abs(pacf)) OVER (PARTITION BY series_id) > bound
  THEN abs(pacf) > bound ELSE lag = 1 END AS selected, bound FROM e""", ["pacf", "bound"]))
def i17_pacf_lags(spark, d):
    return round_doubles(ft.pacf_lags(proxies.daily_panel(spark, d), "series_id", "ds", "y", 7))


@register("i18_class_weights", sql_round("""
SELECT doc_id, quality, (SELECT count(*) FROM labels) / ((SELECT count(DISTINCT quality) FROM labels) * n) AS weight
FROM labels JOIN (SELECT quality AS q, count(*) AS n FROM labels GROUP BY quality) c ON labels.quality = c.q""",
    ["weight"]))
def i18_class_weights(spark, d):
    lb = read_table(spark, d, "labels").select("doc_id", "quality")
    return round_doubles(ft.class_weights(lb, "quality"))


@register("i18_oversample", """
WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality)
SELECT l.doc_id, l.quality, l.toxic FROM labels l JOIN c ON l.quality = c.quality,
  range(CAST(floor((SELECT max(n) FROM c) / c.n) AS BIGINT)) AS t(i)""")
def i18_oversample(spark, d):
    return ft.oversample(read_table(spark, d, "labels"), "quality")


# ----------------------------------------------------------------- splits ----

@register("j1_ordered_holdout", with_ctes(*WEEKLY_CTES[:4]) + """
SELECT customer_id, week, product_id, weekly_items, CASE WHEN pos >= n - ceil(n * CAST(0.1 AS DOUBLE)) THEN 'test'
  WHEN pos >= (n - ceil(n * CAST(0.1 AS DOUBLE))) - ceil((n - ceil(n * CAST(0.1 AS DOUBLE))) * CAST(0.2 AS DOUBLE))
  THEN 'val' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY week, customer_id, product_id) - 1 AS pos, count(*) OVER () AS n FROM wf)""")
def j1_ordered_holdout(spark, d):
    wf = aggs.weekly_rollup(proxies.transactions(spark, d))
    return sp.ordered_holdout(wf, ["week", "customer_id", "product_id"])


@register("j2_stratified_holdout", """
SELECT doc_id, quality, toxic, CASE WHEN pos < ceil(n * CAST(0.2 AS DOUBLE)) THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS pos,
             count(*) OVER (PARTITION BY quality) AS n FROM labels)""")
def j2_stratified_holdout(spark, d):
    return sp.stratified_holdout(read_table(spark, d, "labels"), "quality", "doc_id", 0.2)


_HB = "CAST(CAST(('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8)) AS BIGINT) % 100 AS INTEGER)"


@register("j3_random_split", f"""
SELECT o_orderkey, CASE WHEN b < 70 THEN 'train' WHEN b < 90 THEN 'val' WHEN b < 100 THEN 'test' END AS split
FROM (SELECT o_orderkey, {_HB.format(k='o_orderkey')} AS b FROM orders)""")
def j3_random_split(spark, d):
    o = read_table(spark, d, "orders").select("o_orderkey")
    return sp.hash_split(o, "o_orderkey", [("train", 70), ("val", 20), ("test", 10)])


@register("j4_cutoff_split", with_ctes(SQL_DAILY) + """
SELECT ds, CASE WHEN ds <= DATE '2000-02-29' THEN 'train' ELSE 'test' END AS split FROM daily""")
def j4_cutoff_split(spark, d):
    return sp.cutoff_split(proxies.daily_series(spark, d).select("ds"), "ds", "2000-02-29")


@register("j5_rating_holdout", with_ctes(SQL_RATINGS) + f"""
SELECT user_id, item_id, CASE WHEN b < 30 THEN 'test' WHEN b < 100 THEN 'train' END AS split
FROM (SELECT user_id, item_id, {_HB.format(k="(CAST(user_id AS VARCHAR) || '|' || item_id)")} AS b FROM ratings)""")
def j5_rating_holdout(spark, d):
    r = proxies.ratings(spark, d).select("user_id", "item_id")
    r = r.withColumn("_k", F.concat_ws("|", F.col("user_id").cast("string"), "item_id"))
    return sp.hash_split(r, "_k", [("test", 30), ("train", 70)]).drop("_k")


@register("j6_stratified_folds", """
SELECT doc_id, quality, toxic, CAST((row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id)
  - 1) % 5 AS INTEGER) AS fold FROM labels""")
def j6_stratified_folds(spark, d):
    return sp.stratified_folds(read_table(spark, d, "labels"), "quality", "doc_id", 5)


@register("e6_positional_split", with_ctes(*WEEKLY_CTES[:4]) + """
SELECT customer_id, week, product_id, weekly_items, CASE WHEN pos >= n - ceil(n * CAST(0.1 AS DOUBLE)) THEN 'test'
  WHEN pos >= (n - ceil(n * CAST(0.1 AS DOUBLE))) - ceil((n - ceil(n * CAST(0.1 AS DOUBLE))) * CAST(0.2 AS DOUBLE))
  THEN 'val' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY week, customer_id, product_id) - 1 AS pos, count(*) OVER () AS n FROM wf)""")
def e6_positional_split(spark, d):
    """E6 is the positional split of J1, computed by the distributed row numbering."""
    return j1_ordered_holdout(spark, d)


@register("i15_feature_pipeline")
def i15_feature_pipeline(spark, d):
    """The fitted I15 pipeline applied to every weekly row: the feature vector
    as an array, next to the row keys and the split it was fitted on."""
    from pyspark.ml.functions import vector_to_array
    from kiln.operators.pipeline import feature_pipeline
    from kiln.plans.q_models import CATEGORICAL, IDS, NUMERIC, priority_split
    data = priority_split(spark, d)
    model = feature_pipeline(NUMERIC, CATEGORICAL, IDS).fit(data.filter(F.col("split") == "train"))
    return model.transform(data).select("customer_id", "week", "product_id", "split",
                                        vector_to_array("features").alias("features"))


_LAMBDAS = [0.5, 1.0, 1.5, 2.0, 3.0]


def _i2_sweep_sql():
    qs = ", ".join(f"quantile_cont({c}, [0.25, 0.75]) AS q_{c}" for c in _NUM)
    parts = []
    for lam in _LAMBDAS:
        for c in _NUM:
            lo = f"q_{c}[1] - {lam} * (q_{c}[2] - q_{c}[1])"
            hi = f"q_{c}[2] + {lam} * (q_{c}[2] - q_{c}[1])"
            parts.append(f"SELECT CAST({lam} AS DOUBLE) AS lam, '{c}' AS column_name, "
                         f"CAST(count_if({c} < {lo} OR {c} > {hi}) AS BIGINT) AS n_clipped FROM lineitem, q")
    return f"WITH q AS (SELECT {qs} FROM lineitem) " + " UNION ALL ".join(parts)


@register("i2_iqr_lambda_sweep", _i2_sweep_sql())
def i2_iqr_lambda_sweep(spark, d):
    """I2 λ sweep: values each λ would clip, per column (one quantile sort for
    all columns, one aggregate per λ)."""
    from functools import reduce
    from pyspark.sql import DataFrame
    li = read_table(spark, d, "lineitem").select(*_NUM)
    fitted = {lam: ft.IQRClipper(_NUM, lam) for lam in _LAMBDAS}
    base = ft.IQRClipper(_NUM, 0.0).fit(li)  # quartiles once
    frames = []
    for lam, clipper in fitted.items():
        clipper.bounds = {c: (lo - lam * (hi - lo), hi + lam * (hi - lo)) for c, (lo, hi) in base.bounds.items()}
        row = li.agg(*[F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(c) for c, (lo, hi) in clipper.bounds.items()])
        frames.append(row.unpivot([], _NUM, "column_name", "n_clipped").withColumn("lam", F.lit(float(lam))))
    return reduce(DataFrame.unionByName, frames)
