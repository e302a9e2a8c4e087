"""Forecasting (K9–K11, N1) on daily series with a ``series_id`` key.

K11 re-aims the reference's Bayesian additive forecaster as penalised least
squares on the same additive terms: piecewise-linear trend (hinges at evenly
spaced changepoints over the first part of the training span), yearly and
weekly Fourier terms, exogenous regressors and lag terms.

A fit is one grouped aggregate.  The terms of the widest model asked for are
columns; a train row is exploded into one row per term, and the sums of its
products with all terms give one line of the series' cross-product matrix (with
partial sums before the shuffle).  Every setting (penalty, changepoints, order
of the Fourier terms, additive or log target) is a sub-matrix of that one
matrix, solved by elimination in array expressions, and predictions are dot
products of terms and coefficients.  So the work of a fit does not depend on the
length of a series after the one pass, a grid of settings reads the data once,
and nothing leaves the JVM."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.operators import metrics
from kiln.operators.features import lag_block_train_mean
from kiln.operators.windows import elapsed_days

#: Pivots of a correlation matrix below this are linear combinations of the terms before them; such terms get 0.
DEPENDENT = 1e-9


def trend_fit(df: DataFrame, t: str, y: str, key: str | None = None) -> DataFrame:
    """K9: least-squares line y = a + b·t (``regr_slope`` / ``regr_intercept``), per series with ``key``."""
    return df.groupBy(*([key] if key else [])).agg(F.regr_slope(y, t).alias("slope"), F.regr_intercept(y, t).alias("intercept"))


@dataclass(frozen=True)
class Setting:
    """One additive model.

    ``reg`` is the L2 penalty on the coefficients of standardised terms.  A prior
    scale replaces it for its block of terms: the penalty of a coefficient with a
    normal prior of that standard deviation, noise / (rows · scale²), where the noise
    is the share of the target's variance that the widest model leaves."""
    n_changepoints: int = 25
    changepoint_range: float = 0.8
    yearly: int = 10
    weekly: int = 3
    reg: float = 0.01
    changepoint_prior_scale: float | None = None
    seasonality_prior_scale: float | None = None
    multiplicative: bool = False
    trend: bool = True
    year_days: float = 365.25
    regressors: tuple[str, ...] = ()

    def terms(self) -> list[tuple]:
        """The model's terms, each by what defines it."""
        out = [("trend",)] if self.trend else []
        out += [("hinge", round(self.changepoint_range * (j + 1) / (self.n_changepoints + 1), 12)) for j in range(self.n_changepoints)]
        out += [(f, period, k) for period, order in ((self.year_days, self.yearly), (7.0, self.weekly))
                for k in range(1, order + 1) for f in ("sin", "cos")]
        return out + [("column", c) for c in self.regressors]

    def penalty(self, term: tuple) -> tuple[float, float]:
        """(fixed part, part per noise / rows) of a term's penalty."""
        scale = {"hinge": self.changepoint_prior_scale, "sin": self.seasonality_prior_scale, "cos": self.seasonality_prior_scale}.get(term[0])
        return (self.reg, 0.0) if scale is None else (0.0, 1.0 / scale ** 2)


def term_column(term: tuple) -> Column:
    """A term as a column over ``t`` (days), ``_end`` (the last train day) and the regressors."""
    t = F.col("t")
    if term[0] == "trend":
        return t
    if term[0] == "hinge":
        return F.greatest(t - F.col("_end") * term[1], F.lit(0.0))
    if term[0] == "column":
        return F.col(term[1]).cast("double")
    angle = t * (2 * math.pi * term[2] / term[1])
    return F.sin(angle) if term[0] == "sin" else F.cos(angle)


def widest(settings: list[Setting]) -> list[tuple]:
    """All terms of all settings, each once."""
    return list(dict.fromkeys(t for s in settings for t in s.terms()))


def designed(panel: DataFrame, terms: list[tuple], y: str) -> DataFrame:
    """``panel`` (series_id, ds, split, t, y, regressors) plus ``_x``: 1, the terms,
    the target and its logarithm.  Rows with a null or NaN term have a null ``_x``."""
    ends = panel.filter("split = 'train'").groupBy(F.col("series_id").alias("_sid")).agg(F.max("t").alias("_end"))
    x = [F.lit(1.0), *map(term_column, terms)]
    whole = F.lit(True)
    for term, c in zip(terms, x[1:]):
        if term[0] == "column":
            whole = whole & c.isNotNull() & ~F.isnan(c)
    target = F.col(y).cast("double")
    log = F.when(target > 0, F.log(target))
    return (panel.join(ends, F.col("series_id").eqNullSafe(F.col("_sid")), "left").drop("_sid")
            .withColumn("_x", F.when(whole & F.col("_end").isNotNull(), F.array(*x, target, log))))


def cross_products(rows: DataFrame, width: int) -> DataFrame:
    """One row per series: ``_g``, the matrix of sums of products of the entries of
    ``_x`` over train rows with a target.  The logarithm of a target that is not
    positive counts as 0 and is told by ``_positive``."""
    use = rows.filter(f"split = 'train' AND _x IS NOT NULL AND _x[{width - 2}] IS NOT NULL AND NOT isnan(_x[{width - 2}])")
    use = use.select("series_id", F.expr("transform(_x, v -> coalesce(v, 0D))").alias("_x"), F.col("_x")[width - 1].isNotNull().alias("_positive"))
    lines = (use.select("series_id", "_x", "_positive", F.posexplode("_x").alias("_i", "_v"))
             .groupBy("series_id", "_i").agg(F.array(*[F.sum(F.col("_v") * F.col("_x")[j]) for j in range(width)]).alias("_line"),
                                             F.min("_positive").alias("_positive")))
    # a series has ``width`` lines
    return lines.groupBy("series_id").agg(
        F.expr("transform(array_sort(collect_list(struct(_i, _line))), s -> s._line)").alias("_g"), F.min("_positive").alias("_positive"))


def solved(matrix: str) -> str:
    """SQL of the solution of a square system with its right-hand side as last
    column: elimination with the pivots on the diagonal, which suits the positive
    definite matrices here; dependent terms are left out (0)."""
    step = (f"CASE WHEN m[k][k] <= {DEPENDENT!r}D THEN r WHEN i = k THEN transform(r, v -> v / m[k][k]) "
            "ELSE zip_with(r, m[k], (a, b) -> a - r[k] / m[k][k] * b) END")
    return (f"aggregate(sequence(0, size({matrix}) - 1), {matrix}, (m, k) -> transform(m, (r, i) -> {step}), "
            f"m -> transform(m, (r, i) -> CASE WHEN r[i] > 0.5D THEN r[size(m)] ELSE 0D END))")


def coefficients(products: DataFrame, settings: list[Setting], terms: list[tuple]) -> DataFrame:
    """(series_id, trial, _b): the coefficients of 1 and all terms (0 for the
    terms that a setting has not), on the terms' own scale.  Null where the
    setting takes the logarithm of a target that is not positive."""
    width = len(terms) + 3
    plan = []
    for trial, s in enumerate(settings):
        at = [terms.index(t) + 1 for t in s.terms()]
        fixed, noisy = zip(*[s.penalty(t) for t in s.terms()]) if at else ((), ())
        plan.append({"trial": trial, "at": at, "fixed": fixed, "noisy": noisy, "target": width - 1 if s.multiplicative else width - 2})
    plan = F.from_json(F.lit(json.dumps(plan)), "array<struct<trial int, at array<int>, fixed array<double>, noisy array<double>, target int>>")
    everything = f"sequence(1, {width - 3})" if terms else "array()"
    std = (products.withColumn("_mean", F.expr("transform(_g[0], v -> v / _g[0][0])"))
           .withColumn("_sd", F.expr("transform(_g, (r, i) -> sqrt(greatest(r[i] / _g[0][0] - _mean[i] * _mean[i], 0D)))"))
           # a spread within rounding of the mean is none
           .withColumn("_sd", F.expr("transform(_sd, (s, i) -> CASE WHEN s > 1e-7D * abs(_mean[i]) + 1e-12D THEN s ELSE 0D END)"))
           .withColumn("_r", F.expr("transform(_g, (r, i) -> transform(r, (v, j) -> CASE WHEN _sd[i] > 0 AND _sd[j] > 0 "
                                    "THEN (v / _g[0][0] - _mean[i] * _mean[j]) / (_sd[i] * _sd[j]) ELSE 0D END))")))
    if any(s.penalty(t)[1] for s in settings for t in s.terms()):
        for y in (width - 2, width - 1):
            full = (f"transform({everything}, (i, a) -> concat(transform({everything}, (j, b) -> _r[i][j] + IF(a = b, 1e-6D, 0D)), array(_r[i][{y}])))")
            std = std.withColumn("_full", F.expr(full))
            std = std.withColumn(f"_noise{y}", F.expr(
                f"greatest(1e-6D, 1D - aggregate(zip_with({solved('_full')}, {everything}, (b, i) -> b * _r[i][{y}]), 0D, (s, v) -> s + v))"))
        noise = f"IF(_p.target = {width - 1}, _noise{width - 1}, _noise{width - 2})"
    else:
        noise = "0D"
    each = std.withColumn("_p", F.explode(plan)).withColumn("_m", F.expr(
        "transform(_p.at, (i, a) -> concat(transform(_p.at, (j, b) -> _r[i][j] + "
        f"IF(a = b, _p.fixed[a] + _p.noisy[a] * {noise} / _g[0][0], 0D)), array(_r[i][_p.target])))"))
    each = (each.withColumn("_z", F.expr(f"IF(size(_m) = 0, CAST(array() AS array<double>), {solved('_m')})"))
            .withColumn("_slope", F.expr("transform(_z, (z, a) -> IF(_sd[_p.at[a]] > 0, z * _sd[_p.target] / _sd[_p.at[a]], 0D))"))
            .withColumn("_first", F.expr("_mean[_p.target] - aggregate(zip_with(_slope, _p.at, (b, i) -> b * _mean[i]), 0D, (s, v) -> s + v)"))
            .withColumn("_b", F.expr(f"transform(sequence(0, {width - 3}), i -> CASE WHEN i = 0 THEN _first "
                                     "ELSE coalesce(get(_slope, CAST(array_position(_p.at, i) AS int) - 1), 0D) END)")))
    return each.select("series_id", F.col("_p.trial").alias("trial"),
                       F.when((F.col("_p.target") == width - 2) | F.col("_positive"), F.col("_b")).alias("_b"))


def panel_rows(series: DataFrame, cutoff: str, y: str, regressors: list[str], lags: list[int],
               more: list[str]) -> tuple[DataFrame, tuple[str, ...]]:
    """The series with elapsed days, split, lag columns and ``more`` columns; and the regressors' names."""
    s = elapsed_days(series, "ds", "t", key="series_id").withColumn("t", F.col("t").cast("double"))
    s = s.withColumn("split", F.when(F.col("ds") <= F.lit(cutoff).cast("date"), "train").otherwise("test"))
    extra = list(regressors)
    if lags:
        s = lag_block_train_mean(s, "series_id", "ds", y, lags, F.col("split") == "train")
        extra += [f"{y}_lag{L}" for L in lags]
    kept = dict.fromkeys(["series_id", "ds", "split", "t", y, *extra, *more])
    return s.select(*kept), tuple(extra)


def forecasts(series: DataFrame, cutoff: str, settings: list[Setting], regressors: list[str] | None = None,
              lags: list[int] | None = None, y: str = "y") -> DataFrame:
    """Fit every setting on every series' rows of ds ≤ cutoff and predict every row:
    (series_id, ds, split, trial, y, yhat); ``trial`` numbers the settings from 0.

    A null series_id is a series.  Rows with a null target or a null regressor are not
    fitted on; rows with a null regressor, and series without train rows, predict null."""
    panel, extra = panel_rows(series, cutoff, y, regressors or [], lags or [], [c for s in settings for c in s.regressors])
    settings = [replace(s, regressors=tuple(dict.fromkeys((*s.regressors, *extra)))) for s in settings]
    terms = widest(settings)
    rows = designed(panel, terms, y)
    fitted = coefficients(cross_products(rows, len(terms) + 3), settings, terms)
    trials = F.explode(F.sequence(F.lit(0), F.lit(len(settings) - 1)))
    rows = rows.withColumn("trial", trials)
    fitted = fitted.select(F.col("series_id").alias("_sid"), F.col("trial").alias("_trial"), "_b")
    log = F.array(*[F.lit(s.multiplicative) for s in settings])
    value = F.expr(f"aggregate(zip_with(slice(_x, 1, {len(terms) + 1}), _b, (v, b) -> v * b), 0D, (s, v) -> s + v)")
    return (rows.join(fitted, F.col("series_id").eqNullSafe(F.col("_sid")) & (F.col("trial") == F.col("_trial")), "left")
            .withColumn("yhat", F.when(log[F.col("trial")], F.exp(value)).otherwise(value))
            .select("series_id", "ds", "split", "trial", y, "yhat"))


def additive_forecast(series: DataFrame, cutoff: str, n_changepoints: int = 25, yearly: int = 10,
                      weekly: int = 3, regressors: list[str] | None = None, lags: list[int] | None = None,
                      reg: float = 0.01, multiplicative: bool = False, y: str = "y", **more) -> DataFrame:
    """One additive model per series: (series_id, ds, split, y, yhat)."""
    s = Setting(n_changepoints=n_changepoints, yearly=yearly, weekly=weekly, reg=reg, multiplicative=multiplicative, **more)
    return forecasts(series, cutoff, [s], regressors, lags, y).drop("trial")


def seasonal_regression(series: DataFrame, cutoff: str, order: int = 5, period: float = 365.0, y: str = "y") -> DataFrame:
    """Least squares on the Fourier terms alone."""
    return additive_forecast(series, cutoff, n_changepoints=0, yearly=order, weekly=0, reg=0.0, y=y, trend=False, year_days=period)


def forecast_mae(pred: DataFrame) -> DataFrame:
    return metrics.mae(pred.filter(F.col("split") == "test"), "y", "yhat")


def grid_search(series: DataFrame, cutoff: str, grid: list[dict], regressors: list[str] | None = None,
                lags: list[int] | None = None, y: str = "y", by_series: bool = False, **fixed) -> DataFrame:
    """Every parameter combination on the cut-off split; (trial, params, mae)
    with the validation MAE, best first.  One pass of cross products serves all
    combinations, one pass over the test rows scores them.  ``by_series`` ranks the
    combinations of every series."""
    known = {f.name for f in fields(Setting)}
    unknown = {k for p in (*grid, fixed) for k in p} - known
    if unknown:
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    pred = forecasts(series, cutoff, [Setting(**{**fixed, **p}) for p in grid], regressors, lags, y)
    names = F.array(*[F.lit(str(sorted(p.items()))) for p in grid])
    by = ["series_id"] if by_series else []
    errors = pred.filter("split = 'test'").groupBy(*by, "trial").agg(F.avg(F.abs(F.col(y) - F.col("yhat"))).alias("mae"))
    return errors.select(*by, "trial", names[F.col("trial")].alias("params"), "mae").orderBy(*by, F.asc_nulls_last("mae"), "trial")
