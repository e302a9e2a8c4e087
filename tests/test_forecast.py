"""The additive forecaster against plain per-series least squares."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kiln.operators import forecast
from kiln.operators.forecast import Setting

START, CUT = dt.date(2023, 1, 1), "2023-09-30"


def panel(n_series=4, days=400, seed=0, level=1000.0):
    rng = np.random.default_rng(seed)
    out = []
    for s in range(n_series):
        t = np.arange(days)
        y = level * (s + 1) + (s - 1) * t + 40 * np.sin(2 * np.pi * t / 365) + 15 * np.cos(2 * np.pi * t / 7) + np.maximum(t - 120, 0) * .7
        x = rng.normal(size=days)
        y = y + 25 * x + rng.normal(0, 5, days)
        out += [(f"s{s}", START + dt.timedelta(days=int(i)), float(y[i]), float(x[i])) for i in t if (i + s) % 11]
    return out


SCHEMA = "series_id string, ds date, y double, x double"


def plain(rows, cutoff, s, lags=()):
    """yhat per series by numpy: standardised terms, penalty per block, normal equations by lstsq."""
    out = {}
    df = pd.DataFrame(rows, columns=["series_id", "ds", "y", "x"]).sort_values(["series_id", "ds"])
    for sid, g in df.groupby("series_id", dropna=False):
        t = np.array([(d - g.ds.min()).days for d in g.ds], float)
        train = np.array([str(d) <= cutoff for d in g.ds])
        end = t[train].max()
        cols = [t] if s.trend else []
        cols += [np.maximum(t - s.changepoint_range * end * (j + 1) / (s.n_changepoints + 1), 0) for j in range(s.n_changepoints)]
        for period, order in ((s.year_days, s.yearly), (7.0, s.weekly)):
            for k in range(1, order + 1):
                cols += [np.sin(2 * np.pi * k * t / period), np.cos(2 * np.pi * k * t / period)]
        cols += [g[c].to_numpy(float) for c in s.regressors if c == "x"]
        for lag in lags:
            v = g.y.shift(lag).to_numpy(float)
            cols.append(np.where(np.isnan(v), g.y[train].mean(), v))
        x, y = np.column_stack(cols), g.y.to_numpy(float)
        y = np.log(y) if s.multiplicative else y
        mean, sd = x[train].mean(0), x[train].std(0)
        z = (x - mean) / np.where(sd > 0, sd, 1)
        a = np.vstack([z[train], np.sqrt(s.reg * train.sum()) * np.eye(z.shape[1])])
        b = np.linalg.lstsq(a, np.concatenate([y[train] - y[train].mean(), np.zeros(z.shape[1])]), rcond=None)[0]
        fit = z @ b + y[train].mean()
        out.update({(sid, d): v for d, v in zip(g.ds, np.exp(fit) if s.multiplicative else fit)})
    return out


def close(pred, want):
    got = {(r.series_id, r.ds): r.yhat for r in pred.collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[k] - want[k]) / max(1, abs(want[k])) for k in want) < 1e-6


CASES = [Setting(n_changepoints=0, yearly=2, weekly=1, reg=0.0), Setting(n_changepoints=0, yearly=2, weekly=0, reg=0.0, trend=False, year_days=365.0),
         Setting(n_changepoints=8, yearly=3, weekly=3, reg=0.01, regressors=("x",)), Setting(n_changepoints=25, reg=0.1),
         Setting(n_changepoints=5, changepoint_range=0.9, yearly=1, reg=0.001, multiplicative=True)]


def test_every_setting_equals_least_squares(spark):
    """All settings from one pass; each equals its own fit by numpy."""
    rows = panel()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    pred = forecast.forecasts(df, CUT, CASES).persist()
    for trial, s in enumerate(CASES):
        close(pred.filter(F.col("trial") == trial), plain(rows, CUT, s))
    pred.unpersist()


def test_lags_and_single_model(spark):
    rows = panel(3)
    df = spark.createDataFrame(rows, SCHEMA)
    s = Setting(n_changepoints=2, yearly=1, weekly=1, reg=0.05, regressors=("x",))
    got = forecast.additive_forecast(df, CUT, n_changepoints=2, yearly=1, weekly=1, reg=0.05, regressors=["x"], lags=[1, 7])
    assert got.columns == ["series_id", "ds", "split", "y", "yhat"]
    close(got, plain(rows, CUT, s, (1, 7)))
    close(forecast.seasonal_regression(df, CUT, 3), plain(rows, CUT, Setting(n_changepoints=0, yearly=3, weekly=0, reg=0.0, trend=False, year_days=365.0)))


def test_grid_is_one_pass_without_python(spark):
    rows = panel(3)
    df = spark.createDataFrame(rows, SCHEMA)
    grid = [{"reg": r, "n_changepoints": c, "yearly": y} for r in (0.001, 0.1) for c in (3, 5) for y in (1, 2)]
    out = forecast.grid_search(df, CUT, grid, weekly=1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    got = {r.trial: r.mae for r in out.collect()}
    y = {(r[0], r[1]): r[2] for r in rows if str(r[1]) > CUT}
    for i, p in enumerate(grid):
        want = plain(rows, CUT, Setting(weekly=1, **p))
        assert got[i] == pytest.approx(np.mean([abs(y[k] - want[k]) for k in y]), rel=1e-6)
    assert [r.mae for r in out.collect()] == sorted(got.values())
    by = forecast.grid_search(df, CUT, grid, by_series=True, weekly=1)
    assert by.count() == 3 * len(grid)
    with pytest.raises(ValueError, match="unknown"):
        forecast.grid_search(df, CUT, [{"regg": 1}])


def test_prior_scales_shrink_their_block(spark):
    rows = panel(2)
    df = spark.createDataFrame(rows, SCHEMA)
    grid = [{"changepoint_prior_scale": c, "seasonality_prior_scale": s} for c in (1e-6, 0.5) for s in (1e-6, 10.0)]
    pred = forecast.forecasts(df, CUT, [Setting(n_changepoints=8, yearly=1, weekly=1, **g) for g in grid])
    err = {r.trial: r.e for r in pred.filter("split = 'train'").groupBy("trial").agg(F.avg(F.abs(F.col("y") - F.col("yhat"))).alias("e")).collect()}
    assert err[3] < err[1] and err[3] < err[2] and err[1] < err[0] and err[2] < err[0]


def test_odd_rows(spark):
    """Null targets and regressors, a null series, a series without train rows, one
    train row, a constant series, values that have no logarithm."""
    day = [START + dt.timedelta(days=i) for i in range(300)]
    rows = [("a", day[i], None if i == 5 else 3.0 * i + 7, None if i == 9 else float(i % 4)) for i in range(300)]
    rows += [(None, day[i], 5.0 - i, 1.0) for i in range(300)]
    rows += [("late", day[i], 1.0, 0.0) for i in range(290, 300)]
    rows += [("one", day[0], 4.0, 0.0), ("one", day[299], 9.0, 0.0)] + [("flat", day[i], 2.0, 1.0) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    settings = [Setting(n_changepoints=0, yearly=0, weekly=0, reg=0.0), Setting(n_changepoints=0, yearly=0, weekly=0, reg=0.0, multiplicative=True)]
    got = {(r.series_id, r.ds, r.trial): r.yhat for r in forecast.forecasts(df, CUT, settings, regressors=["x"]).collect()}
    assert len(got) == 2 * len(rows)
    assert got["a", day[299], 0] == pytest.approx(3 * 299 + 7) and got["a", day[5], 0] == pytest.approx(22) and got["a", day[9], 0] is None
    assert got[None, day[299], 0] == pytest.approx(5 - 299) and got[None, day[299], 1] is None
    assert got["late", day[295], 0] is None
    assert got["one", day[299], 0] == pytest.approx(4) and got["flat", day[299], 0] == pytest.approx(2) and got["flat", day[299], 1] == pytest.approx(2)
    assert forecast.forecasts(df.limit(0), CUT, settings, regressors=["x"]).count() == 0


def test_model_beats_the_mean_of_its_series(spark):
    rows = panel(3)
    df = spark.createDataFrame(rows, SCHEMA)
    mae = forecast.forecast_mae(forecast.additive_forecast(df, CUT, n_changepoints=5, yearly=1, regressors=["x"])).first()["mae"]
    means = df.filter(F.col("ds") <= CUT).groupBy("series_id").agg(F.avg("y").alias("m"))
    base = df.filter(F.col("ds") > CUT).join(means, "series_id").agg(F.avg(F.abs(F.col("y") - F.col("m")))).first()[0]
    assert mae < base / 2
