"""Gram-matrix forecasts and feature losses against plain least squares."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlens.catalog.queries import QUERIES
from martlens.functions.calendar import HOLIDAYS
from martlens.operators import calendar_model as model
from martlens.operators.series import Z_SCORES, forecast_backtest

START = dt.date(2024, 3, 1)


def days(n, seed, holiday=0.0):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        d = START + dt.timedelta(days=k)
        y = 50 + 0.05 * k + 8 * (d.isoweekday() == 6) + 12 * math.sin(2 * math.pi * d.timetuple().tm_yday / 365.25) + holiday * (d.isoformat() in HOLIDAYS)
        out.append((d, float(y + rng.normal(0, 1))))
    return out


def matrix(dates, weekend=False, season=True):
    rows = []
    for d in dates:
        a, dow = 2 * math.pi * d.timetuple().tm_yday / 365.25, d.isoweekday() % 7
        rows.append([1.0, (d - dt.date(2000, 1, 1)).days / 365.25, *[float(dow == k) for k in range(1, 7)], *([float(dow in (0, 6))] if weekend else []),
                     float(d.isoformat() in HOLIDAYS), *([f(a * h) for h in (1, 2) for f in (math.sin, math.cos)] if season else [])])
    return np.array(rows)


@pytest.fixture(scope="module")
def daily(spark):
    rows = [("long", d, y) for d, y in days(800, 1, 30.0)] + [("short", d, y) for d, y in days(60, 2)]
    return spark.createDataFrame(rows, "series string, ds date, y double").repartition(5)


def test_forecast_equals_a_ridge_solve(spark, daily):
    got = {(r.series, r.ts.date()): r for r in model.forecast_calendar(daily, "m", periods=40).collect()}
    assert len(got) == 80
    for name, n, seed, bump in (("long", 800, 1, 30.0), ("short", 60, 2, 0.0)):
        rows, season = days(n, seed, bump), name == "long"
        x, y = matrix([d for d, _ in rows], season=season), np.array([v for _, v in rows])
        ridge = np.diag([1e-9, 1e-9, *[model.RIDGE] * (x.shape[1] - 2)])
        b = np.linalg.solve(x.T @ x + ridge, x.T @ y)
        sigma = math.sqrt(((y - x @ b) ** 2).sum() / (n - x.shape[1]))
        for k in range(40):
            d = START + dt.timedelta(days=n + k)
            want = float((matrix([d], season=season) @ b)[0])
            r = got[name, d]
            assert abs(r.forecast - want) < 0.006 and abs(r.upper_bound - want - Z_SCORES[0.95] * sigma) < 0.006


def test_losses_equal_refits_without_each_feature(spark, daily):
    got = {r.feature_name: r.score for r in model.feature_loss(daily).collect()}
    xs, ys, total = [], [], 0.0
    for n, seed, bump in ((800, 1, 30.0), (60, 2, 0.0)):
        rows = days(n, seed, bump)
        x, y = matrix([d for d, _ in rows], weekend=True)[:, 1:], np.array([v for _, v in rows])
        xs.append(x - x.mean(axis=0))
        ys.append(y - y.mean())
    x, y = np.vstack(xs), np.concatenate(ys)
    names = ["trend", *["day_of_week"] * 6, "is_weekend", "is_holiday", *["season"] * 4]

    def left(columns):
        b = np.linalg.lstsq(x[:, columns], y, rcond=None)[0]
        return ((y - x[:, columns] @ b) ** 2).sum()

    total, whole = (y * y).sum(), left(list(range(len(names))))
    for feature in dict.fromkeys(names):
        want = (left([k for k, n in enumerate(names) if n != feature]) - whole) / total
        assert abs(got[feature] - want) < 2e-5, feature
    assert got["is_weekend"] < 1e-4 < got["day_of_week"] and got["is_holiday"] > 0.01


def test_hold_out_error_is_not_above_the_trend_and_weekday_model(spark, daily):
    cutoff = "2026-03-01"
    ours = {r.series: r.mae for r in model.calendar_backtest(daily, cutoff).collect()}
    theirs = {r.series: r.mae for r in forecast_backtest(daily, cutoff).collect()}
    assert ours.keys() == theirs.keys() == {"long"} and ours["long"] < 0.5 * theirs["long"]


def test_registered_back_test_is_not_worse(spark, sf_dir):
    means = [QUERIES[n](spark, "/root/testdata/sf0.01").agg(F.sum(F.col("mae") * F.col("n_days")) / F.sum("n_days")).first()[0]
             for n in ("forecast_calendar_backtest", "forecast_backtest")]
    assert means[0] <= means[1] * 1.001


def test_empty_and_single_day_series(spark):
    one = spark.createDataFrame([("a", START, 5.0), ("b", START, None)], "series string, ds date, y double")
    rows = model.forecast_calendar(one.where("series = 'a'"), "m", periods=3).collect()
    assert len(rows) == 3 and all(math.isfinite(r.forecast) for r in rows)
    assert model.forecast_calendar(one.where("false"), "m").count() == 0
    assert model.feature_loss(one.where("false")).count() == 0
