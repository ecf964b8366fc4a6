"""Forecast and anomaly behaviour on constructed series."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martlens.operators import series

START = dt.date(2025, 1, 1)


def _daily(spark, values, name="s"):
    return spark.createDataFrame(
        [(name, START + dt.timedelta(days=i), float(v)) for i, v in enumerate(values) if v is not None],
        "series string, ds date, y double")


def test_gap_is_filled_with_zero(spark):
    rows = series.densify(_daily(spark, [1, None, None, 4])).orderBy("ds").collect()
    assert [r.y for r in rows] == [1.0, 0.0, 0.0, 4.0]


def test_constant_series_has_no_spread(spark):
    rows = series.forecast(_daily(spark, [7] * 40), "m", periods=10).collect()
    assert len(rows) == 10
    assert all(r.forecast == r.lower_bound == r.upper_bound == 7.0 for r in rows)


def test_trend_and_weekday_are_continued(spark):
    rows = series.forecast(_daily(spark, [10 + 2 * i for i in range(70)]), "m", periods=7).orderBy("ts").collect()
    assert [r.forecast for r in rows] == [10.0 + 2 * i for i in range(70, 77)]


def test_single_day_series(spark):
    rows = series.forecast(_daily(spark, [5]), "m", periods=2).collect()
    assert [r.forecast for r in rows] == [5.0, 5.0]


@pytest.mark.parametrize("factor", [3.0, 0.2, 5.0])
def test_planted_week_is_flagged(spark, factor):
    def value(i):
        noise = ((i * 7919) % 101) / 101 - 0.5
        base = 1000 + 60 * noise + (80 if (START + dt.timedelta(days=i)).weekday() >= 5 else 0)
        return base * (factor if 260 <= i < 267 else 1)

    rows = series.detect_anomalies(_daily(spark, [value(i) for i in range(330)]), "m", START + dt.timedelta(days=240))
    flagged = {r.ts.date() for r in rows.where("is_anomaly").collect()}
    planted = {START + dt.timedelta(days=i) for i in range(260, 267)}
    assert planted <= flagged and len(flagged - planted) <= 5
    side = rows.where(F.to_date("ts").isin(list(planted))).select("percentile").collect()
    assert all((r.percentile > 0.99) if factor > 1 else (r.percentile < 0.01) for r in side)


def test_split_has_no_overlap(spark):
    rows = _daily(spark, range(10))
    train, held = series.train_holdout_split(rows, START + dt.timedelta(days=6))
    assert (train.count(), held.count()) == (6, 4)


def test_many_series_have_own_parameters(spark):
    both = _daily(spark, [1] * 30, "a").unionByName(_daily(spark, [100 - i for i in range(30)], "b"))
    params = {r.series: r for r in series.fit(both).collect()}
    assert abs(params["a"].slope) < 1e-9 and abs(params["b"].slope + 1) < 1e-9


def test_pandas_model_is_pluggable(spark):
    import pandas as pd

    def last_value(history, periods):
        history = history.sort_values("ds")
        last = history["y"].iloc[-1]
        ahead = pd.date_range(pd.to_datetime(history["ds"]).max() + pd.Timedelta(days=1), periods=periods)
        return pd.DataFrame({"series": history["series"].iloc[0], "ts": ahead, "forecast": last, "lower_bound": last, "upper_bound": last})

    rows = series.forecast_pandas(_daily(spark, [1, 2, 3]), "last", last_value, 4).collect()
    assert [r.forecast for r in rows] == [3.0] * 4 and rows[0].model_name == "last"


def test_rolling_score_needs_a_full_window(spark):
    rows = series.rolling_zscore(_daily(spark, [1, 2, 1, 2, 50]), 4, 3.0).orderBy("ds").collect()
    assert [r.zscore is None for r in rows] == [True] * 4 + [False] and rows[-1].is_outlier


def test_pandas_model_reaches_workers_without_the_package(tmp_path):
    import os
    import subprocess
    import sys

    from pyspark import cloudpickle

    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = "import pickle, sys; print(pickle.loads(sys.stdin.buffer.read()).__name__)"
    done = subprocess.run(
        [sys.executable, "-c", code], input=cloudpickle.dumps(series.naive_seasonal), cwd=tmp_path, env=env, capture_output=True)
    assert done.returncode == 0, done.stderr.decode()[-500:]
