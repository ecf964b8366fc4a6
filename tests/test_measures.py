"""Sums of small measures, wide products, repeated series days and empty days."""

from __future__ import annotations

import datetime as dt

import pytest

from martlens.functions.money import avg_measure, sum_measure
from martlens.operators import enrich, geo, series
from martlens.plans.models import ADVANCED, MARKETING
from frames import customer, enrichment, frame, order


def _weather(spark, rows):
    return spark.createDataFrame(
        rows, "weather_date date, zip_code string, avg_temp_f double, precipitation_in double, snowfall_in double")


def test_small_readings_are_not_rounded_away(spark):
    day = dt.date(2026, 1, 5)
    signal = enrich.national_daily_signal(_weather(spark, [(day, "1", 20.004, 0.004, 0.0)] * 10)).first()
    assert (signal.national_precipitation_in, signal.national_avg_temp_f) == (0.04, 20.0)
    weights = spark.range(1000).selectExpr("0.0031D as w")
    assert weights.agg(sum_measure("w").alias("s"), avg_measure("w", 4).alias("a")).first() == (3.1, 0.0031)


def test_hot_zip_does_not_overflow(spark):
    customers = frame(spark, "customers", [customer(1, value=9e9)])
    records = enrichment(spark, [("10001", "low", "A", "X")] * 3).unionByName(
        enrichment(spark, [("10001", "low", "A", "X")]).selectExpr("*", "explode(sequence(1, 200000)) as n").drop("n"))
    orders = frame(spark, "orders", [order(i, "2026-01-01", revenue=9e11) for i in range(50)])
    weather = _weather(spark, [(dt.date(2026, 1, d), "10001", 10.0, 0.5, 0.0) for d in range(1, 32)])
    row = geo.geo_targeting(customers, records, orders, weather, dt.date(2026, 1, 31)).first()
    assert row.total_revenue == pytest.approx(50 * 9e11 * 200003 * 31, rel=1e-12)


def test_repeated_series_day_is_added_up(spark):
    d = dt.date
    rows = spark.createDataFrame(
        [("s", d(2026, 1, 1), 1.0), ("s", d(2026, 1, 3), 2.0), ("s", d(2026, 1, 3), 5.0)], "series string, ds date, y double")
    assert sorted(map(tuple, series.densify(rows).collect())) == [
        ("s", d(2026, 1, 1), 1.0), ("s", d(2026, 1, 2), 0.0), ("s", d(2026, 1, 3), 7.0)]


def test_day_without_rows_is_judged(spark):
    start = dt.date(2026, 1, 1)
    rows = [("s", start + dt.timedelta(days=i), 100.0 + i % 3) for i in range(60) if i != 50]
    daily = spark.createDataFrame(rows, "series string, ds date, y double")
    got = {r.ts.date(): r for r in series.detect_anomalies(daily, "m", "2026-02-10").collect()}
    assert len(got) == 20 and got[start + dt.timedelta(days=50)].y == 0.0 and got[start + dt.timedelta(days=50)].is_anomaly
    without = series.detect_anomalies(daily, "m", "2026-02-10", fill_gaps=False)
    assert without.count() == 19
    assert "NestedLoop" not in without._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("condition", ["channel = 'nowhere'", "orders.nothing > 1", "nobody.channel = 'x'"])
def test_conditions_on_other_names_are_refused(spark, condition):
    empty = {e: spark.createDataFrame([], "campaign_id int, channel string, order_id int, revenue double") for e in MARKETING.entities}
    with pytest.raises(ValueError):
        MARKETING.query(empty, dimensions=["orders.channel"], metrics=["orders.total_orders"], where=condition)


def test_mean_is_exact_in_any_order(spark):
    values = [0.1] * 10 + [1e6, 0.3, -1e6]
    rows = spark.createDataFrame([(1, v) for v in values], "k int, targeting_score double")
    got = {
        ADVANCED.query({"geo_profiles": rows.repartition(n)}, metrics=["geo_profiles.avg_targeting_score"]).first()[0]
        for n in (1, 3, 7)
    }
    assert got == {1.3 / 13}
