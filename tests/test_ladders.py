"""Boundary rows of the first-match rules, with written-out results."""

from __future__ import annotations

import pytest

from martlens.functions.ladders import first_match
from martlens.operators import clv, enrich, geo


def _outcomes(spark, rules, default, columns, rows, missing=None):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{c} double" for c in columns))
    args = (rules, default) if missing is None else (rules, default, missing)
    return [r.out for r in frame.select("i", first_match(*args).alias("out")).orderBy("i").collect()]


def test_temperature_bands(spark):
    rows = [(31.9,), (32.0,), (49.9,), (50.0,), (69.9,), (70.0,), (84.9,), (85.0,), (None,)]
    assert _outcomes(spark, enrich.TEMPERATURE_BANDS, enrich.HOTTEST, ["national_avg_temp_f"], rows) == [
        "freezing", "cold", "cold", "mild", "mild", "warm", "warm", "hot", "hot"]


def test_value_tiers(spark):
    rows = [(2000.0,), (1999.99,), (500.0,), (499.99,), (None,)]
    assert _outcomes(spark, enrich.VALUE_TIERS, enrich.LOWEST_TIER, ["lifetime_value"], rows) == [
        "high_value", "mid_value", "mid_value", "low_value", "low_value"]


def test_age_groups():
    assert enrich.AGE_GROUPS == ((18, 24), (25, 34), (35, 44), (45, 54)) and enrich.OTHER_AGES == "55+"


def test_weather_actions(spark):
    columns = ["recent_total_snowfall", "recent_total_precip", "recent_avg_temp"]
    rows = [
        (10.1, 9.0, 95.0), (10.0, 9.0, 95.0), (5.0, 5.1, 95.0), (5.0, 5.0, 95.0), (5.0, 2.0, 95.0), (0.0, 2.0, 90.0),
        (0.0, 0.0, 80.0), (0.0, 0.0, 35.0), (0.0, 0.0, 34.9), (0.0, 0.0, 20.0), (0.0, 0.0, 19.9), (None, None, None),
    ]
    first_words = [o.split(" —")[0] for o in _outcomes(spark, geo.TRIGGERS, geo.NO_TRIGGER, columns, rows, geo.MISSING)]
    assert first_words == [
        "BLIZZARD ALERT", "SNOW ADVISORY", "HEAVY RAIN", "RAIN ALERT", "HEAT WAVE", "HOT WEATHER",
        "NO TRIGGER", "NO TRIGGER", "COLD SNAP", "COLD SNAP", "EXTREME COLD", "NO TRIGGER"]


def test_recommended_category_and_channel(spark):
    columns = ["recent_total_snowfall", "recent_avg_temp", "recent_total_precip"]
    rows = [(5.1, 80.0, 9.0), (5.0, 75.1, 9.0), (5.0, 75.0, 3.1), (0.0, 39.9, 9.0), (0.0, 40.0, 3.0), (None, None, None)]
    assert _outcomes(spark, geo.WEATHER_CATEGORIES, geo.OTHER_CATEGORY, columns, rows, geo.MISSING) == [
        "winter_sports", "camping", "footwear", "outerwear", "accessories", "accessories"]
    rows = [(10.0, 9999.0), (9.0, 1500.1), (9.0, 1500.0), (0.0, None)]
    assert _outcomes(spark, geo.CHANNELS, geo.OTHER_CHANNEL, ["customer_count", "avg_ltv"], rows, geo.MISSING) == [
        "social", "email", "search", "search"]


@pytest.mark.parametrize("value, orders, days, rate, tier, score", [
    (1500.0, 9, 60, 2.0, "Loyal High-Value", 0.099),
    (1499.0, 9, 60, 2.0, "Growth Potential", 0.099),
    (1500.0, 9, 61, 2.0, "Growth Potential", 0.1),
    (499.0, 3, 120, 2.0, "Growth Potential", 0.197),
    (499.0, 2, 120, 2.0, "New Customer", 0.197),
    (499.0, 2, 121, 2.0, "At-Risk", 0.199),
    (499.0, 9, 300, 2.0, "At-Risk", 0.493),
    (499.0, 9, 301, 2.0, "Lapsed", 0.495),
    (499.0, 9, 280, 0.0, "Lapsed", 0.86),
    (499.0, None, None, None, "Lapsed", 1.0),
])
def test_customer_tiers(spark, value, orders, days, rate, tier, score):
    row = spark.createDataFrame(
        [(1, value, orders, 0.0, days, rate, "s", "a", "v", "l", "o")],
        "customer_id long, lifetime_value double, total_orders long, total_revenue double, days_since_last_order int, "
        "orders_per_month double, state string, age_group string, value_tier string, lifestyle_segment string, outdoor_interest string")
    got = clv.clv_tiers(row).first()
    assert (got.clv_tier, got.churn_risk_score) == (tier, score)
