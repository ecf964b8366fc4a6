"""Properties that hold for every row of the test tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martlens.catalog.queries import QUERIES, WINDOW_DAYS, tables
from martlens.operators import attribution as attr


@pytest.mark.parametrize("scope", ["global", "customer"])
def test_credit_adds_up(spark, sf_dir, scope):
    t = tables(spark, sf_dir)
    rows = attr.credits(attr.conversions_with_touches(t["orders"], t["spend"], t["campaigns"], WINDOW_DAYS, scope))
    sums = rows.groupBy("conversion_id", "model_name", "revenue", "total_touchpoints").agg(
        F.sum("attributed_revenue").alias("c"), F.sum("attribution_weight").alias("w"))
    off = sums.where(
        (F.abs(F.col("w") - 1) > 1e-3) | (F.abs(F.col("c") - F.col("revenue")) > 0.005 * F.col("total_touchpoints") + 1e-9))
    assert sums.count() > 0 and off.count() == 0


@pytest.mark.parametrize("scope", ["global", "customer"])
def test_rewritten_band_join_equals_plain_one(spark, sf_dir, scope):
    t = tables(spark, sf_dir)
    fast = attr.mta_touchpoints(t["orders"], t["spend"], t["campaigns"], WINDOW_DAYS, scope)
    o, s = t["orders"].alias("o"), t["spend"].where("conversions > 0").alias("s")
    near = F.expr(f"s.spend_date BETWEEN o.order_date - INTERVAL {WINDOW_DAYS} DAYS AND o.order_date")
    if scope == "customer":
        near = near & F.expr("s.customer_id = o.customer_id")
    plain = o.join(s, near).groupBy("o.order_id", "s.sub_channel").agg(
        F.min("s.spend_date").alias("first_touch_date"), F.max("s.spend_date").alias("last_touch_date"))
    cols = ["first_touch_date", "last_touch_date", "sub_channel"]
    mine = fast.select(F.col("conversion_id").alias("order_id"), *cols)
    theirs = plain.select("order_id", *cols)
    assert mine.exceptAll(theirs).count() == 0 and theirs.exceptAll(mine).count() == 0


def test_mix_model_week_totals(spark, sf_dir):
    t = tables(spark, sf_dir)
    weeks = t["mmm_weekly"].groupBy("week_start").agg(F.sum("attributed_revenue").alias("a"), F.count("*").alias("n"))
    true = t["daily_revenue"].groupBy(F.trunc("order_date", "week").alias("week_start")).agg(F.sum("total_revenue").alias("r"))
    rows = weeks.join(true, "week_start").collect()
    assert rows and all(abs(r.a - r.r) <= 0.005 * r.n + 1e-6 for r in rows)
    for period, total, n in t["mmm_contributions"].groupBy("period").agg(F.sum("share_of_spend"), F.count("*")).collect():
        assert abs(total - 100) <= 0.1 * n


def test_scores_and_tiers(spark, sf_dir):
    t = tables(spark, sf_dir, "star")
    bad = t["clv_risk"].where("churn_risk_score NOT BETWEEN 0 AND 1 OR clv_tier IS NULL")
    assert bad.count() == 0
    one = QUERIES["customer_enriched_per_zip"](spark, sf_dir)
    assert one.count() == one.select("customer_id").distinct().count() == t["customers"].count()


def test_forecast_bounds_are_ordered(spark, sf_dir):
    rows = QUERIES["forecast_product_channel"](spark, sf_dir)
    assert rows.where("NOT (lower_bound <= forecast AND forecast <= upper_bound)").count() == 0
    flagged = QUERIES["anomaly_order_counts"](spark, sf_dir)
    assert flagged.where("is_anomaly != (y < lower_bound OR y > upper_bound) OR percentile NOT BETWEEN 0 AND 1").count() == 0
