"""Edge cases of the operators on hand-made rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from frames import campaign, cost, customer, d, enrichment, frame, order, weather
from martlens.functions import calendar as cal
from martlens.functions.money import avg_usd, sum_usd
from martlens.operators import attribution as attr
from martlens.operators import clv, enrich, geo, kpi, mmm, reviews, spine
from martlens.sources.schemas import BASE_TABLES, empty


def test_calendar(spark):
    row = spark.sql("SELECT date'2026-03-01' a, date'2026-01-31' b, date'2026-02-01' c").select(
        cal.dow0("a").alias("dow"), cal.is_weekend("a").alias("we"), cal.week_start("a").alias("ws"),
        cal.month_boundaries("b", "c").alias("m"), cal.quarter_label("a").alias("q"),
        cal.is_holiday(F.lit(d("2024-12-25"))).alias("h"),
    ).first()
    assert (row.dow, row.we, row.ws, row.m, row.q, row.h) == (0, 1, d("2026-02-23"), 1, "Q1_2026", 1)


def test_date_spine_is_cut(spark):
    rows = cal.date_spine(spark, "2024-07-01", 640, "2026-03-31").agg(F.count("d"), F.max("d")).first()
    assert tuple(rows) == (639, d("2026-03-31"))


def test_money_sums_are_exact(spark):
    rows = spark.createDataFrame([(0.1,)] * 30 + [(1.005,)], "v double").agg(sum_usd("v").alias("s"), avg_usd("v").alias("a")).first()
    assert rows.s == 4.0  # 30 x 10 cents and one whole dollar after reading 1.005 as 100 cents
    assert rows.a == 0.13


def test_campaign_without_spend_and_without_orders(spark):
    campaigns = frame(spark, "campaigns", [campaign(1), campaign(2), campaign(3)])
    spend = frame(spark, "marketing_spend", [cost(1, 2, "2026-01-01", amount=20.0, conversions=0)])
    orders = frame(spark, "orders", [order(1, "2026-01-02", campaign=1, revenue=50.0)])
    rows = {r.campaign_id: r for r in kpi.campaign_metrics(campaigns, spend, orders).collect()}
    assert (rows[1].total_spend, rows[1].cpa, rows[1].roas, rows[1].ctr_pct) == (0.0, None, None, None)
    assert (rows[2].roas, rows[2].cpa, rows[2].ctr_pct) == (0.0, None, 10.0)
    assert rows[3].campaign_revenue == 0.0
    left = kpi.campaigns_without_orders(campaigns, orders).collect()
    assert sorted(r.campaign_id for r in left) == [2, 3]


def test_zero_clicks_rate_is_zero(spark):
    spend = frame(spark, "marketing_spend", [cost(1, 1, "2026-01-01", clicks=0, conversions=0)])
    assert kpi.spend_daily(spend).first().conversion_rate_pct == 0.0


def test_partner_without_orders_is_kept(spark):
    partners = spark.createDataFrame([(1, "a", "west", "gold", 0.5, 0), (2, "b", "west", "gold", 0.5, 100)],
                                     BASE_TABLES["wholesale_partners"])
    orders = frame(spark, "orders", [order(1, "2026-01-01", partner=1), order(2, "2026-01-01")])
    rows = {r.partner_id: r for r in kpi.partner_performance(partners, orders).collect()}
    assert (rows[1].total_orders, rows[1].revenue_attainment_pct) == (1, None)
    assert (rows[2].total_orders, rows[2].total_units_sold, rows[2].total_revenue) == (0, None, None)


def _touch_rows(spark, touches, orders, window=30):
    """touches: (campaign, sub_channel, day)."""
    campaigns = frame(spark, "campaigns", [campaign(i, sub) for i, sub in {(c, s) for c, s, _ in touches}])
    spend = frame(spark, "marketing_spend", [cost(n, c, day) for n, (c, _, day) in enumerate(touches)])
    return attr.conversions_with_touches(frame(spark, "orders", orders), spend, campaigns, window)


def test_window_edges_and_tie_order(spark):
    conv = _touch_rows(
        spark,
        [(1, "social", "2026-01-01"), (2, "email", "2026-01-01"), (3, "search", "2026-01-31"), (4, "co_op_ad", "2025-12-31")],
        [order(7, "2026-01-31", revenue=10.0)],
    )
    rows = conv.select(F.inline("touches")).orderBy("touchpoint_sequence").collect()
    # thirty days before and the same day are both inside, thirty-one days are not; ties go by name
    assert [(r.sub_channel, r.days_to_conversion) for r in rows] == [("email", 30), ("social", 30), ("search", 0)]
    assert {r.total_touchpoints for r in rows} == {3}
    journey = attr.mta_journeys(conv).first()
    assert journey.channel_path == "email > search > social" and journey.journey_duration_days == 30
    assert attr.mta_journeys(conv, "sequence").first().channel_path == "email > social > search"


@pytest.mark.parametrize("n, weights", [(1, [1.0]), (2, [0.5, 0.5]), (3, [0.4, 0.2, 0.4])])
def test_position_weights(spark, n, weights):
    names = ["email", "search", "social"]
    conv = _touch_rows(spark, [(i, names[i], f"2026-01-0{i + 1}") for i in range(n)], [order(1, "2026-01-09", revenue=99.99)])
    rows = attr.attribution(conv, "position_based").orderBy("touchpoint_sequence").collect()
    assert [r.attribution_weight for r in rows] == weights


def test_order_without_touches_is_absent(spark):
    conv = _touch_rows(spark, [(1, "email", "2026-01-01")], [order(1, "2025-12-31"), order(2, "2026-01-01")])
    assert [r.order_id for r in conv.collect()] == [2]


def test_summary_counts_a_repeated_order_id_once(spark):
    orders = [order(7, "2026-01-03", 5.0), order(7, "2026-01-03", 6.0), order(2, "2026-01-03", 1.0)]
    conv = _touch_rows(spark, [(1, "email", "2026-01-01"), (2, "social", "2026-01-02")], orders)
    rows = {(r.sub_channel, r.model_name): r for r in attr.attr_summary(conv).collect()}
    assert len(rows) == 2 * 3 + 2 and all(r.conversions_attributed == 2 for r in rows.values())
    assert rows["email", "first_touch"].total_attributed_revenue == 12.0


def test_consensus_cuts_tied_rank(spark):
    summary = spark.createDataFrame(
        [("a", "m", 5.0), ("b", "m", 5.0), ("c", "m", 1.0)], "sub_channel string, model_name string, total_attributed_revenue double")
    ranks = {r.sub_channel: r.avg_rank for r in attr.attr_consensus(summary).collect()}
    assert ranks == {"a": 1.0, "b": 1.0, "c": 3.0}


def test_customer_without_orders_is_lapsed(spark):
    customers = frame(spark, "customers", [customer(1, value=9000.0), customer(2)])
    orders = frame(spark, "orders", [order(1, "2026-01-01", customer=2), order(2, "2026-02-01", customer=2, category="footwear")])
    rows = enrich.customer_enriched(customers, enrichment(spark, []), orders, d("2026-02-10"))
    tiers = {r.customer_id: r for r in clv.clv_tiers(rows).collect()}
    assert (tiers[1].clv_tier, tiers[1].churn_risk_score, tiers[1].total_orders) == ("Lapsed", 1.0, None)
    assert tiers[2].clv_tier == "New Customer"
    two = rows.where("customer_id = 2").first()
    assert (two.distinct_categories, two.orders_per_month, two.days_since_last_order) == (2, 2.0, 9)


def test_several_records_per_zip(spark):
    customers = frame(spark, "customers", [customer(1), customer(2, zip_code="99999")])
    records = enrichment(spark, [("10001", "low", "A", "X"), ("10001", "low", "A", "X"), ("10001", "high", "B", "X")])
    orders = frame(spark, "orders", [order(1, "2026-01-01", revenue=10.0)])
    every = enrich.customer_enriched(customers, records, orders, d("2026-02-01"), "all")
    assert every.groupBy("customer_id").count().orderBy("customer_id").collect() == [(1, 3), (2, 1)]
    one = enrich.customer_enriched(customers, records, orders, d("2026-02-01"), "one")
    assert one.count() == 2 and one.where("customer_id = 1").first().income_bracket == "low"
    weighted = enrich.customer_enriched(customers, records, orders, d("2026-02-01"), "weighted")
    assert weighted.count() == 3 and weighted.agg(F.sum("profile_rows")).first()[0] == 4
    plain, short = clv.clv_tiers(every), clv.clv_tiers(weighted)
    assert sorted(clv.clv_summary(plain).collect()) == sorted(clv.clv_summary(short).collect())
    key = ["lifestyle_segment", "clv_tier"]
    assert clv.segment_tier_mix(plain).orderBy(*key).collect() == clv.segment_tier_mix(short).orderBy(*key).collect()


def test_geo_modes(spark):
    customers = frame(spark, "customers", [customer(1, value=100.0), customer(2, value=200.0), customer(3, zip_code="20002")])
    records = enrichment(spark, [("10001", "low", "A", "X"), ("10001", "high", "B", "X")])
    orders = frame(spark, "orders", [order(i, "2026-01-01", customer=1, revenue=10.0) for i in range(3)])
    sky = weather(spark, [("2026-01-30", "10001", 40.0, 0.5, 1.0), ("2026-01-31", "10001", 50.0, 0.5, 0.0),
                          ("2025-12-01", "10001", 99.0, 9.0, 9.0)])
    joined = {r.zip_code: r for r in geo.geo_targeting(customers, records, orders, sky, d("2026-01-31")).collect()}
    first = joined["10001"]
    # 2 records x 2 weather days repeat the revenue, 3 + 1 order rows weigh the value
    assert (first.customer_count, first.total_revenue, first.avg_ltv) == (2, 120.0, 125.0)
    assert (first.recent_avg_temp, first.recent_total_precip, first.recent_total_snowfall) == (45.0, 8.0, 8.0)
    assert first.dominant_income_bracket == "high"  # tie goes to the lowest value
    assert (joined["20002"].total_revenue, joined["20002"].recent_avg_temp) == (0.0, None)
    once = {r.zip_code: r for r in geo.geo_targeting(
        customers, records, orders, sky, d("2026-01-31"), "preaggregated").collect()}["10001"]
    assert (once.total_revenue, once.avg_ltv, once.recent_total_precip) == (30.0, 150.0, 1.0)


def test_zero_maximum_revenue_gives_null_score(spark):
    customers = frame(spark, "customers", [customer(1)])
    rows = geo.geo_targeting(customers, enrichment(spark, []), empty(spark, "orders"), weather(spark, []), d("2026-01-31"))
    assert geo.geo_profiles(rows).first().targeting_score is None
    assert geo.geo_triggers(rows).first().trigger_action == "NO TRIGGER"


def test_missing_weather_day_is_hot(spark):
    orders = frame(spark, "orders", [order(1, "2026-01-01")])
    national = enrich.national_daily_signal(weather(spark, [("2026-02-01", "1", 10.0, 1.0, 0.0)]))
    row = enrich.weather_revenue(kpi.daily_revenue(orders), national).first()
    assert (row.temp_band, row.rainy_day, row.snow_day, row.national_avg_temp_f) == ("hot", False, False, None)


def test_mix_model_spends_the_week_revenue(spark):
    spend = frame(spark, "marketing_spend", [
        cost(1, 1, "2026-01-05", amount=30.0, sub_channel="email"), cost(2, 2, "2026-01-06", amount=0.0, sub_channel="social"),
        cost(3, 3, "2026-01-07", amount=70.0, conversions=4, sub_channel="search")])
    orders = frame(spark, "orders", [order(1, "2026-01-08", revenue=1000.0)])
    weekly = mmm.mmm_weekly(mmm.mmm_weighted(kpi.spend_daily(spend), kpi.daily_revenue(orders)))
    rows = {r.sub_channel: r for r in weekly.collect()}
    assert rows["social"].attributed_revenue == 0.0 and rows["social"].efficiency_index is None
    assert abs(sum(r.attributed_revenue for r in rows.values()) - 1000.0) <= 0.015
    assert rows["email"].attributed_revenue == round(1000 * 31 / 105, 2)


def test_unknown_channel_is_below_target(spark):
    rows = spark.createDataFrame([("podcast", "Q1_2026", 3.0)], "sub_channel string, period string, roi double")
    assert mmm.roas_vs_target(rows).first().status == "Below Target"


def test_segments_first_match_wins(spark):
    from martlens.sources.testdata import LIFESTYLE_FLAGS

    def person(zip_code, *single):
        return (zip_code, "x", *["Single" if f in single else None for f in LIFESTYLE_FLAGS])

    schema = "zip string, estimated_household_income string, " + ", ".join(f"{f} string" for f in LIFESTYLE_FLAGS)
    rows = enrich.segment_ladder(spark.createDataFrame([
        person(" 10001-1234", "travel_domestic", "outdoor"), person("10002", "outdoor"), person("10003", "fishing", "snow_skiing"),
        person("10004")], schema)).orderBy("zip_code").collect()
    assert [tuple(r)[0::2] for r in rows] == [
        ("10001", "Travel Enthusiast"), ("10002", "Outdoor Adventurer"), ("10003", "General Consumer"), ("10004", "General Consumer")]
    assert [r.outdoor_interest for r in rows] == ["General Outdoor", "General Outdoor", "Hunting/Fishing", "None Identified"]


def test_campaign_days_and_spine(spark):
    days = spine.campaign_days(frame(spark, "campaigns", [campaign(1, budget=100.0, start="2026-01-30", end="2026-02-01")]))
    rows = days.orderBy("spend_date").collect()
    assert [str(r.spend_date) for r in rows] == ["2026-01-30", "2026-01-31", "2026-02-01"]
    assert rows[0].daily_budget == 33.33


def test_surrogate_key_with_one_hot_value(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 50).alias("k"))
    out = spine.surrogate_key(rows, ["k", "id"], partitions=7)
    ordered = [tuple(r) for r in out.orderBy("row_id").select("row_id", "k", "id").collect()]
    assert [r[0] for r in ordered] == list(range(1, 5001))
    assert [r[1:] for r in ordered] == sorted(r[1:] for r in ordered)


def test_stable_sample_repeats(spark):
    rows = spark.range(1000)
    a = spine.stable_sample(rows, "id", 50, 7).collect()
    assert a == spine.stable_sample(rows.repartition(5), "id", 50, 7).collect() and len(set(a)) == 50
    assert a != spine.stable_sample(rows, "id", 50, 8).collect()


def _review(spark, *texts):
    return frame(spark, "product_reviews", [
        {"review_id": i, "channel": "dtc_website", "product_category": "tents", "product_name": "t", "rating": 3, "review_text": t}
        for i, t in enumerate(texts)])


def test_sentiment_range_and_whole_text(spark):
    late = "filler " * 5000 + "terrible"
    rows = reviews.review_sentiment(_review(spark, "Great tent, I LOVE it!", "", None, "Great but broke", late)).orderBy("review_id")
    assert [r.sentiment_score for r in rows.collect()] == [1.0, 0.0, 0.0, 0.0, -1.0]


def test_extract(spark):
    row = reviews.review_extract(_review(spark, "Nice. The zipper broke! I found a rival model. I regret it.")).first()
    assert row.product_feedback == "The zipper broke" and row.feedback_score == 0.25
    assert row.competitor_mention == "rival" and row.recommendation == "no"


def test_term_counts(spark):
    rows = reviews.term_counts(_review(spark, "tent tent pole", "Tent!"), "channel")
    assert sorted((r.term, r.tf, r.df) for r in rows.collect()) == [("pole", 1, 1), ("tent", 3, 2)]


def test_tier_of_a_single_campaign(spark):
    campaigns = frame(spark, "campaigns", [campaign(1), campaign(2)])
    spend = frame(spark, "marketing_spend", [cost(1, 1, "2026-01-01")])
    metrics = kpi.campaign_metrics(campaigns, spend, empty(spark, "orders"))
    assert {r.campaign_id: r.performance_tier for r in reviews.campaign_tiers(metrics).collect()} == {
        1: "Top Performer", 2: "Needs Review"}


def test_empty_input_keeps_schema(spark):
    orders, campaigns, spend = (empty(spark, t) for t in ("orders", "campaigns", "marketing_spend"))
    conv = attr.conversions_with_touches(orders, spend, campaigns)
    frames = [
        kpi.daily_revenue(orders), kpi.product_revenue(orders), kpi.forecast_input(orders), kpi.spend_daily(spend),
        kpi.campaign_metrics(campaigns, spend, orders), attr.credits(conv), attr.attr_summary(conv),
        mmm.mmm_weekly(mmm.mmm_weighted(kpi.spend_daily(spend), kpi.daily_revenue(orders))), spine.campaign_days(campaigns),
        reviews.review_sentiment(empty(spark, "product_reviews")), reviews.channel_themes(empty(spark, "product_reviews")),
        enrich.customer_enriched(empty(spark, "customers"), enrichment(spark, []), orders, d("2026-01-01")),
    ]
    for rows in frames:
        assert rows.columns and rows.count() == 0
