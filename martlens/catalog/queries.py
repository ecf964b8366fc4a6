"""Registered queries: every operator over the given test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.functions import calendar as cal
from martlens.functions.money import cents, div0, ratio, sum_usd
from martlens.operators import (
    asof, attribution, calendar_model, clv, enrich, geo, kpi, mmm, opinions, phrases, reviews, robust, series, spine,
)
from martlens.plans import questions
from martlens.plans.models import ADVANCED, MARKETING
from martlens.plans.semantic import LazyTables
from martlens.plans.tables import market_tables, metric_query
from martlens.plans.upkeep import refresh_stale
from martlens.sources import testdata as td
from martlens.sources.store import append_rows, new_table_path, write_snapshot
from martlens.streaming import deltas, events, refresh

Query = Callable[[SparkSession, str], DataFrame]

WINDOW_DAYS = 7
SINCE_WEATHER = "2024-01-10"
STAR_CUTOFF = "2000-07-01"
EVENT_CUTOFF = "2024-01-21"
EXCLUDE = ("co_op_ad",)
INDICATORS = {"1-URGENT": "cpi", "2-HIGH": "retail_sales_sporting", "3-MEDIUM": "consumer_confidence"}
REVIEW_WORDS = {
    "positive": td.TEST_POSITIVE, "negative": td.TEST_NEGATIVE, "feedback": td.TEST_FEEDBACK,
    "competitors": td.TEST_BRANDS, "recommend": td.TEST_RECOMMEND, "discourage": td.TEST_DISCOURAGE,
}
WHAT_IF_SEASONS = {1: 1.15, 2: 0.9, 7: 0.8}
WHAT_IF_EVENTS = (("wholesale", "2024-01-09", "2024-01-12", 1.5), ("DTC", "2024-01-20", "2024-01-22", 1.25))
WHAT_IF_PRICES = {"outerwear": 1.1, "camping": 0.95}


def _indicators(series_rows: DataFrame) -> DataFrame:
    return enrich.indicator_pivot(series_rows, INDICATORS, "country/USA", "2020-06-01")


def tables(spark: SparkSession, sf: str, flavour: str = "event", products: bool = True) -> LazyTables:
    """All tables over one test folder; orders come from events or from order lines."""
    orders = partial(td.orders_events, spark, sf) if flavour == "event" else partial(td.orders_star, spark, sf, products)
    base = {
        "orders": orders,
        "campaigns": partial(td.campaigns, spark, sf),
        "customers": partial(td.customers, spark, sf),
        "spend": partial(td.spend, spark, sf),
        "partners": partial(td.partners, spark, sf),
        "consumer_records": partial(td.consumer_records, spark, sf),
        "weather_history": partial(td.weather_history, spark, sf),
        "economic_series": partial(td.economic_series, spark, sf),
        "product_reviews": partial(td.reviews, spark, sf),
    }
    star = flavour == "star"
    return market_tables(
        base,
        as_of=td.STAR_AS_OF if star else td.EVENT_AS_OF,
        cutoff=STAR_CUTOFF if star else EVENT_CUTOFF,
        window_days=WINDOW_DAYS,
        weather_since=SINCE_WEATHER,
        indicators=_indicators,
        exclude=EXCLUDE,
        review_words=REVIEW_WORDS,
    )


def _table(name: str, flavour: str = "event", products: bool = True) -> Query:
    return lambda spark, sf: tables(spark, sf, flavour, products)[name]


def _of(fn: Callable[[LazyTables], DataFrame], flavour: str = "event", products: bool = True) -> Query:
    return lambda spark, sf: fn(tables(spark, sf, flavour, products))


def _metric(model: str, flavour: str = "event", rounded: dict[str, int] | None = None, **request) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        out = metric_query(tables(spark, sf, flavour), model, **request)
        for column, digits in (rounded or {}).items():
            out = out.withColumn(column, F.round(column, digits))
        return out

    return run


# --- scalar functions -------------------------------------------------------

def scalar_date_parts(spark: SparkSession, sf: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    end = cal.as_date("2001-09-01")
    return td.table(spark, sf, "orders").select(
        "o_orderkey", d.alias("d"), cal.dow0(d).alias("dow"), cal.is_weekend(d).alias("is_weekend"),
        cal.is_holiday(d, ("1999-07-05", "2000-12-25", "2001-01-01")).alias("is_holiday"),
        cal.week_start(d).alias("week_start"), cal.month_start(d).alias("month_start"),
        cal.quarter_label(d).alias("period"), cal.month_boundaries(d, end).alias("months_to_end"),
        F.datediff(end, d).alias("days_to_end"), F.date_sub(d, 30).alias("month_back"), F.year(d).alias("y"),
    )


def scalar_null_math(spark: SparkSession, sf: str) -> DataFrame:
    bal, key = F.col("c_acctbal"), F.col("c_custkey")
    bucket = F.pmod(key, F.lit(4))
    return td.table(spark, sf, "customer").select(
        "c_custkey",
        F.nullif(bucket, F.lit(0).cast("bigint")).alias("bucket_or_null"),
        F.coalesce(F.nullif(bucket, F.lit(0).cast("bigint")), F.lit(-1).cast("bigint")).alias("bucket_default"),
        ratio(key, bucket, 3).alias("safe_ratio"),
        F.round(div0(key, bucket), 3).alias("div0"),
        F.least(F.lit(5000.0), F.greatest(F.lit(0.0), bal)).alias("clamped"),
        F.abs(bal).alias("magnitude"),
        F.round(bal, 0).alias("whole"),
    )


def scalar_string_array(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    names = F.array(*[F.lit(c) for c in td.CATEGORIES])
    return td.table(spark, sf, "events").select(
        "event_id",
        F.concat(kind, F.lit("_"), F.col("user_id").cast("string")).alias("series"),
        F.upper(kind).alias("upper_kind"),
        F.lower(F.concat(F.lit(" "), F.upper(kind), F.lit("@Example.COM "))).alias("lowered"),
        F.trim(F.concat(F.lit("  "), kind, F.lit(" "))).alias("trimmed"),
        F.substring(kind, 1, 4).alias("prefix"),
        F.get(names, (F.col("event_id") % 8).cast("int")).alias("picked"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.try_divide(F.get_json_object("props", "$.k").cast("double"), F.lit(100.0)).alias("k_share"),
    )


# --- queries with more than one line ----------------------------------------

def spend_forecast_rows(t: LazyTables) -> DataFrame:
    return t["spend_forecast_input"]


def kpi_overview(t: LazyTables) -> DataFrame:
    by_channel = metric_query(
        t, "marketing", dimensions=["campaigns.channel"],
        metrics=["orders.total_revenue", "orders.total_orders", "orders.avg_order_value", "spend.total_spend"],
    )
    return kpi.kpi_overview(by_channel)


def touchpoints(scope: str) -> Callable[[LazyTables], DataFrame]:
    return lambda t: attribution.mta_touchpoints(t["orders"], t["spend"], t["campaigns"], WINDOW_DAYS, scope)


def journeys_customer(t: LazyTables) -> DataFrame:
    own = attribution.conversions_with_touches(t["orders"], t["spend"], t["campaigns"], WINDOW_DAYS, "customer")
    return attribution.mta_journeys(own, "sequence")


def summary_customer(t: LazyTables) -> DataFrame:
    own = attribution.conversions_with_touches(t["orders"], t["spend"], t["campaigns"], WINDOW_DAYS, "customer")
    return attribution.attr_summary(own)


def customer_per_zip(t: LazyTables) -> DataFrame:
    return enrich.customer_enriched(t["customers"], t["enrichment"], t["orders"], td.STAR_AS_OF, "one")


def geo_preagg(t: LazyTables) -> DataFrame:
    return geo.geo_targeting(
        t["customers"], t["enrichment"], t["orders"], t["weather"], td.EVENT_AS_OF, "preaggregated")


def survey(approximate: bool) -> Query:
    return lambda spark, sf: enrich.survey_weighted(
        td.survey_responses(spark, sf), td.survey_labels(spark), since_year=1997, approximate=approximate)


def survey_sketch_error(spark: SparkSession, sf: str) -> DataFrame:
    """Exact count of each answer, and whether the sketch is within five percent (or one) of it."""
    key = ["survey_year", "country", "category", "metric", "response"]
    sketch = survey(True)(spark, sf).select(*key, F.col("respondent_count").alias("_sketch"))
    off = F.abs(F.col("_sketch") - F.col("respondent_count"))
    return survey(False)(spark, sf).join(sketch, key).select(
        *key, "respondent_count", (off <= F.greatest(F.lit(1.0), F.col("respondent_count") * 0.05)).alias("sketch_is_close"))


def daily_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Load the orders up to a day, let the rest and some corrections arrive, refresh their days."""
    orders = td.orders_events(spark, sf)
    corrected = F.col("order_date").isin(dt.date(2024, 1, 5), dt.date(2024, 1, 12)) & (F.col("order_id") % 10 == 0)
    late = (F.col("order_date") >= cal.as_date("2024-01-29")) | corrected
    path = new_table_path(spark, "daily")
    refresh.initial_load(orders.where(~late), path)
    refresh.refresh_days(orders, orders.where(late), path)
    return refresh.read_daily(spark, path)


REFRESHED = ("mmm_contributions", "mmm_weekly", "product_revenue", "spend_daily", "daily_revenue")


def ordered_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Store five tables, let orders of the last days arrive, refresh: which tables were rewritten, and their totals."""
    root = new_table_path(spark, "tables")
    early = tables(spark, sf)
    early.replace("orders", early["orders"].where(F.col("order_date") < cal.as_date("2024-01-25")))
    refresh_stale(spark, early, REFRESHED, root)
    now = tables(spark, sf)
    rewritten = refresh_stale(spark, now, REFRESHED, root)
    money = {"mmm_contributions": "attributed_revenue", "mmm_weekly": "attributed_revenue", "product_revenue": "total_revenue",
             "spend_daily": "total_spend", "daily_revenue": "total_revenue"}
    parts = [now[n].agg(F.count(F.lit(1)).alias("n_rows"), sum_usd(m).alias("total")).select(
        F.lit(n).alias("table_name"), F.lit(n in rewritten).alias("rewritten"), "n_rows", "total") for n, m in money.items()]
    return reduce(DataFrame.unionAll, parts)


def _before_changes(orders: DataFrame) -> DataFrame:
    """The orders as they were known earlier: some had not come, some were booked otherwise, some were later withdrawn."""
    known = orders.where("order_id % 7 <> 3")
    booked = known.withColumn("order_date", F.when(F.col("order_id") % 11 == 5, F.date_sub("order_date", 40)).otherwise(F.col("order_date"))).withColumn(
        "product_category", F.when(F.col("order_id") % 13 == 6, "unknown").otherwise(F.col("product_category")))
    withdrawn = orders.where("order_id % 17 = 2").withColumn("product_category", F.lit("returned")).withColumn("order_date", F.date_add("order_date", 30))
    return booked.unionByName(withdrawn)


def upkept(upkeep: deltas.Upkeep, now: Query, before: Callable[[DataFrame], DataFrame], columns: tuple[str, ...]) -> Query:
    """The aggregate after a first load, a run of inserts, updates and deletes, and compaction."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        path, rows = new_table_path(spark, "upkeep"), now(spark, sf)
        old = before(rows)
        deltas.apply_changes(upkeep, upkeep.counted(old), path, 0)
        deltas.apply_changes(upkeep, upkeep.difference(old, rows), path, 1)
        deltas.compact(upkeep, spark, path)
        return deltas.read_result(spark, path, columns)

    return run


CUSTOMER_COLUMNS = ("customer_id", "total_orders", "total_revenue", "first_order_date", "last_order_date", "distinct_categories", "usual_category")
CUSTOMER_UPKEEP = deltas.Upkeep(
    keys=("customer_id",), values=("order_date", "product_category"), sums={"_revenue": partial(cents, "revenue")}, result=enrich.customer_history)
ZIP_COLUMNS = ("zip_code", "income_bracket", "lifestyle_segment", "outdoor_interest", "zip_records")
ZIP_UPKEEP = deltas.Upkeep(keys=("zip_code",), values=enrich.PROFILE, result=enrich.zip_modes, buckets=16)


def _records_before(records: DataFrame) -> DataFrame:
    """Household records of which some had not come and some said something else."""
    key = F.pmod(F.xxhash64(*records.columns), F.lit(9))
    known = records.where(key != 4)
    return known.withColumn("income_bracket", F.when(key == 2, "Unknown").otherwise(F.col("income_bracket")))


def orders_as_of_spend(spark: SparkSession, sf: str) -> DataFrame:
    """Each order with the latest spend day of its channel that is not after it."""
    t = tables(spark, sf)
    days = kpi.spend_by_channel_day(t["spend"])
    late = t["orders"].select("order_id", "channel", "order_date", "revenue")
    return asof.as_of_join(late, days, ["channel"], "order_date", "spend_date")


def purchases_as_of_touch(spark: SparkSession, sf: str) -> DataFrame:
    """Each purchase event with the last view, click or signup of the same user before it or at the same moment."""
    rows = td.table(spark, sf, "events")
    bought = rows.where("event_type = 'purchase'").select(F.col("event_id").alias("order_id"), "user_id", "ts", F.col("value").alias("revenue"))
    touched = rows.where("event_type in ('view', 'click', 'signup')").select(
        "user_id", F.col("ts").alias("touch_ts"), F.col("event_id").alias("touch_id"), F.col("event_type").alias("touch_type"))
    return asof.as_of_join(bought, touched, ["user_id"], "ts", "touch_ts")


def events_delivered_twice(spark: SparkSession, sf: str) -> DataFrame:
    """Daily revenue of a feed that delivers a third of its events again, in part much later, with compaction between."""
    feed, path = new_table_path(spark, "feed"), new_table_path(spark, "daily-once")
    rows = td.table(spark, sf, "events")
    parts = (rows.where("event_id % 2 = 0"), rows.where("event_id % 3 = 0"), rows.where("event_id % 2 = 1 or event_id % 9 = 0"))
    sums = events.added(events.DAILY_SUMS)
    for k, part in enumerate(parts):
        part.write.parquet(f"{feed}/part-{k}")
        events.accumulate(events.read_stream(spark, f"{feed}/*"), events.daily_revenue_windows, path, f"{path}-state")
        if k == 1:
            events.compact(spark, path, events.daily_revenue_windows, sums)
    return events.merged(spark, path, events.daily_revenue_windows, sums)


def merged_partials(t: LazyTables) -> DataFrame:
    late = F.col("order_id") % 3 == 0
    orders = t["orders"]
    return refresh.merge_partials(kpi.daily_revenue(orders.where(~late)), kpi.daily_revenue(orders.where(late)))


def date_spine(spark: SparkSession, sf: str) -> DataFrame:
    return spine.series_spine(td.order_heads(spark, sf))


def forecast_total(t: LazyTables) -> DataFrame:
    return series.forecast(series.total_series(t["forecast_input"]), "total_revenue", STAR_CUTOFF)


def forecast_overlay(t: LazyTables) -> DataFrame:
    return series.forecast_overlay(kpi.actuals_series(t["daily_revenue"]), forecast_total(t))


def train_holdout(t: LazyTables) -> DataFrame:
    return spine.split_counts(t["forecast_input"], STAR_CUTOFF)


def top_review_terms(t: LazyTables) -> DataFrame:
    return reviews.top_terms(t["sentiment"], 25, 4, (2, 5), (-0.5, 1.0))


def targets_reached(t: LazyTables) -> DataFrame:
    """The targets stored as a table and read back, against each quarter."""
    spark = t["campaigns"].sparkSession
    path = new_table_path(spark, "targets")
    write_snapshot(mmm.channel_targets(spark, td.TEST_TARGETS), path)
    return mmm.measures_vs_targets(t["mmm_contributions"], t["spend_daily"], spark.read.parquet(path))


def stored_category_revenue(t: LazyTables) -> DataFrame:
    """Revenue by category and channel as a stored table: a first state is replaced, later rows are appended."""
    spark = t["product_revenue"].sparkSession
    path, rows = new_table_path(spark, "stored"), t["product_revenue"].drop("product_name")
    write_snapshot(rows.where("channel = 'DTC'").limit(1), path)
    write_snapshot(rows.where("channel = 'DTC'"), path)
    append_rows(rows.where("channel <> 'DTC'"), path)
    return spark.read.parquet(path).groupBy("product_category", "channel").agg(
        F.sum("order_count").alias("order_count"), sum_usd("total_revenue").alias("total_revenue"))


def learned_words(t: LazyTables) -> DataFrame:
    return opinions.opinion_words(t["product_reviews"], td.TEST_NEGATIONS)


def learned_scores(t: LazyTables) -> DataFrame:
    return opinions.learned_sentiment(t["product_reviews"], learned_words(t), negations=td.TEST_NEGATIONS)


def order_tiers(t: LazyTables) -> DataFrame:
    return metric_query(
        t, "marketing", dimensions=["campaign_tiers.performance_tier"], metrics=["orders.total_orders"])


QUERIES: dict[str, Query] = {
    # daily, campaign, partner and product indicators
    "daily_revenue": _table("daily_revenue", "star", False),
    "product_revenue": _table("product_revenue", "star"),
    "campaign_metrics": _table("campaign_metrics"),
    "partner_performance": _table("partner_perf", "star", False),
    "spend_daily": _table("spend_daily"),
    "forecast_input": _table("forecast_input", "star"),
    "spend_forecast_input": _of(spend_forecast_rows),
    "kpi_overview": _of(kpi_overview),
    "kpi_rollup": _of(lambda t: kpi.kpi_rollup(t["spend"])),
    "top_campaigns_by_roas": _of(lambda t: kpi.top_campaigns_by_roas(t["campaign_metrics"], 5)),
    "campaigns_without_orders": _of(lambda t: kpi.campaigns_without_orders(t["campaigns"], t["orders"])),
    "category_revenue": _of(lambda t: kpi.category_revenue(t["product_revenue"]), "star"),
    "actuals_series": _of(lambda t: kpi.actuals_series(t["daily_revenue"], "DTC"), "star", False),
    "daily_revenue_range": _of(
        lambda t: kpi.daily_revenue_range(t["orders"], "1997-03-01", "1998-02-28", ["wholesale"]), "star", False),
    "period_compare": _of(
        lambda t: kpi.period_compare(t["orders"], ("1997-10-01", "1997-12-31"), ("1998-10-01", "1998-12-31")),
        "star", False),
    "channel_funnel": _of(lambda t: kpi.channel_funnel(t["spend"], t["campaigns"], t["orders"])),
    "scalar_date_parts": scalar_date_parts,
    "scalar_null_math": scalar_null_math,
    "scalar_string_array": scalar_string_array,
    # attribution
    "mta_touchpoints": _of(touchpoints("global")),
    "mta_touchpoints_customer": _of(touchpoints("customer")),
    "mta_journeys": _table("journey_stats"),
    "mta_journeys_customer": _of(journeys_customer),
    "journey_kpis": _of(lambda t: attribution.journey_kpis(t["journey_stats"])),
    **{
        f"attr_{key}": _of(lambda t, m=model: attribution.attribution(t["conversions"], m))
        for key, model in (
            ("first_touch", "first_touch"), ("last_touch", "last_touch"), ("linear", "linear"),
            ("time_decay", "time_decay"), ("position", "position_based"),
        )
    },
    "attr_summary": _table("attribution_summary"),
    "attr_summary_customer": _of(summary_customer),
    "attr_consensus": _of(lambda t: attribution.attr_consensus(t["attribution_summary"])),
    # marketing-mix model
    "mmm_daily": _table("mmm_daily"),
    "mmm_weekly": _table("mmm_weekly"),
    "mmm_contributions": _table("mmm_contributions"),
    "mmm_channel_summary": _table("mmm_channel_summary"),
    "mmm_efficiency_trend": _of(lambda t: mmm.mmm_efficiency_trend(t["mmm_weekly"], ["email", "search", "social"])),
    "mmm_insight_text": _table("mmm_insights"),
    "roas_vs_target": _of(lambda t: mmm.roas_vs_target(
        t["mmm_contributions"], {"email": 1.2, "search": 1.0, "social": 1.6, "trade_promo": 1.6})),
    "mmm_quarter": _of(lambda t: mmm.contributions_of(t["mmm_contributions"], ["Q1_2024"], ["email", "search", "social"])),
    "targets_reached": _of(targets_reached),
    # outside signals, customers, places
    "indicator_pivot": lambda spark, sf: _indicators(td.economic_series(spark, sf)),
    "segment_ladder": _table("enrichment"),
    "survey_weighted": survey(False),
    "survey_weighted_approx": survey(True),
    "survey_sketch_error": survey_sketch_error,
    "daily_weather": _table("weather"),
    "national_daily_signal": _table("national_weather"),
    "weather_revenue": _table("weather_revenue"),
    "weather_band_avg": _of(lambda t: enrich.weather_band_avg(t["weather_revenue"])),
    "customer_enriched": _table("customer_enriched", "star"),
    "customer_enriched_per_zip": _of(customer_per_zip, "star"),
    "segment_drilldown": _of(lambda t: enrich.segment_drilldown(t["customer_enriched"], "NATION_3"), "star"),
    "clv_tiers": _table("clv_risk", "star"),
    "clv_summary": _of(lambda t: clv.clv_summary(t["clv_risk"]), "star"),
    "segment_tier_mix": _of(lambda t: clv.segment_tier_mix(t["clv_risk"]), "star"),
    "geo_targeting": _table("geo_targeting"),
    "geo_targeting_preagg": _of(geo_preagg),
    "geo_profiles": _table("geo_profiles"),
    "geo_triggers": _table("geo_triggers"),
    "trigger_counts": _of(lambda t: geo.trigger_counts(t["geo_triggers"])),
    "geo_state_rollup": _table("geo_states"),
    "geo_state_text": _table("geo_recommendations"),
    "geo_map_points": _of(lambda t: geo.geo_map_points(
        t["geo_states"], {"NATION_1": (36.78, -119.42), "NATION_2": (31.97, -99.90)})),
    "top_states": _of(lambda t: geo.top_states(t["geo_states"], 10)),
    # metric layer
    "sv_sentiment_by_category": _metric(
        "reviews", rounded={"avg_sentiment": 6, "avg_rating": 6}, dimensions=["sentiment.product_category"],
        metrics=["sentiment.avg_sentiment", "sentiment.review_count", "sentiment.avg_rating"]),
    "sv_orders_by_segment": _metric(
        "marketing", rounded={"avg_order_value": 4}, dimensions=["customers.channel_preference", "orders.channel"],
        metrics=["orders.total_revenue", "orders.total_orders", "orders.avg_order_value"]),
    "sv_multi_fact_kpi": _metric(
        "marketing", rounded={"avg_order_value": 4, "ctr": 4}, dimensions=["campaigns.channel", "campaigns.sub_channel"],
        metrics=["orders.total_revenue", "orders.total_orders", "orders.avg_order_value",
                 "spend.total_spend", "spend.total_conversions", "spend.ctr"]),
    "sv_orders_by_tier": _of(order_tiers),
    "sv_orders_by_partner_tier": _metric(
        "marketing", dimensions=["partners.tier", "partners.region"], metrics=["orders.total_revenue", "orders.total_orders"]),
    "sv_facts_projection": _metric(
        "marketing", "star", dimensions=["daily_revenue.order_date", "daily_revenue.channel"],
        facts=["daily_revenue.total_revenue", "daily_revenue.order_count"]),
    "sv_filtered_top": _metric(
        "marketing", dimensions=["campaigns.campaign_name"], metrics=["orders.total_revenue", "orders.total_orders"],
        where=["campaigns.channel = 'DTC'", "orders.order_date >= '2024-01-05'"],
        order=["total_revenue desc", "campaign_name"], limit=7),
    "sv_dimension_list": _metric(
        "marketing", dimensions=["campaign_summaries.campaign_name", "campaign_summaries.executive_summary"]),
    "sv_ctr": _metric("marketing", rounded={"ctr": 6}, dimensions=["spend.spend_date"], metrics=["spend.ctr", "spend.total_spend"]),
    "sv_ml_anomaly_count": _metric(
        "model_results", dimensions=["anomalies.model_name"], metrics=["anomalies.anomaly_count"]),
    "sv_clv_at_risk": _metric(
        "advanced", "star", rounded={"avg_churn_risk": 4}, dimensions=["clv_risk.clv_tier"],
        metrics=["clv_risk.at_risk_count", "clv_risk.avg_churn_risk"]),
    "sv_journey_metrics": _metric(
        "advanced", rounded={"avg_touchpoints": 4, "avg_journey_days": 4}, dimensions=["journey_stats.channel_path"],
        metrics=["journey_stats.avg_touchpoints", "journey_stats.avg_journey_days", "journey_stats.total_conversions"]),
    "sv_mix_roi": _metric(
        "advanced", rounded={"avg_roi": 4}, dimensions=["mmm_contributions.period"],
        metrics=["mmm_contributions.avg_roi", "mmm_contributions.total_attributed_revenue"]),
    "sv_product_rows": _metric(
        "marketing", "star", dimensions=["product_revenue.product_category", "product_revenue.product_name", "product_revenue.channel"],
        facts=["product_revenue.total_revenue", "product_revenue.order_count"]),
    "sv_campaign_facts": _metric(
        "marketing", facts=["campaign_metrics.total_spend", "campaign_metrics.campaign_revenue", "campaign_metrics.roas"]),
    "sv_geo_score": _metric(
        "advanced", rounded={"avg_targeting_score": 6}, dimensions=["geo_profiles.state"], metrics=["geo_profiles.avg_targeting_score"]),
    "sv_weather_band": _metric(
        "advanced", rounded={"avg_daily_revenue": 4}, dimensions=["weather_revenue.temp_band"],
        metrics=["weather_revenue.avg_daily_revenue"], where="weather_revenue.channel = 'DTC'"),
    "sv_attribution_rows": _metric(
        "advanced", dimensions=["attribution_summary.sub_channel", "attribution_summary.model_name"],
        facts=["attribution_summary.total_attributed_revenue", "attribution_summary.conversions_attributed"],
        where="attribution_summary.model_name = 'linear'"),
    "sv_mix_weeks": _metric(
        "advanced", dimensions=["mmm_weekly.week_start", "mmm_weekly.sub_channel"],
        facts=["mmm_weekly.spend", "mmm_weekly.attributed_revenue"]),
    "sv_forecast_rows": _metric(
        "model_results", dimensions=["forecasts.model_name", "forecasts.series", "forecasts.ts"],
        facts=["forecasts.forecast", "forecasts.lower_bound", "forecasts.upper_bound"],
        where="forecasts.model_name = 'total_revenue' and forecasts.ts < '2024-02-20 00:00:00'"),
    "sv_feature_importance": _metric(
        "model_results", "star", dimensions=["feature_importance.feature_name", "feature_importance.feature_type"],
        facts=["feature_importance.score", "feature_importance.rank"], where="feature_importance.rank <= 3"),
    "sv_partner_facts": _of(lambda t: metric_query(
        t, "marketing", facts=["partner_perf.total_revenue", "partner_perf.total_orders", "partner_perf.total_units_sold"]), "star", False),
    "sv_extract_rows": _metric(
        "reviews", dimensions=["extracts.product_category", "extracts.channel", "extracts.product_feedback", "extracts.recommendation"],
        facts=["extracts.rating"], where="extracts.competitor_mention is not null"),
    "sv_sentiment_by_recommendation": _metric(
        "reviews", rounded={"avg_sentiment": 6, "avg_rating": 6}, dimensions=["extracts.recommendation", "sentiment.channel"],
        metrics=["sentiment.avg_sentiment", "sentiment.review_count", "sentiment.avg_rating"]),
    "sv_themes": _metric("reviews", dimensions=["themes.channel", "themes.themes"]),
    "sv_trigger_list": _metric("advanced", dimensions=["geo_triggers.trigger_action"]),
    "sv_geo_advice": _metric("advanced", dimensions=["geo_recommendations.state", "geo_recommendations.recommendation"]),
    "sv_key_check": lambda spark, sf: MARKETING.key_check(
        tables(spark, sf), ["campaigns", "orders", "customers", "spend", "partners"]),
    "sv_key_check_customers": lambda spark, sf: ADVANCED.key_check(
        tables(spark, sf, "star"), ["customer_enriched", "clv_risk"]),
    "q_top5_roas": _of(questions.top_campaigns),
    "q_category_revenue": _of(questions.revenue_by_category),
    "q_spend_anomalies": _of(questions.spend_anomalies),
    "q_sentiment_category": _of(questions.sentiment_by_category),
    "q_best_roi_channel": _of(questions.best_roi_channel),
    "q_at_risk_count": _of(questions.at_risk_customers, "star"),
    # calendar expansion, sampling, what-if
    "date_spine": date_spine,
    "date_spine_counts": lambda spark, sf: spine.date_spine_counts(td.orders_star(spark, sf), 50),
    "campaign_days": _of(lambda t: spine.campaign_days(t["campaigns"])),
    "revenue_what_if": _of(lambda t: spine.revenue_what_if(
        t["orders"], WHAT_IF_SEASONS, WHAT_IF_EVENTS, WHAT_IF_PRICES)),
    "stable_sample": _of(lambda t: spine.stable_sample(t["orders"], "order_id", 200, 999)),
    "surrogate_key": _of(lambda t: spine.surrogate_key(
        t["spend"].select("spend_id", "spend_date", "campaign_id", "amount"),
        ["spend_date", "campaign_id", "spend_id"], "row_no")),
    # forecasts and anomalies
    "train_holdout_split": _of(train_holdout, "star"),
    "forecast_total": _of(forecast_total, "star"),
    "forecast_product_channel": _of(
        lambda t: series.forecast(t["forecast_input"], "product_channel", STAR_CUTOFF), "star"),
    "forecast_spend": _of(lambda t: series.forecast(t["spend_forecast_input"], "spend_subchannel", EVENT_CUTOFF)),
    "forecast_all": _table("forecasts", "event"),
    "forecast_coverage": _of(lambda t: series.forecast_coverage(t["forecasts"])),
    "forecast_overlay": _of(forecast_overlay, "star"),
    "forecast_calendar": _of(lambda t: calendar_model.forecast_calendar(t["forecast_input"], "product_channel", STAR_CUTOFF), "star"),
    "forecast_calendar_backtest": _of(lambda t: calendar_model.calendar_backtest(t["forecast_input"], STAR_CUTOFF), "star"),
    "feature_loss": _of(lambda t: calendar_model.feature_loss(t["forecast_input"]), "star"),
    "forecast_backtest": _of(lambda t: series.forecast_backtest(t["forecast_input"], STAR_CUTOFF), "star"),
    "forecast_pandas": _of(lambda t: series.forecast_pandas(t["forecast_input"], "weekday_mean", periods=28), "star"),
    "feature_importance": _table("feature_importance", "star"),
    "anomaly_spend": _table("spend_anomalies"),
    "anomaly_conversion_rate": _table("rate_anomalies"),
    "anomaly_order_counts": _table("order_anomalies", "star"),
    "anomaly_all": _table("anomalies"),
    "anomaly_deviation": _of(lambda t: series.anomaly_deviation(t["order_anomalies"]), "star"),
    "forecast_chosen": _of(lambda t: series.chosen_rows(
        t["forecasts"], "spend_subchannel", ["email", "search"], "2024-02-01", "2024-03-15")),
    "anomaly_chosen": _of(lambda t: series.chosen_rows(t["anomalies"], "wholesale_product", ["camping", "footwear"])),
    "anomaly_robust_orders": _of(lambda t: robust.detect_robust(series.order_count_series(t["orders"]), "wholesale_product", STAR_CUTOFF), "star"),
    "anomaly_robust_spend": _of(lambda t: robust.detect_robust(
        series.spend_series(t["spend_daily"], EXCLUDE), "spend_subchannel", EVENT_CUTOFF)),
    "rolling_zscore": _of(lambda t: series.rolling_zscore(t["forecast_input"]), "star"),
    # text
    "review_sentiment": _table("sentiment"),
    "sentiment_by_channel": _of(lambda t: reviews.sentiment_by_channel(t["sentiment"])),
    "sentiment_histogram": _of(lambda t: reviews.sentiment_histogram(t["sentiment"])),
    "review_extract": _table("extracts"),
    "campaign_tiers": _table("campaign_tiers"),
    "tier_counts": _of(lambda t: reviews.tier_counts(t["campaign_tiers"])),
    "campaign_summary_text": _table("campaign_summaries"),
    "channel_themes": _table("themes"),
    "top_terms": _of(top_review_terms),
    "theme_phrases": _of(lambda t: phrases.theme_phrases(t["product_reviews"])),
    "opinion_words": _of(learned_words),
    "sentiment_learned": _of(learned_scores),
    "sentiment_learned_order": _of(lambda t: opinions.rating_order(learned_scores(t))),
    "stored_category_revenue": _of(stored_category_revenue, "star"),
    # refresh and streaming
    "daily_revenue_incremental": daily_incremental,
    "merge_partials": _of(merged_partials),
    "refresh_ordered": ordered_refresh,
    "customer_history_upkept": upkept(CUSTOMER_UPKEEP, lambda spark, sf: td.orders_events(spark, sf), _before_changes, CUSTOMER_COLUMNS),
    "zip_modes_upkept": upkept(ZIP_UPKEEP, lambda spark, sf: tables(spark, sf)["enrichment"], _records_before, ZIP_COLUMNS),
    "orders_as_of_spend": orders_as_of_spend,
    "purchases_as_of_touch": purchases_as_of_touch,
    "stream_delivered_twice": events_delivered_twice,
    "stream_daily_revenue": lambda spark, sf: events.whole_daily_revenue(spark, f"{sf}/events.parquet*"),
    "stream_weekly_spend": lambda spark, sf: events.whole_weekly_spend(spark, f"{sf}/events.parquet*"),
}
