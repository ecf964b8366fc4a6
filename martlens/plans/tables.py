"""All derived tables as one dependency-ordered set of lazy frames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from martlens.operators import attribution, clv, enrich, geo, kpi, mmm, reviews, series
from martlens.plans.models import MODELS
from martlens.plans.semantic import LazyTables
from martlens.plans.upkeep import refresh_stale


def market_tables(
    base: Mapping[str, Callable[[], DataFrame]],
    as_of: dt.date,
    cutoff: dt.date | str,
    window_days: int = 30,
    weather_since: dt.date | str = "2025-01-01",
    indicators: Callable[[DataFrame], DataFrame] | None = None,
    exclude: Sequence[str] = ("distributor_event",),
    review_words: Mapping[str, Sequence[str]] | None = None,
) -> LazyTables:
    """Base makers plus every derived table, each built when first asked for.

    ``base`` makes ``orders``, ``campaigns``, ``customers``, ``spend``,
    ``partners``, ``consumer_records``, ``weather_history``, ``economic_series``
    and ``product_reviews``; only those that a query reaches are called.
    """
    words = dict(review_words or {})
    opinion = {k: words[k] for k in ("positive", "negative") if k in words}
    cues = {k: words[k] for k in ("feedback", "competitors", "recommend", "discourage") if k in words}
    t: LazyTables
    makers: dict[str, Callable[[], DataFrame]] = dict(base)
    makers.update({
        # daily, campaign and partner indicators
        "daily_revenue": lambda: kpi.daily_revenue(t["orders"]),
        "product_revenue": lambda: kpi.product_revenue(t["orders"]),
        "campaign_metrics": lambda: kpi.campaign_metrics(t["campaigns"], t["spend"], t["orders"]),
        "partner_perf": lambda: kpi.partner_performance(t["partners"], t["orders"]),
        "spend_daily": lambda: kpi.spend_daily(t["spend"]),
        "forecast_input": lambda: kpi.forecast_input(t["orders"]),
        "spend_forecast_input": lambda: kpi.spend_forecast_input(t["spend_daily"], exclude),
        # outside signals
        "enrichment": lambda: enrich.segment_ladder(t["consumer_records"]),
        "weather": lambda: enrich.daily_weather(t["weather_history"], weather_since),
        "national_weather": lambda: enrich.national_daily_signal(t["weather"]),
        "weather_revenue": lambda: enrich.weather_revenue(t["daily_revenue"], t["national_weather"]),
        "mmm_daily": lambda: mmm.mmm_daily(
            t["spend_daily"], t["daily_revenue"], indicators(t["economic_series"]), t["national_weather"]),
        # customers and places
        "customer_enriched": lambda: enrich.customer_enriched(t["customers"], t["enrichment"], t["orders"], as_of),
        "clv_risk": lambda: clv.clv_tiers(t["customer_enriched"]),
        "geo_targeting": lambda: geo.geo_targeting(
            t["customers"], t["enrichment"], t["orders"], t["weather"], as_of),
        "geo_profiles": lambda: geo.geo_profiles(t["geo_targeting"]),
        "geo_triggers": lambda: geo.geo_triggers(t["geo_targeting"]),
        "geo_states": lambda: geo.geo_state_rollup(t["geo_profiles"]),
        "geo_recommendations": lambda: reviews.geo_state_text(t["geo_states"]),
        # mix model
        "mmm_weighted": lambda: mmm.mmm_weighted(t["spend_daily"], t["daily_revenue"]),
        "mmm_weekly": lambda: mmm.mmm_weekly(t["mmm_weighted"]),
        "mmm_contributions": lambda: mmm.mmm_contributions(t["mmm_weighted"]),
        "mmm_channel_summary": lambda: mmm.mmm_channel_summary(t["mmm_contributions"]),
        "mmm_insights": lambda: mmm.mmm_insight_text(t["mmm_channel_summary"]),
        # attribution
        "conversions": lambda: attribution.conversions_with_touches(
            t["orders"], t["spend"], t["campaigns"], window_days),
        "journey_stats": lambda: attribution.mta_journeys(t["conversions"]),
        "attribution_summary": lambda: attribution.attr_summary(t["conversions"]),
        # forecasts and anomalies
        "forecasts": lambda: series.forecast(series.total_series(t["forecast_input"]), "total_revenue", cutoff)
        .unionByName(series.forecast(t["forecast_input"], "product_channel", cutoff))
        .unionByName(series.forecast(t["spend_forecast_input"], "spend_subchannel", cutoff)),
        "spend_anomalies": lambda: series.detect_anomalies(
            series.spend_series(t["spend_daily"], exclude), "spend_subchannel", cutoff),
        "rate_anomalies": lambda: series.detect_anomalies(
            series.conversion_rate_series(t["spend_daily"]), "dtc_conversion", cutoff, digits=4, fill_gaps=False),
        "order_anomalies": lambda: series.detect_anomalies(
            series.order_count_series(t["orders"]), "wholesale_product", cutoff),
        "anomalies": lambda: t["spend_anomalies"].unionByName(t["rate_anomalies"]).unionByName(t["order_anomalies"]),
        "feature_importance": lambda: series.feature_importance(t["forecast_input"]),
        # text
        "campaign_tiers": lambda: reviews.campaign_tiers(t["campaign_metrics"]),
        "campaign_summaries": lambda: reviews.campaign_summary_text(t["campaign_metrics"]),
        "sentiment": lambda: reviews.review_sentiment(t["product_reviews"], **opinion),
        "extracts": lambda: reviews.review_extract(t["product_reviews"], **cues),
        "themes": lambda: reviews.channel_themes(t["product_reviews"]),
    })
    t = LazyTables(makers)
    return t


def metric_query(tables: LazyTables, model: str, **request) -> DataFrame:
    """A metric-layer query on one of the four models."""
    return MODELS[model].query(tables, **request)


def refresh(spark: SparkSession, tables: LazyTables, targets: Sequence[str], root: str) -> LazyTables:
    """Bring the stored copies of ``targets`` up to date; tables built afterwards read them. See ``plans.upkeep``.

    Nothing else is computed: a table without a stored copy stays a lazy frame
    that is expanded into its consumers.
    """
    refresh_stale(spark, tables, targets, root)
    return tables
