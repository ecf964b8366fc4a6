"""The four metric models: core marketing, model results, reviews, advanced.

Fixed values throughout: the names of entities, facts, dimensions and metrics.
"""

from __future__ import annotations

from martlens.plans.semantic import Relationship, SemanticView, count_where, mean, row_count, share, total

MARKETING = SemanticView(
    name="marketing",
    entities={
        "campaigns": ("campaign_id",),
        "orders": ("order_id",),
        "customers": ("customer_id",),
        "spend": ("spend_id",),
        "partners": ("partner_id",),
        "campaign_metrics": ("campaign_id",),
        "partner_perf": ("partner_id",),
        "daily_revenue": (),
        "product_revenue": (),
        "campaign_tiers": ("campaign_id",),
        "campaign_summaries": ("campaign_id",),
    },
    relationships=(
        Relationship("orders", "campaign_id", "campaigns", "campaign_id"),
        Relationship("orders", "customer_id", "customers", "customer_id"),
        Relationship("orders", "wholesale_partner_id", "partners", "partner_id"),
        Relationship("spend", "campaign_id", "campaigns", "campaign_id"),
        Relationship("campaign_metrics", "campaign_id", "campaigns", "campaign_id"),
        Relationship("partner_perf", "partner_id", "partners", "partner_id"),
        Relationship("campaign_tiers", "campaign_id", "campaigns", "campaign_id"),
        Relationship("campaign_summaries", "campaign_id", "campaigns", "campaign_id"),
    ),
    facts={
        "orders": ("revenue", "quantity"),
        "spend": ("amount", "impressions", "clicks", "conversions"),
        "campaigns": ("budget",),
        "campaign_metrics": ("total_spend", "campaign_revenue", "cpa", "roas"),
        "partner_perf": ("total_revenue", "total_orders", "total_units_sold", "avg_sell_through_rate"),
        "customers": ("lifetime_value",),
        "daily_revenue": ("order_count", "total_units", "total_revenue", "avg_order_value"),
        "product_revenue": ("order_count", "total_units", "total_revenue", "avg_order_value"),
        "campaign_tiers": ("roas",),
    },
    dimensions={
        "orders": ("order_date", "channel", "product_category", "product_name"),
        "campaigns": ("campaign_name", "channel", "sub_channel"),
        "customers": ("state", "age", "gender", "channel_preference"),
        "partners": ("partner_name", "region", "tier"),
        "spend": ("spend_date",),
        "daily_revenue": ("order_date", "channel"),
        "product_revenue": ("product_category", "product_name", "channel"),
        "campaign_tiers": ("campaign_name", "channel", "sub_channel", "performance_tier"),
        "campaign_summaries": ("campaign_name", "channel", "sub_channel", "executive_summary"),
    },
    metrics={
        "orders": {
            "total_revenue": total("revenue", money=True),
            "total_orders": row_count("order_id"),
            "avg_order_value": mean("revenue", money=True),
        },
        "spend": {
            "total_spend": total("amount", money=True),
            "total_conversions": total("conversions"),
            "ctr": share("clicks", "impressions"),
        },
    },
)

MODEL_RESULTS = SemanticView(
    name="model_results",
    entities={"forecasts": (), "anomalies": (), "feature_importance": ()},
    facts={
        "forecasts": ("forecast", "lower_bound", "upper_bound"),
        "anomalies": ("y", "forecast", "lower_bound", "upper_bound", "percentile"),
        "feature_importance": ("score", "rank"),
    },
    dimensions={
        "forecasts": ("model_name", "series", "ts"),
        "anomalies": ("model_name", "series", "ts", "is_anomaly"),
        "feature_importance": ("feature_name", "feature_type"),
    },
    metrics={"anomalies": {"anomaly_count": count_where("is_anomaly = TRUE")}},
)

REVIEWS = SemanticView(
    name="reviews",
    entities={"sentiment": ("review_id",), "extracts": ("review_id",), "themes": ()},
    relationships=(Relationship("extracts", "review_id", "sentiment", "review_id"),),
    facts={"sentiment": ("sentiment_score", "rating"), "extracts": ("rating",)},
    dimensions={
        "sentiment": ("review_text", "channel", "product_category"),
        "extracts": (
            "product_category", "product_name", "channel", "review_text",
            "product_feedback", "competitor_mention", "recommendation",
        ),
        "themes": ("channel", "themes"),
    },
    metrics={
        "sentiment": {
            "avg_sentiment": mean("sentiment_score"),
            "review_count": row_count("review_id"),
            "avg_rating": mean("rating"),
        }
    },
)

ADVANCED = SemanticView(
    name="advanced",
    entities={
        "mmm_contributions": (),
        "mmm_weekly": (),
        "mmm_insights": (),
        "geo_profiles": (),
        "geo_triggers": (),
        "geo_recommendations": (),
        "clv_risk": ("customer_id",),
        "weather_revenue": (),
        "customer_enriched": ("customer_id",),
        "attribution_summary": (),
        "journey_stats": (),
    },
    relationships=(Relationship("clv_risk", "customer_id", "customer_enriched", "customer_id"),),
    facts={
        "mmm_contributions": ("total_spend", "attributed_revenue", "roi", "share_of_spend", "cost_per_conversion"),
        "mmm_weekly": ("spend", "attributed_revenue", "incremental_revenue", "efficiency_index"),
        "geo_profiles": ("customer_count", "avg_ltv", "total_revenue", "targeting_score"),
        "clv_risk": ("lifetime_value", "total_orders", "total_revenue", "churn_risk_score", "days_since_last_order"),
        "weather_revenue": ("total_revenue", "national_avg_temp_f"),
        "customer_enriched": ("lifetime_value", "avg_order_value", "orders_per_month"),
        "attribution_summary": ("total_attributed_revenue", "conversions_attributed"),
        "journey_stats": ("revenue", "total_touchpoints", "journey_duration_days"),
    },
    dimensions={
        "mmm_contributions": ("sub_channel", "period"),
        "mmm_weekly": ("week_start", "sub_channel"),
        "geo_profiles": (
            "state", "zip_code", "dominant_lifestyle", "dominant_outdoor_interest",
            "weather_recommended_category", "recommended_channel",
        ),
        "geo_triggers": ("trigger_action",),
        "geo_recommendations": ("state", "recommendation"),
        "clv_risk": ("clv_tier", "state", "age_group", "value_tier", "lifestyle_segment", "outdoor_interest"),
        "weather_revenue": ("order_date", "channel", "temp_band", "rainy_day", "snow_day"),
        "customer_enriched": ("state", "age_group", "value_tier", "lifestyle_segment", "outdoor_interest"),
        "attribution_summary": ("sub_channel", "model_name"),
        "journey_stats": ("channel_path",),
    },
    weights={"clv_risk": "profile_rows", "customer_enriched": "profile_rows"},
    metrics={
        "mmm_contributions": {
            "avg_roi": mean("roi", money=True),
            "total_attributed_revenue": total("attributed_revenue", money=True),
        },
        "geo_profiles": {"avg_targeting_score": mean("targeting_score")},
        "clv_risk": {
            "at_risk_count": count_where("churn_risk_score >= 0.7", weight="profile_rows"),
            "avg_churn_risk": mean("churn_risk_score", weight="profile_rows"),
        },
        "weather_revenue": {"avg_daily_revenue": mean("total_revenue", money=True)},
        "journey_stats": {
            "avg_touchpoints": mean("total_touchpoints"),
            "avg_journey_days": mean("journey_duration_days"),
            "total_conversions": row_count("conversion_id"),
        },
    },
)

MODELS = {m.name: m for m in (MARKETING, MODEL_RESULTS, REVIEWS, ADVANCED)}
