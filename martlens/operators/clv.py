"""Customer value tiers and churn risk."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlens.functions.money import cents, ratio

# Weights and scales of the churn score, and the limits of the tiers, first match wins.
RECENCY_WEIGHT, RECENCY_DAYS = 0.6, 365.0
FREQUENCY_WEIGHT, FREQUENT_ORDERS = 0.4, 2.0
LOYAL = {"value": 1500, "days": 60, "risk": 0.20}
GROWTH = {"value": 500, "orders": 3, "days": 120}
NEW = {"orders": 2, "days": 120}
LAPSED = {"days": 300, "risk": 0.85}
AT_RISK = {"days": (121, 300), "risk": (0.40, 0.75)}


def clv_tiers(enriched: DataFrame) -> DataFrame:
    """Tier and churn score of every enriched customer row.

    The score weighs recency 0.6 and frequency 0.4. The ladder is read top
    down, so a customer without orders ends as 'Lapsed' with score 1.0.
    """
    days, orders, value = F.col("days_since_last_order"), F.col("total_orders"), F.col("lifetime_value")
    recency = F.least(F.lit(1.0), F.coalesce(days, F.lit(365)) / F.lit(RECENCY_DAYS))
    frequency = F.least(F.lit(1.0), F.coalesce("orders_per_month", F.lit(0.0)) / F.lit(FREQUENT_ORDERS))
    weighed = F.lit(RECENCY_WEIGHT) * recency + F.lit(FREQUENCY_WEIGHT) * (F.lit(1.0) - frequency)
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), weighed))
    since, risk = F.coalesce(days, F.lit(999)), F.col("_score")
    known = F.coalesce(days, F.lit(0))
    tier = (
        F.when((value >= LOYAL["value"]) & (since <= LOYAL["days"]) & (risk <= LOYAL["risk"]), "Loyal High-Value")
        .when(((value >= GROWTH["value"]) | (orders >= GROWTH["orders"])) & (since <= GROWTH["days"]), "Growth Potential")
        .when((orders <= NEW["orders"]) & (known <= NEW["days"]), "New Customer")
        .when((since > LAPSED["days"]) | (risk > LAPSED["risk"]), "Lapsed")
        .when(since.between(*AT_RISK["days"]) | risk.between(*AT_RISK["risk"]), "At-Risk")
        .otherwise("Growth Potential")
    )
    weight = ["profile_rows"] if "profile_rows" in enriched.columns else []
    return enriched.withColumn("_score", score).select(
        "customer_id",
        tier.alias("clv_tier"),
        "lifetime_value",
        F.round("_score", 3).alias("churn_risk_score"),
        "total_orders",
        "total_revenue",
        "days_since_last_order",
        "state",
        "age_group",
        "value_tier",
        "lifestyle_segment",
        "outdoor_interest",
        *weight,
    )


def _weight(tiers: DataFrame):
    return F.col("profile_rows") if "profile_rows" in tiers.columns else F.lit(1).cast("bigint")


def clv_summary(tiers: DataFrame) -> DataFrame:
    """Rows, mean value and mean risk per tier; takes plain or weighted tiers."""
    n = _weight(tiers)
    mills = F.rint(F.col("churn_risk_score") * 1000).cast("bigint")
    valued = F.when(F.col("lifetime_value").isNotNull(), n)
    scored = F.when(F.col("churn_risk_score").isNotNull(), n)
    return tiers.groupBy("clv_tier").agg(
        F.sum(n).alias("cnt"),
        ratio(F.sum(cents("lifetime_value") * n), F.sum(valued) * 100, 2).alias("avg_ltv"),
        ratio(F.sum(mills * n), F.sum(scored) * 1000, 3).alias("avg_churn"),
    )


def segment_tier_mix(tiers: DataFrame) -> DataFrame:
    """Share of each tier inside its lifestyle segment."""
    counts = tiers.groupBy("lifestyle_segment", "clv_tier").agg(F.sum(_weight(tiers)).alias("cnt"))
    total = F.sum("cnt").over(Window.partitionBy("lifestyle_segment"))
    return counts.select("lifestyle_segment", "clv_tier", "cnt", (F.col("cnt") / total).alias("pct"))
