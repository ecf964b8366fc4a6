"""The six saved questions, as metric-layer or operator queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.operators import kpi
from martlens.plans.semantic import LazyTables
from martlens.plans.tables import metric_query


def top_campaigns(tables: LazyTables) -> DataFrame:
    return kpi.top_campaigns_by_roas(tables["campaign_metrics"], 5)


def revenue_by_category(tables: LazyTables) -> DataFrame:
    return metric_query(
        tables, "marketing", dimensions=["orders.product_category"], metrics=["orders.total_revenue"],
        order=["total_revenue desc"],
    )


def spend_anomalies(tables: LazyTables) -> DataFrame:
    return metric_query(
        tables, "model_results",
        dimensions=["anomalies.series", "anomalies.ts"],
        facts=["anomalies.y", "anomalies.forecast", "anomalies.percentile"],
        where=["anomalies.model_name = 'spend_subchannel'", "anomalies.is_anomaly"],
        order=["ts"],
    )


def sentiment_by_category(tables: LazyTables) -> DataFrame:
    rows = metric_query(
        tables, "reviews", dimensions=["sentiment.product_category"],
        metrics=["sentiment.avg_sentiment", "sentiment.review_count"],
    )
    return rows.withColumn("avg_sentiment", F.round("avg_sentiment", 4))


def best_roi_channel(tables: LazyTables) -> DataFrame:
    return tables["mmm_channel_summary"].orderBy(F.desc_nulls_last("overall_roi"), F.asc("sub_channel")).limit(1)


def at_risk_customers(tables: LazyTables) -> DataFrame:
    return metric_query(tables, "advanced", metrics=["clv_risk.at_risk_count"])
