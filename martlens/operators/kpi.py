"""Daily, campaign, partner and product indicators.

All of them are hash aggregates with map-side partials. Where two inputs meet,
each is aggregated to the join key first, so no key is joined row by row and a
campaign, partner or day that owns a large part of the rows costs no more.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.functions.calendar import as_date, is_holiday, is_weekend
from martlens.functions.money import avg_usd, cents, ratio, sum_cents, sum_usd, usd
from martlens.operators.mmm import ROAS_TARGET_OVERALL


def _order_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("order_count"),
        F.sum("quantity").alias("total_units"),
        sum_usd("revenue").alias("total_revenue"),
        avg_usd("revenue").alias("avg_order_value"),
    ]


def daily_revenue(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_date", "channel").agg(*_order_measures())


def product_revenue(orders: DataFrame) -> DataFrame:
    return orders.groupBy("product_category", "product_name", "channel").agg(*_order_measures())


def campaign_metrics(campaigns: DataFrame, spend: DataFrame, orders: DataFrame) -> DataFrame:
    """Spend, response, revenue, cost per acquisition, ROAS and click rate of every campaign."""
    cost = spend.groupBy("campaign_id").agg(
        sum_cents("amount").alias("_spend"),
        F.sum("impressions").alias("_impressions"),
        F.sum("clicks").alias("_clicks"),
        F.sum("conversions").alias("_conversions"),
    )
    sales = orders.groupBy("campaign_id").agg(sum_cents("revenue").alias("_revenue"))
    zero = F.lit(0).cast("bigint")
    spent, revenue = F.coalesce("_spend", zero), F.coalesce("_revenue", zero)
    return (
        campaigns.join(cost, "campaign_id", "left")
        .join(sales, "campaign_id", "left")
        .select(
            *[campaigns[c] for c in campaigns.columns],
            usd(spent).alias("total_spend"),
            F.coalesce("_impressions", zero).alias("total_impressions"),
            F.coalesce("_clicks", zero).alias("total_clicks"),
            F.coalesce("_conversions", zero).alias("total_conversions"),
            usd(revenue).alias("campaign_revenue"),
            F.when(F.col("_conversions") > 0, ratio(spent, F.col("_conversions") * 100, 2)).alias("cpa"),
            F.when(spent > 0, ratio(revenue, spent, 2)).alias("roas"),
            F.when(
                F.col("_impressions") > 0,
                ratio(F.coalesce("_clicks", zero) * 100, "_impressions", 3),
            ).alias("ctr_pct"),
        )
    )


def partner_performance(partners: DataFrame, orders: DataFrame) -> DataFrame:
    """Every partner with its orders; partners without orders are kept with count 0."""
    sales = (
        orders.where(F.col("wholesale_partner_id").isNotNull())
        .groupBy(F.col("wholesale_partner_id").alias("partner_id"))
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("quantity").alias("total_units_sold"),
            sum_cents("revenue").alias("_revenue"),
            F.count("revenue").alias("_priced"),
        )
    )
    return partners.join(sales, "partner_id", "left").select(
        "partner_id",
        "partner_name",
        "region",
        "tier",
        "avg_sell_through_rate",
        F.col("annual_volume").alias("target_annual_volume"),
        F.coalesce("total_orders", F.lit(0).cast("bigint")).alias("total_orders"),
        "total_units_sold",
        usd("_revenue").alias("total_revenue"),
        ratio("_revenue", F.col("_priced") * 100, 2).alias("avg_order_value"),
        ratio("_revenue", "annual_volume", 1).alias("revenue_attainment_pct"),
    )


def forecast_input(orders: DataFrame) -> DataFrame:
    """Daily revenue per category and channel with calendar flags."""
    return orders.groupBy("order_date", "product_category", "channel").agg(sum_usd("revenue").alias("y")).select(
        F.col("order_date").alias("ds"),
        F.concat("product_category", F.lit("_"), "channel").alias("series"),
        "y",
        is_weekend("order_date").alias("is_weekend"),
        is_holiday("order_date").alias("is_holiday"),
    )


def spend_by_channel_day(spend: DataFrame) -> DataFrame:
    """Spend and conversions per channel and day."""
    return spend.groupBy("channel", "spend_date").agg(
        sum_usd("amount").alias("day_spend"), F.sum("conversions").alias("day_conversions"))


def spend_daily(spend: DataFrame) -> DataFrame:
    clicks, conversions = F.sum("clicks"), F.sum("conversions")
    return spend.groupBy(F.col("spend_date").alias("ds"), "channel", "sub_channel").agg(
        sum_usd("amount").alias("total_spend"),
        F.sum("impressions").alias("total_impressions"),
        clicks.alias("total_clicks"),
        conversions.alias("total_conversions"),
        F.when(clicks > 0, ratio(conversions * 100, clicks, 3)).otherwise(F.lit(0.0)).alias("conversion_rate_pct"),
    )


def spend_forecast_input(daily_spend: DataFrame, exclude: Sequence[str] = ("distributor_event",)) -> DataFrame:
    """Second-level aggregate of the daily spend; sparse sub-channels are left out."""
    return (
        daily_spend.where(~F.col("sub_channel").isin(*exclude))
        .groupBy("ds", F.col("sub_channel").alias("series"))
        .agg(sum_usd("total_spend").alias("y"))
        .select("ds", "series", "y", is_weekend("ds").alias("is_weekend"))
    )


def kpi_overview(by_channel: DataFrame, roas_target: float = ROAS_TARGET_OVERALL) -> DataFrame:
    """One header row from the per-channel metrics of the metric layer."""
    def channel_cents(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("channel") == name, cents("total_revenue"))), F.lit(0).cast("bigint"))

    revenue, spent = sum_cents("total_revenue"), sum_cents("total_spend")
    totals = by_channel.agg(
        usd(revenue).alias("total_revenue"),
        usd(channel_cents("DTC")).alias("dtc_revenue"),
        usd(channel_cents("wholesale")).alias("wholesale_revenue"),
        F.sum("total_orders").alias("total_orders"),
        F.round(F.avg("avg_order_value"), 2).alias("avg_order_value"),
        usd(spent).alias("total_spend"),
        F.when(spent > 0, ratio(revenue, spent, 2)).otherwise(F.lit(0.0)).alias("roas"),
    )
    return totals.withColumn("roas_delta", F.round(F.col("roas") - F.lit(roas_target), 2))


def kpi_rollup(spend: DataFrame) -> DataFrame:
    """Spend and response by sub-channel with channel and grand totals."""
    return spend.rollup("channel", "sub_channel").agg(
        F.grouping_id().cast("int").alias("level"),
        sum_usd("amount").alias("total_spend"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("conversions").alias("total_conversions"),
    )


def top_campaigns_by_roas(metrics: DataFrame, n: int = 5) -> DataFrame:
    return (
        metrics.orderBy(F.desc_nulls_last("roas"), F.asc("campaign_id"))
        .limit(n)
        .select("campaign_id", "campaign_name", "channel", "sub_channel", "roas", "campaign_revenue", "total_spend")
    )


def campaigns_without_orders(campaigns: DataFrame, orders: DataFrame) -> DataFrame:
    """Anti join; the order side is reduced to its campaign ids first."""
    ordered = orders.select("campaign_id").distinct()
    return campaigns.join(ordered, "campaign_id", "left_anti").select("campaign_id", "campaign_name", "sub_channel")


def category_revenue(products: DataFrame) -> DataFrame:
    return products.groupBy("product_category").agg(sum_usd("total_revenue").alias("total_revenue"))


def actuals_series(daily: DataFrame, channel: str | None = None) -> DataFrame:
    """Actual daily revenue as ``(date, value, type)``, in total or for one channel."""
    rows = daily if channel is None else daily.where(F.col("channel") == channel)
    return rows.groupBy(F.col("order_date").alias("date")).agg(
        sum_usd("total_revenue").alias("value")
    ).select("date", "value", F.lit("Actual").alias("type"))


def daily_revenue_range(
    orders: DataFrame, start: dt.date | str, end: dt.date | str, channels: Sequence[str] = ()
) -> DataFrame:
    """Daily revenue of a date range and channel set, filtered before the aggregate."""
    rows = orders.where(F.col("order_date").between(as_date(start), as_date(end)))
    return daily_revenue(rows.where(F.col("channel").isin(*channels)) if channels else rows)


def period_compare(orders: DataFrame, first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """Header indicators of two periods side by side, in one pass over the orders."""
    def inside(span: tuple[str, str]) -> Column:
        return F.col("order_date").between(as_date(span[0]), as_date(span[1]))

    a, b = inside(first), inside(second)
    sums = (
        orders.where(a | b)
        .groupBy("channel")
        .agg(
            F.count_if(a).alias("orders_a"),
            F.count_if(b).alias("orders_b"),
            F.coalesce(F.sum(F.when(a, cents("revenue"))), F.lit(0).cast("bigint")).alias("_a"),
            F.coalesce(F.sum(F.when(b, cents("revenue"))), F.lit(0).cast("bigint")).alias("_b"),
        )
    )
    return sums.select(
        "channel",
        "orders_a",
        "orders_b",
        (F.col("orders_b") - F.col("orders_a")).alias("orders_delta"),
        usd("_a").alias("revenue_a"),
        usd("_b").alias("revenue_b"),
        usd(F.col("_b") - F.col("_a")).alias("revenue_delta"),
        ratio((F.col("_b") - F.col("_a")) * 100, "_a", 1).alias("revenue_delta_pct"),
    )


def channel_funnel(spend: DataFrame, campaigns: DataFrame, orders: DataFrame) -> DataFrame:
    """Impressions, clicks, conversions and orders per sub-channel, with the rate of each step."""
    response = spend.groupBy("sub_channel").agg(
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.sum("conversions").alias("conversions"),
    )
    placed = (
        orders.groupBy("campaign_id").agg(F.count(F.lit(1)).alias("n"))
        .join(campaigns.select("campaign_id", "sub_channel"), "campaign_id")
        .groupBy("sub_channel").agg(F.sum("n").alias("orders"))
    )
    wide = response.join(placed, "sub_channel", "left").withColumn("orders", F.coalesce("orders", F.lit(0).cast("bigint")))
    stages = ("impressions", "clicks", "conversions", "orders")
    steps = F.array(*[
        F.struct(
            F.lit(i + 1).alias("step"),
            F.lit(stage).alias("stage"),
            F.col(stage).alias("n"),
            (ratio(F.col(stage) * 100, stages[i - 1], 2) if i else F.lit(None).cast("double")).alias("step_rate_pct"),
        )
        for i, stage in enumerate(stages)
    ])
    return wide.select("sub_channel", F.inline(steps))
