"""Marketing-mix model: weekly revenue shared out by spend and conversion efficiency.

A channel's weight in a week is its spend share times (1 + conversions per
currency unit spent). That product equals (spend + conversions) divided by the
week's spend, so the normalised weight is a quotient of whole numbers and the
credit is exact up to the final rounding.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlens.functions.calendar import dow0, is_weekend, month_start, quarter_label, week_start
from martlens.functions.money import cents, ratio, sum_cents, sum_usd, usd

# Target return on spend per sub-channel, and overall.
ROAS_TARGETS = {
    "email": 35.0, "search": 35.0, "social": 30.0, "influencer": 35.0,
    "co_op_ad": 35.0, "trade_promo": 30.0, "distributor_event": 20.0,
}
ROAS_TARGET_OVERALL = 35.0

# The measures a target can be set for, the column that holds them, and whether more is better.
TARGET_MEASURES = {
    "roas": ("roi", True), "cpa": ("cost_per_conversion", False),
    "conversions": ("conversions", True), "share": ("share_of_spend", True),
}


def mmm_daily(daily_spend: DataFrame, daily: DataFrame, indicators: DataFrame, national: DataFrame) -> DataFrame:
    """Daily feature table: spend, revenue of the day, monthly indicators, weather, date parts."""
    revenue = daily.groupBy(F.col("order_date").alias("ds")).agg(sum_usd("total_revenue").alias("daily_revenue"))
    signals = [c for c in indicators.columns if c != "indicator_month"]
    return (
        daily_spend.join(revenue, "ds", "left")
        .withColumn("indicator_month", month_start("ds"))
        .join(indicators, "indicator_month", "left")
        .join(national.withColumnRenamed("weather_date", "ds"), "ds", "left")
        .select(
            F.col("ds").alias("dt"),
            "channel",
            "sub_channel",
            "total_spend",
            "total_impressions",
            "total_clicks",
            "total_conversions",
            "conversion_rate_pct",
            "daily_revenue",
            *signals,
            "national_avg_temp_f",
            "national_precipitation_in",
            "national_snowfall_in",
            dow0("ds").alias("dow"),
            F.month("ds").alias("month_num"),
            is_weekend("ds").alias("is_weekend"),
        )
    )


def mmm_weighted(daily_spend: DataFrame, daily: DataFrame) -> DataFrame:
    """Weekly spend and conversions per sub-channel with the week's revenue and weights."""
    weekly_spend = daily_spend.groupBy(week_start("ds").alias("week_start"), "sub_channel").agg(
        sum_cents("total_spend").alias("_spend"), F.sum("total_conversions").alias("conversions")
    )
    weekly_revenue = daily.groupBy(week_start("order_date").alias("week_start")).agg(
        sum_cents("total_revenue").alias("_revenue")
    )
    pull = F.when(F.col("_spend") > 0, F.col("_spend") + 100 * F.coalesce("conversions", F.lit(0).cast("bigint")))
    return (
        weekly_spend.join(weekly_revenue, "week_start")
        .withColumn("_pull", F.coalesce(pull, F.lit(0).cast("bigint")))
        .withColumn("_pull_all", F.sum("_pull").over(Window.partitionBy("week_start")))
        .withColumn(
            "_credit",
            ratio(F.col("_revenue").cast("double") * F.col("_pull"), "_pull_all"),
        )
    )


def mmm_weekly(weighted: DataFrame) -> DataFrame:
    """Spend, attributed and incremental revenue and efficiency per week and sub-channel."""
    return weighted.select(
        "week_start",
        "sub_channel",
        usd("_spend").alias("spend"),
        F.round(F.col("_credit") / 100, 2).alias("attributed_revenue"),
        F.round((F.col("_credit") - F.col("_spend")) / 100, 2).alias("incremental_revenue"),
        ratio("_credit", "_spend", 3).alias("efficiency_index"),
    )


def mmm_contributions(weighted: DataFrame) -> DataFrame:
    """Quarterly contribution, return, spend share and cost per conversion per sub-channel."""
    quarterly = (
        weighted.groupBy("sub_channel", quarter_label("week_start").alias("period"))
        .agg(
            F.sum("_spend").alias("_spend"),
            F.sum(cents(F.round(F.col("_credit") / 100, 2))).alias("_revenue"),
            F.sum("conversions").alias("_conversions"),
        )
        .withColumn("_spend_all", F.sum("_spend").over(Window.partitionBy("period")))
    )
    return quarterly.select(
        "sub_channel",
        "period",
        usd("_spend").alias("total_spend"),
        usd("_revenue").alias("attributed_revenue"),
        ratio("_revenue", "_spend", 2).alias("roi"),
        ratio(F.col("_spend") * 100, "_spend_all", 1).alias("share_of_spend"),
        ratio("_spend", F.col("_conversions") * 100, 2).alias("cost_per_conversion"),
    )


def mmm_channel_summary(contributions: DataFrame) -> DataFrame:
    spent, earned = sum_cents("total_spend"), sum_cents("attributed_revenue")
    return contributions.groupBy("sub_channel").agg(
        ratio(spent, F.lit(100), 0).alias("total_spend"),
        ratio(earned, F.lit(100), 0).alias("total_attributed"),
        ratio(earned, spent, 2).alias("overall_roi"),
    )


def mmm_efficiency_trend(weekly: DataFrame, channels: Sequence[str] = ()) -> DataFrame:
    """Mean efficiency per week over the chosen sub-channels."""
    rows = weekly.where(F.col("sub_channel").isin(*channels)) if channels else weekly
    mills = F.rint(F.col("efficiency_index") * 1000).cast("bigint")
    return rows.groupBy("week_start").agg(ratio(F.sum(mills), F.count(mills) * 1000, 4).alias("efficiency_index"))


def roas_vs_target(contributions: DataFrame, targets: Mapping[str, float] | None = None) -> DataFrame:
    """Return against the channel's target; without a target the status is below."""
    wanted = ROAS_TARGETS if targets is None else targets
    table = contributions.sparkSession.createDataFrame(
        list(wanted.items()), "sub_channel string, target_roas double"
    )
    delta = F.round(F.col("roi") - F.col("target_roas"), 2)
    return contributions.join(table, "sub_channel", "left").select(
        "sub_channel",
        "period",
        "roi",
        "target_roas",
        delta.alias("delta"),
        F.when(delta >= 0, "Above Target").otherwise("Below Target").alias("status"),
    )


def contributions_of(contributions: DataFrame, periods: Sequence[str] = (), channels: Sequence[str] = ()) -> DataFrame:
    """Contributions of chosen quarters and sub-channels; an empty choice keeps all."""
    rows = contributions.where(F.col("period").isin(*periods)) if periods else contributions
    return rows.where(F.col("sub_channel").isin(*channels)) if channels else rows


def channel_targets(spark: SparkSession, targets: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """The targets table: one row per sub-channel and measure (``TARGET_MEASURES``), to be stored."""
    rows = [(channel, measure, float(value)) for channel, by in targets.items() for measure, value in by.items()]
    unknown = {m for _, m, _ in rows} - set(TARGET_MEASURES)
    if unknown:
        raise ValueError(f"no such measure: {sorted(unknown)}")
    return spark.createDataFrame(rows, "sub_channel string, measure string, target double")


def measures_vs_targets(contributions: DataFrame, daily_spend: DataFrame, targets: DataFrame) -> DataFrame:
    """Every target with what the sub-channel reached in each quarter and whether that is good enough.

    Returns, shares and conversions are to be reached, costs per conversion not to be exceeded. A
    quarter holds whole weeks, as in the contributions. Without a value the status is null.
    """
    converted = daily_spend.groupBy("sub_channel", quarter_label(week_start("ds")).alias("period")).agg(
        F.sum("total_conversions").cast("double").alias("conversions"))
    reached = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(c).alias("value")) for m, (c, _) in TARGET_MEASURES.items()])
    long = contributions.join(converted, ["sub_channel", "period"], "left").select("sub_channel", "period", F.inline(reached))
    ceilings = [m for m, (_, above) in TARGET_MEASURES.items() if not above]
    gap = F.round(F.col("value") - F.col("target"), 2)
    good = F.when(F.col("measure").isin(*ceilings), gap <= 0).otherwise(gap >= 0)
    return long.join(targets, ["sub_channel", "measure"]).select(
        "sub_channel", "period", "measure", "value", "target", gap.alias("delta"), good.alias("on_target"))


def mmm_insight_text(summary: DataFrame) -> DataFrame:
    """One row of text: every channel by return, the best and the worst.

    The list holds one entry per sub-channel.
    """
    line = F.concat(
        F.col("sub_channel"), F.lit(" turned $"), F.col("total_spend").cast("bigint").cast("string"),
        F.lit(" into $"), F.col("total_attributed").cast("bigint").cast("string"),
        F.when(F.col("overall_roi").isNull(), "").otherwise(F.format_string(" (%.2f per dollar)", "overall_roi")),
    )
    ranked = F.sort_array(F.collect_list(F.struct(
        (-F.coalesce("overall_roi", F.lit(-1e300))).alias("k"), F.col("sub_channel").alias("name"), line.alias("line")
    )))
    return summary.agg(ranked.alias("_r")).select(
        F.concat(
            F.array_join(F.transform("_r", lambda r: r["line"]), ", "),
            F.lit("; ahead is "), F.element_at("_r", 1)["name"],
            F.lit(", behind is "), F.element_at("_r", -1)["name"],
        ).alias("insight_text")
    )
