"""Multi-touch attribution: which sub-channels earn the revenue of an order.

A touch is a sub-channel with converting spend in the days up to the order.
With ``scope="global"`` touches depend on the order day alone. They are worked
out once per day on the aggregated spend (days x sub-channels rows), including
sequence, count and every model's weight, and the orders then only look up
their day: no band join, no window over orders and no shuffle of orders.
With ``scope="customer"`` the same table is keyed by customer and day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlens.functions.money import cents, ratio, sum_cents, sum_usd, usd

MODELS = ("first_touch", "last_touch", "linear", "time_decay", "position_based")
ORDER_COLUMNS = ("customer_id", "order_id", "order_date", "revenue")
SINGLE_TOUCH = ("first_touch", "last_touch")


def converting_days(
    spend: DataFrame, campaigns: DataFrame, by_customer: bool = False
) -> DataFrame:
    """Spend with conversions per day and sub-channel (and customer).

    Spend is reduced to campaign and day before the campaign join.
    """
    key = ["customer_id"] if by_customer else []
    per_campaign = (
        spend.where(F.col("conversions") > 0)
        .groupBy(*key, "campaign_id", F.col("spend_date").alias("day"))
        .agg(sum_cents("amount").alias("_spend"))
    )
    return (
        per_campaign.join(campaigns.select("campaign_id", "sub_channel"), "campaign_id")
        .groupBy(*key, "day", "sub_channel")
        .agg(F.sum("_spend").alias("_spend"))
    )


def _touch_array(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key: touches in sequence order, with position and total.

    An array holds at most one entry per sub-channel.
    """
    listed = rows.groupBy(*key).agg(
        F.sort_array(F.collect_list(F.struct("first_touch_date", "sub_channel", "last_touch_date", "_spend"))).alias("_t")
    )
    total = F.size("_t")
    numbered = F.transform(
        F.col("_t"),
        lambda t, i: F.struct(
            t["sub_channel"].alias("sub_channel"),
            t["first_touch_date"].alias("first_touch_date"),
            t["last_touch_date"].alias("last_touch_date"),
            usd(t["_spend"]).alias("channel_spend"),
            F.datediff(F.col("order_date"), t["first_touch_date"]).alias("days_to_conversion"),
            (i + 1).alias("touchpoint_sequence"),
            total.alias("total_touchpoints"),
        ),
    )
    return listed.select(*key, numbered.alias("touches"))


def touches_by_day(spend: DataFrame, campaigns: DataFrame, window_days: int = 30) -> DataFrame:
    """The touches of an order placed on ``order_date``, for every day that has any.

    Each spend day is projected onto the order days it can reach, so the band
    condition becomes an aggregate over (order day, sub-channel).
    """
    reach = F.sequence(F.col("day"), F.date_add("day", window_days))
    reached = (
        converting_days(spend, campaigns)
        .withColumn("order_date", F.explode(reach))
        .groupBy("order_date", "sub_channel")
        .agg(
            F.min("day").alias("first_touch_date"),
            F.max("day").alias("last_touch_date"),
            F.sum("_spend").alias("_spend"),
        )
    )
    return _touch_array(reached, ["order_date"])


def touches_by_customer_day(
    order_days: DataFrame, spend: DataFrame, campaigns: DataFrame, window_days: int = 30
) -> DataFrame:
    """The customer's own touches for every day on which that customer ordered.

    ``order_days`` has one row per customer and order day. Spend days and order
    days of a customer are reduced to one row per day and
    sub-channel first, so a window partition is bounded by the calendar even
    for a customer with a third of all rows.
    """
    spent = converting_days(spend, campaigns, by_customer=True).select(
        "customer_id", "day", "sub_channel", "_spend", F.lit(False).alias("_order")
    )
    ordered = order_days.select(
        "customer_id", F.col("order_date").alias("day"), F.lit(None).cast("string").alias("sub_channel"),
        F.lit(None).cast("bigint").alias("_spend"), F.lit(True).alias("_order"),
    )
    # one shuffle by customer serves all three steps: an order day is repeated for each of
    # the customer's sub-channels, then looks back over the spend days of that sub-channel
    known = F.collect_set("sub_channel").over(Window.partitionBy("customer_id"))
    probes = F.when(F.col("_order"), F.col("_known")).otherwise(F.array("sub_channel"))
    span = (
        Window.partitionBy("customer_id", "sub_channel").orderBy(F.unix_date("day")).rangeBetween(-window_days, 0)
    )
    touch_day = F.when(~F.col("_order"), F.col("day"))
    reached = (
        spent.unionByName(ordered)
        .withColumn("_known", known)
        .select("customer_id", "day", "_spend", "_order", F.explode_outer(probes).alias("sub_channel"))
        .select(
            "customer_id", "sub_channel", "day", "_order",
            F.min(touch_day).over(span).alias("first_touch_date"),
            F.max(touch_day).over(span).alias("last_touch_date"),
            F.sum("_spend").over(span).alias("_spend"),
        )
        .where(F.col("_order") & F.col("first_touch_date").isNotNull())
        .withColumnRenamed("day", "order_date")
    )
    return _touch_array(reached, ["customer_id", "order_date"])


def conversions_with_touches(
    orders: DataFrame, spend: DataFrame, campaigns: DataFrame, window_days: int = 30, scope: str = "global"
) -> DataFrame:
    """One row per order that has touches, with the touch array."""
    rows = orders.select(*ORDER_COLUMNS)
    if scope == "global":
        days = touches_by_day(spend, campaigns, window_days)
        return rows.join(days, "order_date")
    if scope == "customer":
        key = ["customer_id", "order_date"]
        counts = orders.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        own = touches_by_customer_day(counts, spend, campaigns, window_days)
        return rows.join(own, key)
    raise ValueError(scope)


def mta_touchpoints(
    orders: DataFrame, spend: DataFrame, campaigns: DataFrame, window_days: int = 30, scope: str = "global"
) -> DataFrame:
    """One row per order and touching sub-channel."""
    return conversions_with_touches(orders, spend, campaigns, window_days, scope).select(
        "customer_id",
        F.col("order_id").alias("conversion_id"),
        F.col("order_date").alias("conversion_date"),
        "revenue",
        F.inline("touches"),
    )


def mta_journeys(conversions: DataFrame, path: str = "alphabetical") -> DataFrame:
    """Journey facts of each order, read from its touch array without a shuffle.

    ``path="alphabetical"`` lists the sub-channels by name, ``"sequence"`` in
    order of first contact.
    """
    names = F.transform("touches", lambda t: t["sub_channel"])
    ordered = names if path == "sequence" else F.sort_array(names)
    first = F.array_min(F.transform("touches", lambda t: t["first_touch_date"]))
    return conversions.select(
        "customer_id",
        F.col("order_id").alias("conversion_id"),
        "revenue",
        first.alias("first_touch_date"),
        F.array_max(F.transform("touches", lambda t: t["last_touch_date"])).alias("last_touch_date"),
        F.col("order_date").alias("conversion_date"),
        F.size("touches").alias("total_touchpoints"),
        F.datediff("order_date", first).alias("journey_duration_days"),
        F.array_join(ordered, " > ").alias("channel_path"),
    )


#: Shares of whole cents this close to a half are halves: far above the error of a double, far below what shares differ by.
HALF = 0.5 + 1e-6


def _decay(touch: Column) -> Column:
    return F.lit(1.0) / (touch["days_to_conversion"] + 1)


def decay_total() -> Column:
    """Sum of the decay weights of an order's touches, in their sequence; worked out once per order."""
    return F.aggregate("touches", F.lit(0.0), lambda total, t: total + _decay(t))


def _half_up(amount: Column, touch: Column) -> Column:
    """A touch's decay share of a whole amount, rounded half away from zero."""
    return F.signum(amount) * F.floor(F.abs(amount) * _decay(touch) / F.col("_decay") + HALF)


def _with_decay(conversions: DataFrame, models: Sequence[str]) -> DataFrame:
    return conversions.withColumn("_decay", decay_total()) if "time_decay" in models else conversions


def _credit(model: str, touch: Column, revenue: Column) -> tuple[Column, Column]:
    """Credit in money and weight of one touch under one model; time decay reads the order's total from ``_decay``."""
    seq, n = touch["touchpoint_sequence"], touch["total_touchpoints"]
    c = cents(revenue).cast("double")
    if model in SINGLE_TOUCH:
        chosen = seq == (F.lit(1) if model == "first_touch" else n)
        return F.when(chosen, revenue).otherwise(F.lit(0.0)), F.when(chosen, F.lit(1.0)).otherwise(F.lit(0.0))
    if model == "linear":
        return ratio(c, n * 100, 2), ratio(F.lit(1.0), n, 4)
    if model == "time_decay":
        return _half_up(c, touch) / 100, _half_up(F.lit(10_000.0), touch) / 10_000
    if model == "position_based":
        # whole tenths of the credit, so that the division is made once
        edge = (seq == 1) | (seq == n)
        tenths = F.when(n == 1, 10).when(n == 2, 5).when(edge, 4).otherwise(2)
        share = F.when((n <= 2) | edge, F.lit(1)).otherwise(n - 2)
        return ratio(c * tenths, share * 1000, 2), ratio(tenths, share * 10, 4)
    raise ValueError(model)


def credits(conversions: DataFrame, models: Sequence[str] = MODELS) -> DataFrame:
    """Credit of every touch under each model: one pass over the orders, no shuffle."""
    touch = F.col("_t")
    rows = []
    for model in models:
        amount, weight = _credit(model, touch, F.col("revenue"))
        rows.append(F.struct(
            amount.alias("attributed_revenue"), weight.alias("attribution_weight"), F.lit(model).alias("model_name")
        ))
    return _with_decay(conversions, models).withColumn("_t", F.explode("touches")).select(
        F.col("order_id").alias("conversion_id"),
        "customer_id",
        touch["sub_channel"].alias("sub_channel"),
        touch["touchpoint_sequence"].alias("touchpoint_sequence"),
        touch["total_touchpoints"].alias("total_touchpoints"),
        "revenue",
        touch["days_to_conversion"].alias("days_to_conversion"),
        F.inline(F.array(*rows)),
    )


def attribution(conversions: DataFrame, model: str) -> DataFrame:
    """One attribution model, one row per touch."""
    return credits(conversions, [model])


def attr_summary(conversions: DataFrame) -> DataFrame:
    """Credit and distinct converted orders per sub-channel and model.

    Touches are reduced to a row per sub-channel and order first, so an order id that occurs
    twice counts once and a busy sub-channel is spread over its orders; the models are columns
    and become rows only in the small result.
    """
    touch = F.col("_t")
    touched = _with_decay(conversions, MODELS).select("order_id", "revenue", "_decay", F.explode("touches").alias("_t"))
    per_order, sums, rows = [], [], []
    for model in MODELS:
        amount, _ = _credit(model, touch, F.col("revenue"))
        # zero credits are dropped for the single-touch models only
        kept = amount > 0 if model in SINGLE_TOUCH else F.lit(True)
        per_order += [F.sum(F.when(kept, cents(amount))).alias(f"_{model}_c"), F.max(kept).alias(f"_{model}_k")]
        sums += [
            F.sum(f"_{model}_c").alias(f"_{model}_c"),
            F.count_if(F.col(f"_{model}_k") & F.col("order_id").isNotNull()).alias(f"_{model}_n"),
        ]
        rows.append(F.struct(
            F.lit(model).alias("model_name"),
            usd(f"_{model}_c").alias("total_attributed_revenue"),
            F.col(f"_{model}_n").alias("conversions_attributed"),
        ))
    orders = touched.groupBy(touch["sub_channel"].alias("sub_channel"), "order_id").agg(*per_order)
    return (
        orders.groupBy("sub_channel").agg(*sums)
        .select("sub_channel", F.inline(F.array(*rows)))
        .where(F.col("conversions_attributed") > 0)
    )


def attr_consensus(summary: DataFrame) -> DataFrame:
    """Mean rank of each sub-channel over the models (tied ranks averaged, then cut to a whole)."""
    by_credit = Window.partitionBy("model_name").orderBy(F.desc("total_attributed_revenue"))
    peers = Window.partitionBy("model_name", "total_attributed_revenue")
    rank = F.floor(F.rank().over(by_credit) + (F.count(F.lit(1)).over(peers) - 1) / 2)
    return (
        summary.withColumn("_rank", rank)
        .groupBy("sub_channel")
        .agg(
            ratio(F.sum("_rank"), F.count(F.lit(1)), 1).alias("avg_rank"),
            sum_usd("total_attributed_revenue").alias("total_rev_all_models"),
        )
    )


def journey_kpis(journeys: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return journeys.agg(
        n.alias("total_conversions"),
        ratio(F.sum("total_touchpoints"), n, 1).alias("avg_touchpoints"),
        ratio(F.sum("journey_duration_days"), n, 1).alias("avg_journey_days"),
    )
