"""Zip-level opportunity scores and weather triggers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.functions.calendar import as_date
from martlens.functions.ladders import first_match
from martlens.functions.money import MEASURE_STEPS, cents, measure, ratio, steps, sum_cents, usd
from martlens.operators.enrich import PROFILE, one_profile_per_zip

# Map centre per state code and the default.
STATE_CENTRES = {
    "CA": (36.78, -119.42), "TX": (31.97, -99.90), "NY": (42.17, -74.95),
    "FL": (27.66, -81.52), "CO": (39.55, -105.78), "WA": (47.75, -120.74),
    "OR": (43.80, -120.55), "UT": (39.32, -111.09), "MT": (46.88, -110.36),
    "ID": (44.07, -114.74), "AZ": (34.05, -111.09), "NC": (35.76, -79.02),
    "VA": (37.43, -78.66), "GA": (32.16, -82.90), "PA": (41.20, -77.19),
    "IL": (40.63, -89.40), "OH": (40.42, -82.91), "MI": (44.31, -84.71),
    "MN": (46.73, -94.69), "WI": (43.78, -88.79), "MA": (42.41, -71.38),
    "NJ": (40.06, -74.41), "CT": (41.60, -72.76), "NH": (43.19, -71.57),
    "VT": (44.56, -72.58), "ME": (45.25, -69.45), "NM": (34.52, -105.87),
    "NV": (38.80, -116.42), "TN": (35.52, -86.58), "SC": (33.84, -81.16),
}
DEFAULT_CENTRE = (39.83, -98.58)

# Weather actions, first match wins.
TRIGGERS = (
    ("recent_total_snowfall", ">", 10, "BLIZZARD ALERT — Push winter gear promos"),
    ("recent_total_snowfall", ">", 5, "SNOW ADVISORY — Promote ski & outerwear"),
    ("recent_total_precip", ">", 5, "HEAVY RAIN — Promote waterproof footwear"),
    ("recent_total_precip", ">", 2, "RAIN ALERT — Promote rain gear & footwear"),
    ("recent_avg_temp", ">", 90, "HEAT WAVE — Promote cooling & hydration gear"),
    ("recent_avg_temp", ">", 80, "HOT WEATHER — Promote summer & camping gear"),
    ("recent_avg_temp", "<", 20, "EXTREME COLD — Promote insulated outerwear"),
    ("recent_avg_temp", "<", 35, "COLD SNAP — Promote layering & winter accessories"),
)
NO_TRIGGER = "NO TRIGGER"

# Product category to push by weather, and channel by size and value, first match wins.
WEATHER_CATEGORIES = (
    ("recent_total_snowfall", ">", 5, "winter_sports"),
    ("recent_avg_temp", ">", 75, "camping"),
    ("recent_avg_temp", "<", 40, "outerwear"),
    ("recent_total_precip", ">", 3, "footwear"),
)
OTHER_CATEGORY = "accessories"
CHANNELS = (("customer_count", ">=", 10, "social"), ("avg_ltv", ">", 1500, "email"))
OTHER_CHANNEL = "search"

# What a missing measure counts as.
MISSING = {"recent_avg_temp": 60.0, "recent_total_snowfall": 0.0, "recent_total_precip": 0.0, "avg_ltv": 0.0}


def _wide(whole: Column) -> Column:
    """A whole number that can be multiplied by row counts without overflow."""
    return whole.cast("decimal(38,0)")


def geo_targeting(
    customers: DataFrame,
    enrichment: DataFrame,
    orders: DataFrame,
    weather: DataFrame,
    as_of: dt.date,
    mode: str = "joined",
) -> DataFrame:
    """Customers, value, revenue, dominant segments and recent weather per zip.

    ``mode="joined"`` gives the figures of the four-way left join (customers,
    household records, orders, 31 days of weather) aggregated afterwards. In
    that join every branch repeats the rows of the others, so revenue counts
    once per household record and weather row of the zip, rain once per
    household record and order, and the mean value is weighted by orders. The
    pairs are never built: with E records, W weather rows and O order rows per
    customer (each at least 1, as a left join keeps its left row) the same sums
    are products of per-branch aggregates.

    ``mode="preaggregated"`` counts everything once.
    """
    if mode not in ("joined", "preaggregated"):
        raise ValueError(mode)
    one = F.lit(1).cast("bigint")
    per_customer = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_orders"), sum_cents("revenue").alias("_revenue")
    )
    order_rows = F.greatest(F.coalesce("_orders", one), one) if mode == "joined" else one
    base = (
        customers.select("customer_id", "state", "zip_code", "lifetime_value")
        .join(per_customer, "customer_id", "left")
        .groupBy("state", "zip_code")
        .agg(
            F.countDistinct("customer_id").alias("customer_count"),
            F.sum(_wide(cents("lifetime_value")) * order_rows).alias("_ltv"),
            F.sum(F.when(F.col("lifetime_value").isNotNull(), order_rows)).alias("_ltv_rows"),
            F.sum(order_rows).alias("_order_rows"),
            F.coalesce(F.sum("_revenue"), F.lit(0).cast("bigint")).alias("_revenue"),
        )
    )
    segments = one_profile_per_zip(enrichment)
    recent = (
        weather.where(F.col("weather_date") >= F.date_sub(as_date(as_of), 30))
        .groupBy("zip_code")
        .agg(
            F.count(F.lit(1)).alias("_w"),
            F.sum(steps("avg_temp_f")).alias("_temp"),
            F.count("avg_temp_f").alias("_temp_rows"),
            F.sum(steps("precipitation_in")).alias("_precip"),
            F.sum(steps("snowfall_in")).alias("_snow"),
        )
    )
    e, w = (F.coalesce("zip_records", one), F.coalesce("_w", one)) if mode == "joined" else (one, one)
    o = F.col("_order_rows") if mode == "joined" else one
    return (
        base.join(segments, "zip_code", "left")
        .join(recent, "zip_code", "left")
        .select(
            "state",
            "zip_code",
            "customer_count",
            ratio("_ltv", F.col("_ltv_rows") * 100, 2).alias("avg_ltv"),
            usd(_wide(F.col("_revenue")) * e * w).alias("total_revenue"),
            *[F.col(p).alias(f"dominant_{n}") for p, n in zip(PROFILE, ("income_bracket", "lifestyle", "outdoor_interest"))],
            ratio("_temp", F.col("_temp_rows") * F.lit(MEASURE_STEPS), 1).alias("recent_avg_temp"),
            measure(_wide(F.col("_precip")) * e * o, 2).alias("recent_total_precip"),
            measure(_wide(F.col("_snow")) * e * o, 2).alias("recent_total_snowfall"),
        )
    )


def geo_profiles(targeting: DataFrame) -> DataFrame:
    """Opportunity score 0.4 value, 0.3 density, 0.3 revenue share, and recommendations."""
    top = targeting.agg(F.max("total_revenue")).scalar()
    revenue_share = F.try_divide(F.coalesce("total_revenue", F.lit(0.0)), top)
    score = (
        F.coalesce("avg_ltv", F.lit(0.0)) / F.lit(3000.0) * F.lit(0.4)
        + F.least(F.col("customer_count"), F.lit(100)) / F.lit(100.0) * F.lit(0.3)
        + revenue_share * F.lit(0.3)
    )
    return targeting.select(
        *targeting.columns,
        F.round(score, 3).alias("targeting_score"),
        first_match(WEATHER_CATEGORIES, OTHER_CATEGORY, MISSING).alias("weather_recommended_category"),
        first_match(CHANNELS, OTHER_CHANNEL, MISSING).alias("recommended_channel"),
    )


def geo_triggers(targeting: DataFrame) -> DataFrame:
    """First matching weather action of each zip."""
    return targeting.select(
        "state", "zip_code", "customer_count", "recent_avg_temp", "recent_total_precip", "recent_total_snowfall",
        first_match(TRIGGERS, NO_TRIGGER, MISSING).alias("trigger_action"),
    )


def trigger_counts(triggers: DataFrame) -> DataFrame:
    return (
        triggers.where(F.col("trigger_action") != NO_TRIGGER)
        .groupBy("trigger_action")
        .agg(F.count(F.lit(1)).alias("zip_count"))
    )


def geo_state_rollup(profiles: DataFrame) -> DataFrame:
    mills = F.rint(F.col("targeting_score") * 1000).cast("bigint")
    return profiles.groupBy("state").agg(
        F.sum("customer_count").alias("customer_count"),
        ratio(sum_cents("avg_ltv"), F.count("avg_ltv") * 100, 2).alias("avg_ltv"),
        usd(sum_cents("total_revenue")).alias("total_revenue"),
        ratio(F.sum(mills), F.count(mills) * 1000, 3).alias("targeting_score"),
    )


def top_states(rollup: DataFrame, n: int = 20) -> DataFrame:
    return rollup.orderBy(F.desc("total_revenue"), F.asc("state")).limit(n)


def geo_map_points(rollup: DataFrame, centres: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """State bubbles: position with a default, radius by revenue, colour by score."""
    places = STATE_CENTRES if centres is None else centres
    lookup = F.create_map(*[
        F.lit(x) for code, (lat, lon) in places.items() for x in (code, F.array(F.lit(lat), F.lit(lon)))
    ])
    spot = F.coalesce(F.try_element_at(lookup, F.col("state")), F.array(*[F.lit(x) for x in DEFAULT_CENTRE]))
    radius = F.try_divide(F.col("total_revenue"), rollup.agg(F.max("total_revenue")).scalar()) * 120000
    return rollup.select(
        *rollup.columns,
        F.get(spot, F.lit(0)).alias("lat"),
        F.get(spot, F.lit(1)).alias("lon"),
        F.greatest(F.lit(8000), radius.cast("int")).alias("radius"),
        F.least(F.lit(255), (F.col("targeting_score") * 500).cast("int")).alias("color_r"),
        F.greatest(F.lit(0), (F.lit(180) - F.col("targeting_score") * 300).cast("int")).alias("color_g"),
        F.lit(60).alias("color_b"),
    )
