"""Outside signals and the enriched customer profile."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.functions.calendar import as_date, month_boundaries, month_start
from martlens.functions.ladders import first_flag, first_match
from martlens.functions.money import avg_measure, cents, measure, ratio, steps, sum_cents, sum_measure, sum_usd, usd

PROFILE = ("income_bracket", "lifestyle_segment", "outdoor_interest")

# Segment labels and the lifestyle flags that lead to them, first match wins.
LIFESTYLES = (
    ("Travel Enthusiast", ("travel", "travel_domestic")),
    ("Health & Fitness", ("health_fitness", "exercise_health_grouping")),
    ("Outdoor Adventurer", ("outdoor", "outdoor_sport_recreation")),
    ("Sports Fan", ("sports_grouping", "sports_and_leisure")),
    ("Home & Garden", ("home_and_garden", "home_improvement")),
)
NO_LIFESTYLE = "General Consumer"
OUTDOOR_INTERESTS = (
    ("Camping/Hiking", ("camping_hiking",)),
    ("Hunting/Fishing", ("hunting_shooting", "fishing")),
    ("Snow Sports", ("snow_skiing",)),
    ("General Outdoor", ("outdoor", "outdoor_sport_recreation")),
)
NO_INTEREST = "None Identified"

# Temperature bands, age groups and value tiers, first match wins.
TEMPERATURE_BANDS = (
    ("national_avg_temp_f", "<", 32, "freezing"),
    ("national_avg_temp_f", "<", 50, "cold"),
    ("national_avg_temp_f", "<", 70, "mild"),
    ("national_avg_temp_f", "<", 85, "warm"),
)
HOTTEST = "hot"
AGE_GROUPS = ((18, 24), (25, 34), (35, 44), (45, 54))
OTHER_AGES = "55+"
VALUE_TIERS = (("lifetime_value", ">=", 2000, "high_value"), ("lifetime_value", ">=", 500, "mid_value"))
LOWEST_TIER = "low_value"


def indicator_pivot(
    series: DataFrame, variables: Mapping[str, str], geo_id: str, since: dt.date | str
) -> DataFrame:
    """Entity-attribute-value rows to one row per month, one column per variable (the maximum)."""
    return (
        series.where(
            (F.col("geo_id") == geo_id)
            & (F.col("date") >= as_date(since))
            & F.col("variable").isin(*variables)
        )
        .groupBy(month_start("date").alias("indicator_month"))
        .agg(*[F.max(F.when(F.col("variable") == code, F.col("value"))).alias(name) for code, name in variables.items()])
    )


def segment_ladder(records: DataFrame) -> DataFrame:
    """Zip code, income bracket and the two first-match segments of each household record."""
    return records.select(
        F.substring(F.trim("zip"), 1, 5).alias("zip_code"),
        F.col("estimated_household_income").alias("income_bracket"),
        first_flag(LIFESTYLES, NO_LIFESTYLE).alias("lifestyle_segment"),
        first_flag(OUTDOOR_INTERESTS, NO_INTEREST).alias("outdoor_interest"),
    )


def profile_counts(enrichment: DataFrame) -> DataFrame:
    """Distinct profiles of each zip and how many records share each.

    A plain hash aggregate that takes the household records down to a number of
    rows bounded by zips times income brackets times segment labels. Everything
    else about a zip is derived from it.
    """
    return enrichment.groupBy("zip_code", *PROFILE).agg(F.count(F.lit(1)).alias("profile_rows"))


def zip_profiles(enrichment: DataFrame) -> DataFrame:
    """One row per zip with the list of its distinct profiles."""
    return profile_counts(enrichment).groupBy("zip_code").agg(
        F.collect_list(F.struct(*PROFILE, "profile_rows")).alias("_profiles")
    )


def one_profile_per_zip(enrichment: DataFrame, counted: str | None = None) -> DataFrame:
    """The most frequent value of each attribute per zip (ties: the lowest), and the record count.

    ``counted`` names a column that says how many records a row stands for.
    """
    values = F.array(*[F.struct(F.lit(p).alias("attribute"), F.col(p).alias("value")) for p in PROFILE])
    profiles = enrichment.withColumn("profile_rows", F.col(counted)) if counted else profile_counts(enrichment)
    votes = (
        profiles
        .select("zip_code", "profile_rows", F.inline(values))
        .groupBy("zip_code", "attribute", "value")
        .agg(F.sum("profile_rows").alias("n"))
    )

    def dominant(name: str) -> Column:
        mine = (F.col("attribute") == name) & F.col("value").isNotNull()
        return F.min_by("value", F.when(mine, F.struct(-F.col("n"), F.col("value"))))

    return votes.groupBy("zip_code").agg(
        *[dominant(p).alias(p) for p in PROFILE],
        F.sum(F.when(F.col("attribute") == PROFILE[0], F.col("n"))).alias("zip_records"),
    )


def survey_weighted(
    responses: DataFrame,
    labels: DataFrame,
    market: str = "usa",
    since_year: int = 2021,
    topics: Sequence[str] = ("Demographics", "Media Consumption", "Attitudes"),
    approximate: bool = False,
) -> DataFrame:
    """Distinct respondents and weighted population per answer.

    Labels are looked up on the rows as scanned, then one shuffle reduces them to
    a row per answer and respondent, so a question that everybody answers is
    spread over its respondents; the last aggregate moves only partial counts.
    ``approximate`` replaces the exact distinct count by a mergeable sketch.
    """
    codes = ["namespace_code", "question_code", "datapoint_code"]
    answer = [
        F.col("release_year").alias("survey_year"),
        F.col("market_code").alias("country"),
        F.col("category_1").alias("category"),
        F.col("question_name").alias("metric"),
        F.col("datapoint_name").alias("response"),
    ]
    kept = responses.where((F.col("market_code") == market) & (F.col("release_year") >= since_year))
    wanted = labels.where(F.col("category_2").isin(*topics))
    if approximate:
        # sketches merge, so the label join may follow a pure code-level aggregate
        per_code = kept.groupBy("release_year", "market_code", *codes).agg(
            F.hll_sketch_agg("respondent_code", 14).alias("_who"), F.sum(steps("respondent_weight")).alias("_weight")
        )
        return per_code.join(wanted, codes).groupBy(*answer).agg(
            F.hll_sketch_estimate(F.hll_union_agg("_who")).alias("respondent_count"),
            measure(F.sum("_weight"), 2).alias("weighted_population"),
        )
    labelled = kept.join(wanted, codes)
    names = ["survey_year", "country", "category", "metric", "response"]
    per_answer = labelled.groupBy(*answer, "respondent_code").agg(F.sum(steps("respondent_weight")).alias("_weight"))
    return per_answer.groupBy(*names).agg(
        F.count("respondent_code").alias("respondent_count"),
        measure(F.sum("_weight"), 2).alias("weighted_population"),
    )


def daily_weather(history: DataFrame, since: dt.date | str, country: str = "US") -> DataFrame:
    return history.where((F.col("date_valid_std") >= as_date(since)) & (F.col("country") == country)).select(
        F.to_date("date_valid_std").alias("weather_date"),
        F.substring(F.col("postal_code").cast("string"), 1, 5).alias("zip_code"),
        F.col("avg_temperature_air_2m_f").cast("double").alias("avg_temp_f"),
        F.col("tot_precipitation_in").cast("double").alias("precipitation_in"),
        F.col("tot_snowfall_in").cast("double").alias("snowfall_in"),
    )


def national_daily_signal(weather: DataFrame) -> DataFrame:
    """National mean temperature and summed precipitation and snowfall per day."""
    return weather.groupBy("weather_date").agg(
        avg_measure("avg_temp_f", 1).alias("national_avg_temp_f"),
        sum_measure("precipitation_in").alias("national_precipitation_in"),
        sum_measure("snowfall_in").alias("national_snowfall_in"),
    )


def weather_revenue(daily: DataFrame, national: DataFrame) -> DataFrame:
    """Daily revenue with the weather of the day.

    A day without weather falls through the ladder to 'hot' and is neither
    rainy nor snowy, which is the defined behaviour.
    """
    return daily.join(national, daily["order_date"] == national["weather_date"], "left").select(
        *[daily[c] for c in daily.columns],
        "national_avg_temp_f",
        "national_precipitation_in",
        "national_snowfall_in",
        first_match(TEMPERATURE_BANDS, HOTTEST).alias("temp_band"),
        F.coalesce(F.col("national_precipitation_in") > 0.5, F.lit(False)).alias("rainy_day"),
        F.coalesce(F.col("national_snowfall_in") > 1.0, F.lit(False)).alias("snow_day"),
    )


def weather_band_avg(revenue_by_weather: DataFrame) -> DataFrame:
    return (
        revenue_by_weather.where(F.col("temp_band").isNotNull())
        .groupBy("temp_band")
        .agg(ratio(sum_cents("total_revenue"), F.count("total_revenue") * 100, 2).alias("avg_rev"))
    )


def customer_orders(orders: DataFrame) -> DataFrame:
    """Order history of each customer.

    Spark plans the distinct count as a hash aggregate by customer and category
    that carries the other sums along, then one by customer.
    """
    return orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        sum_cents("revenue").alias("_revenue"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.countDistinct("product_category").alias("distinct_categories"),
    )


def customer_enriched(
    customers: DataFrame,
    enrichment: DataFrame,
    orders: DataFrame,
    as_of: dt.date,
    profiles: str = "weighted",
) -> DataFrame:
    """Customer profile with demographics, order history, tenure, recency and frequency.

    ``profiles`` decides what happens when a zip has several household records:

    * ``"weighted"``: one row per customer and distinct profile, with the number of equal
      records in ``profile_rows``, by which every aggregate counts;
    * ``"one"``: exactly one row per customer;
    * ``"all"``: one row per customer and record, as an equi join by zip gives. The rows grow
      with the product of a zip's customers and records, so no table or query uses it.
    """
    age_group = F.lit(OTHER_AGES)
    for low, high in reversed(AGE_GROUPS):
        age_group = F.when(F.col("age").between(low, high), f"{low}-{high}").otherwise(age_group)
    known = customers.join(customer_orders(orders), "customer_id", "left")
    side = one_profile_per_zip(enrichment) if profiles == "one" else zip_profiles(enrichment)
    joined = known.join(side, "zip_code", "left")
    extra: list[Column] = []
    if profiles != "one":
        joined = joined.select(*known.columns, F.inline_outer("_profiles"))
    if profiles == "all":
        copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.coalesce("profile_rows", F.lit(1).cast("bigint"))))
        joined = joined.withColumn("_copy", copies)
    elif profiles == "weighted":
        extra = [F.coalesce("profile_rows", F.lit(1).cast("bigint")).alias("profile_rows")]
    months = month_boundaries("first_order_date", "last_order_date")
    return joined.select(
        "customer_id",
        "state",
        "zip_code",
        "age",
        "gender",
        "channel_preference",
        "lifetime_value",
        "signup_date",
        age_group.alias("age_group"),
        first_match(VALUE_TIERS, LOWEST_TIER).alias("value_tier"),
        *PROFILE,
        "total_orders",
        usd("_revenue").alias("total_revenue"),
        "first_order_date",
        "last_order_date",
        "distinct_categories",
        F.datediff("last_order_date", "signup_date").alias("customer_tenure_days"),
        F.datediff(as_date(as_of), "last_order_date").alias("days_since_last_order"),
        ratio("_revenue", F.col("total_orders") * 100, 2).alias("avg_order_value"),
        ratio("total_orders", months, 2).alias("orders_per_month"),
        *extra,
    )


def customer_history(counted: DataFrame) -> DataFrame:
    """Order history of each customer from counted rows (customer_id, order_date, product_category, _n, _revenue).

    ``_n`` rows share a day and a category. The usual category is the most frequent one, of equally frequent ones the
    lowest.
    """
    n = F.col("_n")
    per_category = counted.groupBy("customer_id", "product_category").agg(
        F.sum("_n").alias("_n"), F.sum("_revenue").alias("_revenue"),
        F.min("order_date").alias("first"), F.max("order_date").alias("last"))
    usual = F.when(F.col("product_category").isNotNull(), F.struct((-n).alias("n"), F.col("product_category").alias("value")))
    return per_category.groupBy("customer_id").agg(
        F.sum("_n").alias("total_orders"),
        usd(F.sum("_revenue")).alias("total_revenue"),
        F.min("first").alias("first_order_date"),
        F.max("last").alias("last_order_date"),
        F.count("product_category").alias("distinct_categories"),
        F.min(usual).alias("_usual"),
    ).withColumn("usual_category", F.col("_usual.value")).drop("_usual")


def zip_modes(counted: DataFrame) -> DataFrame:
    """The most frequent value of each attribute per zip, and the record count, from counted profiles (``_n``)."""
    return one_profile_per_zip(counted, "_n")


def segment_drilldown(
    enriched: DataFrame, state: str | None = None, outdoor_interest: str | None = None
) -> DataFrame:
    """Customers, revenue and order value by value tier and lifestyle, optionally filtered."""
    rows = enriched
    if state is not None:
        rows = rows.where(F.col("state") == state)
    if outdoor_interest is not None:
        rows = rows.where(F.col("outdoor_interest") == outdoor_interest)
    n = F.col("profile_rows") if "profile_rows" in rows.columns else F.lit(1).cast("bigint")

    def average(name: str) -> Column:
        counted = F.sum(F.when(F.col(name).isNotNull(), n))
        return ratio(F.sum(cents(name) * n), counted * 100, 2)

    return rows.groupBy("value_tier", "lifestyle_segment").agg(
        F.sum(n).alias("customers"),
        F.sum(F.col("total_orders") * n).alias("orders"),
        usd(F.sum(cents("total_revenue") * n)).alias("revenue"),
        average("avg_order_value").alias("avg_order_value"),
        average("orders_per_month").alias("orders_per_month"),
    )
