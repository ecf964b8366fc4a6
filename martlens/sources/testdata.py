"""The given test tables read as marketing tables.

Each function scans one or two Parquet files, projects only the columns it
needs and returns a frame shaped like a base table. The formulas are listed in
FIXTURES.md; the SQL checks repeat them as common table expressions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.functions.money import cents, usd

# Product categories and marketing sub-channels.
CATEGORIES = ("outerwear", "footwear", "camping", "climbing", "winter_sports", "accessories")
SUB_CHANNELS = ("email", "social", "search", "trade_promo", "co_op_ad")

LIFESTYLE_FLAGS = (
    "travel", "travel_domestic", "health_fitness", "exercise_health_grouping", "outdoor",
    "outdoor_sport_recreation", "sports_grouping", "sports_and_leisure", "home_and_garden",
    "home_improvement", "camping_hiking", "hunting_shooting", "fishing", "snow_skiing",
)
STAR_AS_OF = dt.date(2001, 9, 1)
EVENT_AS_OF = dt.date(2024, 1, 31)


# Declared column types, so that no scan starts with a job that infers them.
TABLE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _pick(values: tuple[str, ...], index: Column) -> Column:
    """0-based lookup in a constant list."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def orders_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases of January 2024, one row per order."""
    k = _k()
    wholesale = k % 3 == 0
    category = _pick(CATEGORIES, F.col("event_id") % 6)
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "purchase")
        .select(
            F.col("event_id").alias("order_id"),
            F.col("user_id").alias("customer_id"),
            (F.col("event_id") % 22).alias("campaign_id"),
            F.to_date("ts").alias("order_date"),
            F.when(wholesale, "wholesale").otherwise("DTC").alias("channel"),
            category.alias("product_category"),
            F.concat(category, F.lit(" "), (F.floor(F.col("event_id") / 6) % 5).cast("string")).alias("product_name"),
            (1 + k % 3).alias("quantity"),
            F.col("value").alias("revenue"),
            F.when(wholesale, F.col("event_id") % 100).alias("wholesale_partner_id"),
        )
    )


def order_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date of each order, without its lines."""
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("order_date"))


def orders_star(spark: SparkSession, sf_dir: str, with_product: bool = False) -> DataFrame:
    """Order lines 1995-2001; the part join is made only when products are asked for.

    A line's revenue is ``price * (1 - discount)`` rounded to the cent.
    """
    net = (cents("l_extendedprice") * (F.lit(100) - F.rint(F.col("l_discount") * 100).cast("bigint")) + 50)
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("quantity"),
        usd(F.floor(net / 100)).alias("revenue"),
    )
    heads = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "wholesale").otherwise("DTC").alias("channel"),
    )
    rows = lines.join(heads, "l_orderkey")
    product: list[Column] = []
    if with_product:
        parts = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("product_category"),
            F.col("p_name").alias("product_name"),
        )
        rows = rows.join(parts, "l_partkey")
        product = [F.col("product_category"), F.col("product_name")]
    return rows.select(
        F.col("l_orderkey").alias("order_id"),
        "customer_id",
        (F.col("l_orderkey") % 22).alias("campaign_id"),
        "order_date",
        "channel",
        *product,
        "quantity",
        "revenue",
        F.when(F.col("channel") == "wholesale", F.col("l_suppkey")).alias("wholesale_partner_id"),
    )


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    start = F.date_add(F.lit(dt.date(2024, 1, 1)), key % 20)
    return table(spark, sf_dir, "nation").select(
        key.cast("bigint").alias("campaign_id"),
        F.concat(F.lit("Campaign "), F.col("n_name")).alias("campaign_name"),
        F.when(F.col("n_regionkey") < 3, "DTC").otherwise("wholesale").alias("channel"),
        _pick(SUB_CHANNELS, F.col("n_regionkey")).alias("sub_channel"),
        start.alias("start_date"),
        F.date_add(start, 5 + key % 10).alias("end_date"),
        (F.lit(1000.0) * (key + 1)).alias("budget"),
        (F.lit(10) * (key + 1)).alias("target_conversions"),
    )


def spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views, clicks and sign-ups read as daily advertising cost lines."""
    k = _k()
    rows = (
        table(spark, sf_dir, "events")
        .where(F.col("event_type").isin("view", "click", "signup"))
        .select(
            F.col("event_id").alias("spend_id"),
            (F.col("event_id") % 20).alias("campaign_id"),
            F.col("user_id").alias("customer_id"),
            F.to_date("ts").alias("spend_date"),
            F.col("value").alias("amount"),
            (100 + 10 * k).alias("impressions"),
            k.alias("clicks"),
            (k % 5).alias("conversions"),
        )
    )
    names = campaigns(spark, sf_dir).select("campaign_id", "channel", "sub_channel")
    return rows.join(names, "campaign_id").select(
        "spend_id", "campaign_id", "customer_id", "spend_date", "channel", "sub_channel",
        "amount", "impressions", "clicks", "conversions",
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    states = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("state"))
    return (
        table(spark, sf_dir, "customer")
        .join(states, "c_nationkey")
        .select(
            key.alias("customer_id"),
            F.lower(F.concat(F.col("c_name"), F.lit("@example.com"))).alias("email"),
            "state",
            (10000 + 10 * F.col("c_nationkey") + key % 4).cast("string").alias("zip_code"),
            (18 + key % 52).cast("int").alias("age"),
            F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
            _pick(("DTC", "wholesale", "both"), key % 3).alias("channel_preference"),
            F.date_add(F.lit(dt.date(2023, 6, 1)), (key % 365).cast("int")).alias("signup_date"),
            F.col("c_acctbal").alias("lifetime_value"),
        )
    )


def consumer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Household records by zip (several per zip), lifestyle flags as text."""
    key = F.col("s_suppkey")
    flags = [
        F.when((key + i) % (i + 5) == 0, "Single").otherwise("None").alias(name)
        for i, name in enumerate(LIFESTYLE_FLAGS)
    ]
    income = (
        F.when(F.col("s_acctbal") < 2000, "under 50K")
        .when(F.col("s_acctbal") < 6000, "50K-100K")
        .otherwise("over 100K")
    )
    zip_text = F.concat(F.lit(" "), (10000 + 10 * F.col("s_nationkey") + key % 4).cast("string"), F.lit("-0000"))
    return table(spark, sf_dir, "supplier").select(
        zip_text.alias("zip"), income.alias("estimated_household_income"), *flags
    )


def weather_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station days from 10 January 2024 on; some outside the country."""
    k = _k()
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "error")
        .select(
            F.to_date("ts").alias("date_valid_std"),
            (10000 + 10 * (F.col("user_id") % 25) + F.col("user_id") % 4).cast("string").alias("postal_code"),
            F.when(k == 99, "CA").otherwise("US").alias("country"),
            F.col("value").alias("avg_temperature_air_2m_f"),
            (k / F.lit(100.0)).alias("tot_precipitation_in"),
            (k % 7 / F.lit(10.0)).alias("tot_snowfall_in"),
        )
    )


def economic_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity-attribute-value series, moved 25 years ahead to meet the spend days."""
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "P", "country/CAN").otherwise("country/USA").alias("geo_id"),
        F.add_months(F.to_date("o_orderdate"), 300).alias("date"),
        F.col("o_orderpriority").alias("variable"),
        F.col("o_totalprice").alias("value"),
    )


def survey_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("release_year"),
        F.when(F.col("l_suppkey") % 2 == 0, "usa").otherwise("gbr").alias("market_code"),
        F.col("l_returnflag").alias("namespace_code"),
        F.col("l_linestatus").alias("question_code"),
        F.col("l_linenumber").alias("datapoint_code"),
        F.col("l_orderkey").alias("respondent_code"),
        F.col("l_quantity").alias("respondent_weight"),
    )


def survey_labels(spark: SparkSession) -> DataFrame:
    """The 42 code combinations; two data points share each answer name."""
    i = F.col("id")
    point = (i % 7 + 1).cast("int")
    namespace = _pick(("A", "N", "R"), i / 14)
    question = _pick(("F", "O"), i / 7 % 2)
    return spark.range(42).select(
        namespace.alias("namespace_code"),
        question.alias("question_code"),
        point.alias("datapoint_code"),
        F.concat(F.lit("Topic "), namespace).alias("category_1"),
        _pick(("Demographics", "Media Consumption", "Attitudes", "Brands"), point % 4).alias("category_2"),
        F.concat(F.lit("Question "), question).alias("question_name"),
        F.concat(F.lit("Answer "), F.floor(point / 5).cast("string")).alias("datapoint_name"),
    )


def partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    tier = F.when(F.col("s_acctbal") >= 6000, "gold").when(F.col("s_acctbal") >= 2000, "silver").otherwise("bronze")
    return (
        table(spark, sf_dir, "supplier")
        .join(nations, "s_nationkey")
        .select(
            key.alias("partner_id"),
            F.col("s_name").alias("partner_name"),
            _pick(("northeast", "southeast", "midwest", "west", "pacific"), F.col("n_regionkey")).alias("region"),
            tier.alias("tier"),
            (F.lit(0.5) + (key % 40) / F.lit(100.0)).alias("avg_sell_through_rate"),
            F.when(key % 10 == 9, 0).otherwise(1000 * (key + 1)).alias("annual_volume"),
        )
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents read as product reviews, rated by their labels."""
    marks = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    rating = (
        F.when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 5).when(F.col("quality") == 0, 2).otherwise(3)
    )
    source_no = F.regexp_extract("source", "[0-9]+", 0).cast("int")
    return (
        table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
        .join(marks, "doc_id", "left")
        .select(
            F.col("doc_id").alias("review_id"),
            (F.col("doc_id") % 150).alias("customer_id"),
            F.col("lang").alias("product_category"),
            F.col("source").alias("product_name"),
            F.when(source_no % 2 == 0, "dtc_website").otherwise("retail_partner").alias("channel"),
            F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("doc_id") % 30).cast("int")).alias("review_date"),
            rating.alias("rating"),
            F.col("text").alias("review_text"),
        )
    )


# Opinion words drawn from the frequent short words of the invented prose.
TEST_POSITIVE = ("the", "and", "that", "with", "le", "les", "pour", "der", "und", "mit", "el", "los", "con")
TEST_NEGATIVE = ("of", "in", "was", "by", "de", "un", "pas", "die", "von", "nicht", "la", "no", "por")
TEST_FEEDBACK = ("this", "from", "avec", "dans", "für", "sich", "para", "una")
TEST_BRANDS = ("ther", "eau", "ung", "ci", "mente", "heit")
TEST_RECOMMEND = ("as", "are", "est", "ist", "es")
TEST_DISCOURAGE = ("be", "at", "pas", "nicht", "no")
TEST_NEGATIONS = ("not", "no", "pas", "nicht")

TEST_TARGETS = {
    "email": {"roas": 1.2, "cpa": 30.0, "conversions": 500.0, "share": 25.0},
    "search": {"roas": 1.0, "cpa": 25.0, "share": 15.0},
    "social": {"roas": 1.6, "conversions": 1000.0},
    "trade_promo": {"roas": 1.6, "cpa": 26.0},
}
