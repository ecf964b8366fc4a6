"""Declared schemas of the base tables and of the model result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_I, _L, _D, _S = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
_DATE, _TS, _B = T.DateType(), T.TimestampNTZType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


WHOLESALE_PARTNERS = _struct(
    partner_id=_L, partner_name=_S, region=_S, tier=_S, avg_sell_through_rate=_D, annual_volume=_L)
CAMPAIGNS = _struct(
    campaign_id=_L, campaign_name=_S, channel=_S, sub_channel=_S, start_date=_DATE, end_date=_DATE,
    budget=_D, target_conversions=_I)
CUSTOMERS = _struct(
    customer_id=_L, first_name=_S, last_name=_S, email=_S, state=_S, zip_code=_S, age=_I, gender=_S,
    channel_preference=_S, signup_date=_DATE, lifetime_value=_D)
ORDERS = _struct(
    order_id=_L, customer_id=_L, campaign_id=_L, order_date=_DATE, channel=_S, product_category=_S,
    product_name=_S, quantity=_I, revenue=_D, wholesale_partner_id=_L)
MARKETING_SPEND = _struct(
    spend_id=_L, campaign_id=_L, spend_date=_DATE, channel=_S, sub_channel=_S, amount=_D,
    impressions=_I, clicks=_I, conversions=_I)
PRODUCT_REVIEWS = _struct(
    review_id=_L, customer_id=_L, product_category=_S, product_name=_S, channel=_S, review_date=_DATE,
    rating=_I, review_text=_S)

FORECAST_RESULTS = _struct(model_name=_S, series=_S, ts=_TS, forecast=_D, lower_bound=_D, upper_bound=_D)
ANOMALY_RESULTS = _struct(
    model_name=_S, series=_S, ts=_TS, y=_D, forecast=_D, lower_bound=_D, upper_bound=_D,
    is_anomaly=_B, percentile=_D)

BASE_TABLES = {
    "wholesale_partners": WHOLESALE_PARTNERS,
    "campaigns": CAMPAIGNS,
    "customers": CUSTOMERS,
    "orders": ORDERS,
    "marketing_spend": MARKETING_SPEND,
    "product_reviews": PRODUCT_REVIEWS,
}


def read_base(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Scan one base table with its declared schema."""
    return spark.read.schema(BASE_TABLES[table]).parquet(f"{root.rstrip('/')}/{table}")


def empty(spark: SparkSession, table: str) -> DataFrame:
    """An empty base table, for schema checks."""
    return spark.createDataFrame([], BASE_TABLES[table])
