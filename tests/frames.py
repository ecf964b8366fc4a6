"""Small frames for edge cases."""

from __future__ import annotations

import datetime as dt

from martlens.sources.schemas import BASE_TABLES


def d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def frame(spark, table: str, rows: list[dict]):
    schema = BASE_TABLES[table]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def order(order_id, day, revenue=10.0, customer=1, campaign=1, channel="DTC", category="camping", partner=None, quantity=1):
    return {
        "order_id": order_id, "customer_id": customer, "campaign_id": campaign, "order_date": d(day), "channel": channel,
        "product_category": category, "product_name": f"{category} 1", "quantity": quantity, "revenue": revenue,
        "wholesale_partner_id": partner,
    }


def campaign(campaign_id, sub_channel="email", channel="DTC", budget=100.0, start="2026-01-01", end="2026-01-10"):
    return {
        "campaign_id": campaign_id, "campaign_name": f"c{campaign_id}", "channel": channel, "sub_channel": sub_channel,
        "start_date": d(start), "end_date": d(end), "budget": budget, "target_conversions": 10,
    }


def cost(spend_id, campaign_id, day, amount=5.0, clicks=10, conversions=1, impressions=100, sub_channel="email", channel="DTC"):
    return {
        "spend_id": spend_id, "campaign_id": campaign_id, "spend_date": d(day), "channel": channel,
        "sub_channel": sub_channel, "amount": amount, "impressions": impressions, "clicks": clicks, "conversions": conversions,
    }


def customer(customer_id, zip_code="10001", value=100.0, age=30, state="NY", signup="2025-01-01"):
    return {
        "customer_id": customer_id, "state": state, "zip_code": zip_code, "age": age, "gender": "F",
        "channel_preference": "DTC", "signup_date": d(signup), "lifetime_value": value,
    }


def enrichment(spark, rows: list[tuple]):
    return spark.createDataFrame(
        rows, "zip_code string, income_bracket string, lifestyle_segment string, outdoor_interest string")


def weather(spark, rows: list[tuple]):
    return spark.createDataFrame(
        [(d(day), *rest) for day, *rest in rows],
        "weather_date date, zip_code string, avg_temp_f double, precipitation_in double, snowfall_in double")
