"""Calendar arithmetic with the conventions used by every operator.

Weeks start on Monday, weekday 0 is Sunday, the weekend is Saturday and Sunday,
and a month difference counts month boundaries.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The retail holidays flagged in the forecast input.
HOLIDAYS = (
    "2024-07-04", "2024-09-02", "2024-11-28", "2024-11-29", "2024-12-25",
    "2025-01-01", "2025-01-20", "2025-02-17", "2025-05-26", "2025-07-04",
    "2025-09-01", "2025-11-27", "2025-11-28", "2025-12-25",
    "2026-01-01", "2026-01-19", "2026-02-16",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(day: dt.date | str) -> Column:
    return F.lit(dt.date.fromisoformat(day) if isinstance(day, str) else day)


def dow0(day: Column | str) -> Column:
    """Weekday number, Sunday = 0."""
    return F.dayofweek(_col(day)) - 1


def is_weekend(day: Column | str) -> Column:
    return F.dayofweek(_col(day)).isin(1, 7).cast("int")


def is_holiday(day: Column | str, holidays: tuple[str, ...] = HOLIDAYS) -> Column:
    return _col(day).isin([dt.date.fromisoformat(h) for h in holidays]).cast("int")


def week_start(day: Column | str) -> Column:
    return F.trunc(_col(day), "week")


def month_start(day: Column | str) -> Column:
    return F.trunc(_col(day), "month")


def month_boundaries(start: Column | str, end: Column | str) -> Column:
    """Number of month boundaries between two dates (31 Jan to 1 Feb is 1)."""
    a, b = _col(start), _col(end)
    return (F.year(b) * 12 + F.month(b)) - (F.year(a) * 12 + F.month(a))


def quarter_label(day: Column | str) -> Column:
    """Period label such as ``Q1_2025``."""
    d = _col(day)
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit("_"), F.year(d).cast("string"))


def date_spine(spark: SparkSession, start: dt.date | str, days: int, until: dt.date | str | None = None) -> DataFrame:
    """``days`` consecutive dates from ``start``, cut at ``until`` when given."""
    spine = spark.range(days).select(F.date_add(as_date(start), F.col("id").cast("int")).alias("d"))
    return spine if until is None else spine.where(F.col("d") <= as_date(until))
