"""Calendar expansion, numbering, stable sampling and what-if factors."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlens.functions.calendar import as_date
from martlens.functions.money import cents, sum_usd, usd
from martlens.sources.store import settle


def date_spine_counts(orders: DataFrame, per_day: int) -> DataFrame:
    """Planned slots per day (every day of the order range times a fixed number) against orders taken.

    The rows are multiplied by an exploded sequence, not by a join.
    """
    taken = orders.groupBy(F.col("order_date").alias("d")).agg(F.count(F.lit(1)).alias("orders"))
    span = taken.agg(F.min("d").alias("a"), F.max("d").alias("b"))
    days = span.select(F.explode(F.sequence("a", "b")).alias("d"))
    slots = days.select("d", F.explode(F.sequence(F.lit(1), F.lit(per_day))).alias("slot"))
    planned = slots.groupBy("d").agg(F.count("slot").alias("slots"))
    return planned.join(taken, "d", "left").select("d", "slots", F.coalesce("orders", F.lit(0).cast("bigint")).alias("orders"))


def series_spine(daily: DataFrame, day: str = "order_date") -> DataFrame:
    """Every day from the first to the last, with its position."""
    span = daily.agg(F.min(day).alias("a"), F.max(day).alias("b"))
    return span.select(F.posexplode(F.sequence("a", "b")).alias("n", "d")).select(F.col("d"), F.col("n"))


def campaign_days(campaigns: DataFrame) -> DataFrame:
    """One row per campaign and running day, without a join to a calendar."""
    length = F.datediff("end_date", "start_date") + 1
    return campaigns.select(
        "campaign_id",
        "sub_channel",
        F.explode(F.sequence("start_date", "end_date")).alias("spend_date"),
        length.alias("campaign_days"),
        F.round(F.try_divide(F.col("budget"), length.cast("double")), 2).alias("daily_budget"),
    )


def revenue_what_if(
    orders: DataFrame,
    seasons: Mapping[int, float],
    events: Sequence[tuple[str, str, str, float]],
    price_change: Mapping[str, float],
) -> DataFrame:
    """Revenue per category and channel if the caller's factors applied.

    ``seasons`` maps a month to a factor, ``events`` are ``(channel, first day, last day,
    factor)`` of which the first match counts, ``price_change`` maps a category to a factor;
    each is 1 when absent. Factors are taken as the decimal numbers they are written as; their
    product is exact, and an order's adjusted cents are rounded once, half away from zero.
    """
    def whole(factors: list) -> tuple[list[Column], Column, int]:
        """The factors as whole numbers over 10 to the third value, and 1 likewise."""
        exact = [Decimal(str(f)) for f in factors]
        digits = max([0, *(-d.normalize().as_tuple().exponent for d in exact)])
        return [F.lit(int(d.scaleb(digits))).cast("decimal(12,0)") for d in exact], F.lit(10**digits).cast("decimal(12,0)"), digits

    def looked_up(table: Mapping, key: Column) -> tuple[Column, int]:
        factors, one, digits = whole(list(table.values()))
        pairs = F.create_map(*[x for name, f in zip(table, factors, strict=True) for x in (F.lit(name), f)]) if table else None
        return one if pairs is None else F.coalesce(F.try_element_at(pairs, key), one), digits

    factors, event, event_digits = whole([e[3] for e in events])
    for (channel, first, last, _), factor in reversed(list(zip(events, factors, strict=True))):
        hit = (F.col("channel") == channel) & F.col("order_date").between(as_date(first), as_date(last))
        event = F.when(hit, factor).otherwise(event)
    season, season_digits = looked_up(seasons, F.month("order_date"))
    price, price_digits = looked_up(price_change, F.col("product_category"))
    scale = 10 ** (event_digits + season_digits + price_digits)
    product = (season * event * price).cast("decimal(20,0)")
    paid = cents("revenue")
    twice = (F.abs(paid).cast("decimal(16,0)") * product * 2 + F.lit(scale)).cast("decimal(38,0)")
    adjusted = F.call_function("div", twice, F.lit(2 * scale).cast("decimal(38,0)"))
    adjusted = F.when(paid < 0, -adjusted).otherwise(adjusted)
    return orders.select("product_category", "channel", "revenue", adjusted.alias("_adj")).groupBy(
        "product_category", "channel"
    ).agg(sum_usd("revenue").alias("revenue"), usd(F.sum("_adj")).alias("adjusted_revenue"))


def stable_sample(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows in a repeatable random order, without replacement.

    The order is an integer hash of the key and the seed (two squaring rounds
    modulo a prime), so the same rows come back on every run and on any engine,
    and the limit is a top-n, not a full sort.
    """
    prime = F.lit(2147483647).cast("bigint")
    x = F.pmod(F.pmod(F.col(key), prime) * 48271 + F.lit(seed * 69621 % 2147483647), prime)
    return (
        rows.withColumn("_h", x)
        .withColumn("_h", F.pmod(F.col("_h") * F.col("_h") + F.col("_h") * 16807, prime))
        .withColumn("_h", F.pmod(F.col("_h") * F.col("_h") + F.col("_h") * 39373, prime))
        .orderBy("_h", key)
        .limit(n)
        .drop("_h")
    )


def surrogate_key(rows: DataFrame, order_by: Sequence[str], name: str = "row_id", partitions: int | None = None) -> DataFrame:
    """Consecutive numbers in the global order of ``order_by``, without a single-task window.

    Rows are range-partitioned and sorted, and the result is stored. A row's
    number is its place in its partition plus the rows of the earlier ones; only
    the partition counts (one row per partition) are cumulated. ``order_by``
    must end in a unique column, so equal leading values split over partitions.
    """
    spark = rows.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    ranged = settle(
        rows.repartitionByRange(n, *[F.col(c) for c in order_by])
        .sortWithinPartitions(*order_by)
        .withColumn("_p", F.shiftright(place, 33).cast("int"))
        .withColumn("_i", place.bitwiseAND(F.lit((1 << 33) - 1)))
    )
    sizes = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (
        ranged.join(F.broadcast(offsets), "_p")  # at most one row per partition
        .withColumn(name, F.col("_before") + F.col("_i") + 1)
        .drop("_p", "_i", "_before")
    )


def rows_before(values: DataFrame, value: str, count: str, name: str = "rows_before") -> DataFrame:
    """For each distinct value, the sum of ``count`` over the larger values, without a single-task window.

    Values are range-partitioned and stored; inside a range the counts are cumulated, and the
    sums of the earlier ranges (one row per partition) are added. Nulls come last.
    """
    n = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = settle(values.repartitionByRange(n, F.desc_nulls_last(value)).withColumn("_p", F.spark_partition_id()))
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_p").agg(F.sum(count).alias("_n")).select(
        "_p", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_p").orderBy(F.desc_nulls_last(value)).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.withColumn("_inside", F.coalesce(F.sum(count).over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "_p")  # at most one row per partition
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_p", "_inside", "_before")
    )


def split_counts(daily: DataFrame, cutoff: dt.date | str) -> DataFrame:
    """Rows and days of the training and the hold-out part, per series."""
    part = F.when(F.col("ds") < as_date(cutoff), "train").otherwise("holdout")
    return daily.groupBy("series", part.alias("part")).agg(
        F.count(F.lit(1)).alias("n_days"), F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"),
        sum_usd("y").alias("total"),
    )
