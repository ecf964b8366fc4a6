"""Incremental refresh of the daily tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.functions.money import ratio, sum_usd
from martlens.operators.kpi import daily_revenue
from martlens.sources.store import overwrite_partitions, remove_partition, write_snapshot

DAY = ("order_date",)


def initial_load(orders: DataFrame, path: str) -> None:
    """Write the daily table, one partition per day."""
    write_snapshot(daily_revenue(orders).repartition(*DAY), path, DAY)


def refresh_days(orders: DataFrame, arrived: DataFrame, path: str) -> None:
    """Recompute and replace only the days that ``arrived`` rows belong to.

    ``orders`` is the full table including the new rows; stored by day, its scan is pruned
    to the touched days at run time. ``arrived`` holds every row that came, left or changed,
    with its old and its new date. A touched day without orders loses its partition.
    """
    touched = arrived.select(*DAY).distinct()
    fresh = daily_revenue(orders.join(touched, list(DAY), "left_semi"))
    overwrite_partitions(fresh.repartition(*DAY), path, DAY)
    emptied = touched.join(orders.select(*DAY).join(touched, list(DAY), "left_semi").distinct(), list(DAY), "left_anti")
    for row in emptied.collect():  # days, each a partition folder
        remove_partition(orders.sparkSession, path, {"order_date": row.order_date})


def read_daily(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).select(
        "order_date", "channel", "order_count", "total_units", "total_revenue", "avg_order_value"
    )


def merge_partials(current: DataFrame, delta: DataFrame) -> DataFrame:
    """Daily table plus the daily aggregate of new rows only.

    Counts, units and revenue add up; the mean is taken from the merged sums,
    which needs every order to have a revenue.
    """
    both = current.unionByName(delta)
    merged = both.groupBy("order_date", "channel").agg(
        F.sum("order_count").alias("order_count"),
        F.sum("total_units").alias("total_units"),
        sum_usd("total_revenue").alias("total_revenue"),
    )
    return merged.withColumn(
        "avg_order_value", ratio(F.rint(F.col("total_revenue") * 100), F.col("order_count") * 100, 2)
    )
