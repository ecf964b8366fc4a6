"""As-of join: each row meets the latest row of the other side that is not after it.

Both sides are laid into one sequence per key and time, and the last known value is carried along, so no pair is built
and nothing is compared by range. A key that holds a large part of all rows is cut into slices of time: within a slice
the last known value is found by a window over (key, slice); what a slice inherits is the last value of the slices
before it, found on one row per key and slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def day_slice(time: Column, days: int = 7) -> Column:
    """Number of the slice of ``days`` days that a date or timestamp lies in."""
    return F.floor(F.unix_date(F.to_date(time)) / days)


def as_of_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, slice_days: int = 7) -> DataFrame:
    """Every row of ``left`` with the columns of its latest match in ``right``, or nulls.

    A match has equal ``keys``, none null, and a ``right_time`` not after ``left_time``. Of several rows of ``right``
    with equal keys and time the greatest counts, column by column. Rows with a null time match nothing. Other
    columns of the two sides must differ in name.
    """
    values = [c for c in right.columns if c not in keys]
    found = F.struct(*[F.col(c) for c in values])
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    a = left.select(*keys, F.col(left_time).alias("_at"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"),
                    F.lit(None).cast(right.select(found).schema[0].dataType).alias("_known"))
    b = right.where(complete & F.col(right_time).isNotNull()).groupBy(*keys, F.col(right_time).alias("_at")).agg(F.max(found).alias("_known")).select(
        *keys, "_at", F.lit(0).alias("_side"), F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("_row"), "_known")
    both = a.unionByName(b).withColumn("_slice", day_slice(F.col("_at"), slice_days))
    inside = Window.partitionBy(*keys, "_slice").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("_seen", F.last("_known", ignorenulls=True).over(inside)).where("_side = 1")
    # one row per key and slice: the slice's own last value, and that of the slices before it
    heirs = both.groupBy(*keys, "_slice").agg(F.max_by("_known", F.when(F.col("_known").isNotNull(), F.col("_at"))).alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    inherited = heirs.select(*[F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)], F.col("_slice").alias("_s"),
                             F.last("_last", ignorenulls=True).over(before).alias("_inherited"))
    same = F.col("_slice") == F.col("_s")
    for n, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"_k{n}"))
    joined = seen.join(inherited, same, "left")
    match = F.coalesce("_seen", "_inherited")
    usable = complete & F.col("_at").isNotNull()
    return joined.select("_row", F.when(usable, match).alias("_match")).select("_row.*", *[F.col(f"_match.{c}").alias(c) for c in values])
