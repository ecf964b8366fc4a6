"""Anomaly bounds that odd training days do not widen, with ranks from a sketch of residuals.

The additive model is fitted on values pulled back to a few spreads around the
model before, the spread being the middle half of the residuals. The residuals
of a series end in one mergeable quantile sketch, from which the median, the
spread and the rank of a later day are read. A series without a past is judged
against the merged sketch of the values of all series.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.functions.calendar import as_date, dow0
from martlens.operators.series import ANOMALY_LEVEL, Z_SCORES, densify, fit, train_holdout_split
from martlens.sources.store import settle

#: Distance between the quartiles of a normal distribution, in standard deviations.
QUARTILE_SPAN = 1.3489795003921634
#: Size parameter of the sketches: exact up to about as many days, small errors of rank beyond.
SKETCH_SIZE = 4096
#: Values beyond so many spreads are pulled back before the next fit, and how often that is done.
REACH, ROUNDS = 3.0, 2

#: Steps of the ladder of quantiles against which ranks are read.
STEPS = 1000

PARAMETERS = ("origin", "last_ds", "slope", "intercept", "effects")


def _base(day: str = "ds") -> Column:
    """Trend and weekday effect of a fitted series; 0 without a model."""
    fitted = F.col("intercept") + F.col("slope") * F.datediff(day, "origin") + F.coalesce(
        F.try_element_at("effects", dow0(day)), F.lit(0.0))
    return F.coalesce(fitted, F.lit(0.0))


def _quantile(sketch: Column | str, rank: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(rank))


def _middle(sketch: Column | str) -> Column:
    """Median and spread of a sketched sample."""
    spread = (_quantile(sketch, 0.75) - _quantile(sketch, 0.25)) / F.lit(QUARTILE_SPAN)
    return F.struct(_quantile(sketch, 0.5).alias("median"), spread.alias("spread"))


def _ladder(sketch: Column | str) -> Column:
    """The quantiles 1 / STEPS, 2 / STEPS .. 1 of a sketched sample; null for an empty one."""
    steps = F.array(*[F.lit((i + 1) / STEPS) for i in range(STEPS)])
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, steps))


def _sketched(value: Column) -> Column:
    return F.kll_sketch_agg_double(value, F.lit(SKETCH_SIZE))


def fit_robust(daily: DataFrame, fill_gaps: bool = True) -> DataFrame:
    """Model parameters and the sketches of residuals and values, one row per series.

    A spread of 0 (a constant series) pulls nothing back.
    """
    # the daily aggregate is read in every round: computed once
    rows = settle(densify(daily) if fill_gaps else daily.where(F.col("y").isNotNull()).select("series", "ds", "y"))
    params = fit(rows, fill_gaps=False).select("series", *PARAMETERS)
    for _ in range(ROUNDS):
        judged = rows.join(params, "series").select("series", "ds", "y", _base().alias("_b"))
        middles = judged.groupBy("series").agg(_sketched(F.col("y") - F.col("_b")).alias("_s")).select("series", _middle("_s").alias("_m"))
        centre, far = F.col("_b") + F.col("_m.median"), F.col("_m.spread") * F.lit(REACH)
        held = F.when(far > 0, F.greatest(centre - far, F.least(centre + far, F.col("y")))).otherwise(F.col("y"))
        params = fit(judged.join(middles, "series").select("series", "ds", held.alias("y")), fill_gaps=False).select("series", *PARAMETERS)
    residuals = rows.join(params, "series").groupBy("series").agg(
        _sketched(F.col("y") - _base()).alias("residuals"), _sketched(F.col("y")).alias("values"))
    return params.join(residuals, "series")


def detect_robust(
    daily: DataFrame,
    model_name: str,
    cutoff: dt.date | str,
    level: float = ANOMALY_LEVEL,
    digits: int = 2,
    fill_gaps: bool = True,
) -> DataFrame:
    """Judge the days from the cut-off on, for every series that has a past or a later row.

    With ``fill_gaps`` a fitted series is judged on each day up to the last of the table and a
    new one from its first day on, days without a row counting as 0. ``percentile`` is the share
    of past residuals (of all past values for a new series) that are not larger, in whole
    thousandths; ``judged_by`` says which. Without any past the bounds are null and nothing is flagged.
    """
    train, later = train_holdout_split(daily, cutoff)
    observed = later.where(F.col("y").isNotNull()).groupBy("series", "ds").agg(F.sum("y").alias("y"))
    # one row per series, read by the pooled sketch and by every day: computed once
    fitted = settle(fit_robust(train, fill_gaps))
    pooled = fitted.agg(F.kll_merge_agg_double("values", F.lit(SKETCH_SIZE)).alias("_all")).select(_ladder("_all").alias("_l")).scalar()
    own = fitted.select("series", *PARAMETERS, _ladder("residuals").alias("_own"))
    last = observed.agg(F.max("ds")).scalar()
    begun = observed.groupBy("series").agg(F.min("ds").alias("_first"))
    everyone = own.join(begun, "series", "full").withColumn("_last", last)
    start = F.when(F.col("origin").isNull(), F.col("_first")).otherwise(F.lit(as_date(cutoff)))
    days = everyone.where(F.col("_last").isNotNull()).withColumn("ds", F.explode(F.sequence(start, F.col("_last"))))
    rows = days.join(observed, ["series", "ds"], "left" if fill_gaps else "inner")
    if fill_gaps:
        rows = rows.withColumn("y", F.coalesce("y", F.lit(0.0)))
    def rung(rank: float) -> Column:
        return F.get("_l", F.lit(round(rank * STEPS) - 1))

    scored = rows.withColumns({"_l": F.coalesce(F.col("_own"), pooled), "_b": _base()}).withColumns(
        {"_f": F.col("_b") + rung(0.5), "_spread": (rung(0.75) - rung(0.25)) / F.lit(QUARTILE_SPAN)})
    half = F.lit(Z_SCORES[level]) * F.col("_spread")
    y, low, high = F.round("y", digits), F.round(F.col("_f") - half, digits), F.round(F.col("_f") + half, digits)
    rank = F.size(F.filter("_l", lambda q: q <= F.col("y") - F.col("_b"))) / F.lit(float(STEPS))
    return scored.select(
        F.lit(model_name).alias("model_name"),
        "series",
        F.col("ds").cast("timestamp_ntz").alias("ts"),
        y.alias("y"),
        F.round("_f", digits).alias("forecast"),
        low.alias("lower_bound"),
        high.alias("upper_bound"),
        F.coalesce((y < low) | (y > high), F.lit(False)).alias("is_anomaly"),
        F.when(F.col("_l").isNotNull(), rank).alias("percentile"),
        F.when(F.col("origin").isNotNull(), "own past").when(F.col("_l").isNotNull(), "all series").otherwise("nothing").alias("judged_by"),
    )
