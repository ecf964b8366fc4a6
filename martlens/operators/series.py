"""Per-series forecasts, anomaly flags and calendar effects.

Every step works on the daily aggregate ``(series, ds, y)``: one row per series
and day, so a series is bounded by the calendar whatever its raw row count. A
model is an additive one (linear trend plus weekday effect) fitted by grouped
aggregates for all series at once; there is no loop over series.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlens.functions.calendar import as_date, dow0, is_holiday, is_weekend
from martlens.functions.money import ratio, sum_usd

# Two-sided normal quantiles of the offered interval levels.
Z_SCORES = {0.90: 1.6448536269514722, 0.95: 1.959963984540054, 0.99: 2.5758293035489004}
FORECAST_LEVEL = 0.95
ANOMALY_LEVEL = 0.99

# The pandas model travels to the workers by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def total_series(daily: DataFrame, name: str = "Total") -> DataFrame:
    """All series of a day summed into one."""
    return daily.groupBy("ds").agg(sum_usd("y").alias("y")).select(F.lit(name).alias("series"), "ds", "y")


def spend_series(daily_spend: DataFrame, exclude: Sequence[str] = ("distributor_event",)) -> DataFrame:
    return (
        daily_spend.where(~F.col("sub_channel").isin(*exclude))
        .groupBy(F.col("sub_channel").alias("series"), "ds")
        .agg(sum_usd("total_spend").alias("y"))
    )


def conversion_rate_series(daily_spend: DataFrame, channel: str = "DTC", name: str = "DTC Conversion Rate") -> DataFrame:
    """Conversions per 100 clicks and day of one channel."""
    return (
        daily_spend.where(F.col("channel") == channel)
        .groupBy("ds")
        .agg(ratio(F.sum("total_conversions") * 100, F.sum("total_clicks")).alias("y"))
        .select(F.lit(name).alias("series"), "ds", "y")
    )


def order_count_series(orders: DataFrame, channel: str = "wholesale") -> DataFrame:
    return (
        orders.where(F.col("channel") == channel)
        .groupBy(F.col("product_category").alias("series"), F.col("order_date").alias("ds"))
        .agg(F.count(F.lit(1)).cast("double").alias("y"))
    )


def train_holdout_split(daily: DataFrame, cutoff: dt.date | str) -> tuple[DataFrame, DataFrame]:
    """Rows before the cut-off, and rows from it on."""
    return daily.where(F.col("ds") < as_date(cutoff)), daily.where(F.col("ds") >= as_date(cutoff))


def densify(daily: DataFrame) -> DataFrame:
    """Every day between a series' first and last day; missing days become 0.

    Rows of the same series and day are added up. Each row is then stretched up to the day
    before the series' next row, so the gaps cost no join, and the one shuffle by series
    serves the later windows too.
    """
    one = daily.repartition("series").groupBy("series", "ds").agg(F.sum("y").alias("y"))
    following = F.lead("ds").over(Window.partitionBy("series").orderBy("ds"))
    stretch = F.sequence(F.col("ds"), F.coalesce(F.date_sub("_next", 1), F.col("ds")))
    return (
        one.select("series", "ds", "y", following.alias("_next"))
        .select("series", "y", F.col("ds").alias("_ds"), F.explode(stretch).alias("ds"))
        .select("series", "ds", F.when(F.col("ds") == F.col("_ds"), F.coalesce("y", F.lit(0.0))).otherwise(F.lit(0.0)).alias("y"))
    )


def _t(day: Column | str, origin: Column | str) -> Column:
    return F.datediff(day, origin)


def fit(daily: DataFrame, fill_gaps: bool = True) -> DataFrame:
    """Model parameters, one row per series.

    ``slope`` and ``intercept`` of the trend, ``effects`` (mean residual per
    weekday, 0 = Sunday) and ``sigma`` (residual spread). All steps share the
    partitioning by series of the first shuffle.
    """
    rows = densify(daily) if fill_gaps else daily.where(F.col("y").isNotNull())
    whole = Window.partitionBy("series")
    dated = rows.withColumn("origin", F.min("ds").over(whole)).withColumn("t", _t("ds", "origin").cast("double"))
    trend = (
        dated.withColumn("_n", F.count(F.lit(1)).over(whole))
        .withColumn("_ty", F.avg("t").over(whole))
        .withColumn("_yy", F.avg("y").over(whole))
        .withColumn("_cov", F.sum((F.col("t") - F.col("_ty")) * (F.col("y") - F.col("_yy"))).over(whole))
        .withColumn("_var", F.sum((F.col("t") - F.col("_ty")) * (F.col("t") - F.col("_ty"))).over(whole))
        .withColumn("slope", F.when(F.col("_var") > 0, F.col("_cov") / F.col("_var")).otherwise(F.lit(0.0)))
        .withColumn("intercept", F.col("_yy") - F.col("slope") * F.col("_ty"))
        .withColumn("_r", F.col("y") - F.col("intercept") - F.col("slope") * F.col("t"))
        .withColumn("_dow", dow0("ds"))
        .withColumn("_effect", F.avg("_r").over(Window.partitionBy("series", "_dow")))
        .withColumn("_e", F.col("_r") - F.col("_effect"))
    )
    return trend.groupBy("series").agg(
        F.first("origin").alias("origin"),
        F.max("ds").alias("last_ds"),
        F.first("slope").alias("slope"),
        F.first("intercept").alias("intercept"),
        F.map_from_entries(F.collect_set(F.struct("_dow", "_effect"))).alias("effects"),
        F.round(F.when(F.count("_e") > 1, F.stddev_samp("_e")).otherwise(F.lit(0.0)), 6).alias("sigma"),
    )


def _expected() -> Column:
    return (
        F.col("intercept") + F.col("slope") * _t("ds", "origin")
        + F.coalesce(F.try_element_at("effects", dow0("ds")), F.lit(0.0))
    )


def _bounded(rows: DataFrame, level: float, digits: int) -> DataFrame:
    # the nudge makes halves round up on every machine, whatever the order of the sums before
    half, expected = F.lit(Z_SCORES[level]) * F.col("sigma"), _expected() + 1e-9
    return rows.withColumn("forecast", F.round(expected, digits)).withColumn(
        "lower_bound", F.round(expected - half, digits)
    ).withColumn("upper_bound", F.round(expected + half, digits))


def predict(params: DataFrame, model_name: str, periods: int = 90, level: float = FORECAST_LEVEL, digits: int = 2) -> DataFrame:
    """``periods`` daily forecasts after the last trained day of each series."""
    horizon = F.sequence(F.date_add("last_ds", 1), F.date_add("last_ds", periods))
    return _bounded(params.withColumn("ds", F.explode(horizon)), level, digits).select(
        F.lit(model_name).alias("model_name"),
        "series",
        F.col("ds").cast("timestamp_ntz").alias("ts"),
        "forecast",
        "lower_bound",
        "upper_bound",
    )


def forecast(daily: DataFrame, model_name: str, cutoff: dt.date | str | None = None, periods: int = 90) -> DataFrame:
    """Fit on the days before the cut-off and predict ahead, for every series."""
    train = daily if cutoff is None else train_holdout_split(daily, cutoff)[0]
    return predict(fit(train), model_name, periods)


def detect_anomalies(
    daily: DataFrame,
    model_name: str,
    cutoff: dt.date | str,
    level: float = ANOMALY_LEVEL,
    digits: int = 2,
    fill_gaps: bool = True,
) -> DataFrame:
    """Fit on the days before the cut-off and judge the days from it on.

    With ``fill_gaps`` every fitted series is judged on every day up to the last one of the
    table, a day without a row counting as 0; otherwise only days with a row are judged. The
    days are laid out from the parameters, one row per series, and meet the rows by series and day.
    """
    train, later = train_holdout_split(daily, cutoff)
    observed = later.groupBy("series", "ds").agg(F.sum("y").alias("y"))
    last = observed.agg(F.max("ds")).scalar()
    params = fit(train, fill_gaps)
    days = params.withColumn("_last", last).where(F.col("_last").isNotNull()).withColumn(
        "ds", F.explode(F.sequence(F.lit(as_date(cutoff)), F.col("_last"))))
    judged = days.join(observed, ["series", "ds"], "left" if fill_gaps else "inner")
    if fill_gaps:
        judged = judged.withColumn("y", F.coalesce("y", F.lit(0.0)))
    unseen = observed.join(params.select("series"), "series", "left_anti")
    judged = judged.unionByName(unseen, allowMissingColumns=True)
    scored = _bounded(judged, level, digits)
    z = F.try_divide(F.col("y") - _expected(), F.col("sigma"))
    cdf = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(0.07056) * z * z * z + F.lit(1.5976) * z)))
    y = F.round("y", digits)
    return scored.select(
        F.lit(model_name).alias("model_name"),
        "series",
        F.col("ds").cast("timestamp_ntz").alias("ts"),
        y.alias("y"),
        "forecast",
        "lower_bound",
        "upper_bound",
        F.coalesce((y < F.col("lower_bound")) | (y > F.col("upper_bound")), F.lit(False)).alias("is_anomaly"),
        F.round(F.when(F.col("sigma").isNotNull(), F.coalesce(cdf, F.lit(0.5))), 4).alias("percentile"),
    )


def anomaly_deviation(anomalies: DataFrame) -> DataFrame:
    """Flagged days with actual, expected and deviation."""
    deviation = F.col("y") - F.col("forecast")
    return anomalies.where("is_anomaly").select(
        "model_name", "series", "ts", "y", "forecast",
        F.round(deviation, 2).alias("deviation"),
        F.round(F.try_divide(deviation * 100, F.abs("forecast")), 1).alias("deviation_pct"),
    )


def forecast_overlay(actuals: DataFrame, predicted: DataFrame) -> DataFrame:
    """Actual and predicted values as one typed series."""
    ahead = predicted.select(
        F.to_date("ts").alias("date"), F.col("forecast").alias("value"), F.lit("Forecast").alias("type")
    )
    return actuals.select("date", "value", "type").unionByName(ahead)


def chosen_rows(
    rows: DataFrame,
    model_name: str | None = None,
    series: Sequence[str] = (),
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
) -> DataFrame:
    """Forecast or anomaly rows of one model, a set of series and a date range; each filter is optional."""
    chosen = rows if model_name is None else rows.where(F.col("model_name") == model_name)
    if series:
        chosen = chosen.where(F.col("series").isin(*series))
    if start is not None:
        chosen = chosen.where(F.to_date("ts") >= as_date(start))
    return chosen if end is None else chosen.where(F.to_date("ts") <= as_date(end))


def forecast_coverage(predicted: DataFrame) -> DataFrame:
    return predicted.groupBy("model_name", "series").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n_periods")
    )


def forecast_backtest(daily: DataFrame, cutoff: dt.date | str, periods: int = 90) -> DataFrame:
    """Error and interval coverage of the forecast on the held-out days, per series."""
    train, held = train_holdout_split(daily, cutoff)
    ahead = predict(fit(train), "backtest", periods).withColumn("ds", F.to_date("ts"))
    joined = ahead.join(held, ["series", "ds"])
    error = F.abs(F.col("y") - F.col("forecast"))
    inside = F.col("y").between(F.col("lower_bound"), F.col("upper_bound"))
    return joined.groupBy("series").agg(
        F.count(F.lit(1)).alias("n_days"),
        F.round(F.avg(error), 2).alias("mae"),
        F.round(F.avg(F.try_divide(error * 100, F.abs("y"))), 2).alias("mape_pct"),
        ratio(F.count_if(inside) * 100, F.count(F.lit(1)), 2).alias("coverage_pct"),
    )


def feature_importance(daily: DataFrame) -> DataFrame:
    """Share of the variance within series that each calendar feature explains.

    Category features: between-group share of the sum of squares. The numeric
    trend: squared correlation with the day number. Ranked, ties by name.
    """
    features = {
        "day_of_week": dow0("ds").cast("string"),
        "month": F.month("ds").cast("string"),
        "is_weekend": is_weekend("ds").cast("string"),
        "is_holiday": is_holiday("ds").cast("string"),
    }
    whole = Window.partitionBy("series")
    centred = daily.select(
        "ds", (F.col("y") - F.avg("y").over(whole)).alias("d"),
        F.datediff("ds", F.min("ds").over(whole)).cast("double").alias("t"),
    )
    # one pass: a row per day and feature, reduced map-side to the feature's groups
    pairs = F.array(*[F.struct(F.lit(n).alias("feature_name"), v.alias("g")) for n, v in features.items()])
    groups = (
        centred.select("d", F.inline(pairs))
        .groupBy("feature_name", "g")
        .agg(F.sum("d").alias("s"), F.count(F.lit(1)).alias("n"), F.sum(F.col("d") * F.col("d")).alias("q"))
    )
    categories = groups.groupBy("feature_name").agg(
        F.try_divide(F.sum(F.col("s") * F.col("s") / F.col("n")), F.sum("q")).alias("score")
    ).select("feature_name", F.lit("category").alias("feature_type"), "score")
    trend = centred.agg(F.corr("t", "d").alias("r")).select(
        F.lit("trend").alias("feature_name"), F.lit("numeric").alias("feature_type"), (F.col("r") * F.col("r")).alias("score")
    )
    # a handful of features, never data rows
    order = Window.orderBy(F.desc("score"), F.asc("feature_name"))
    return (
        categories.unionByName(trend)
        .withColumn("score", F.round(F.coalesce("score", F.lit(0.0)), 6))
        .withColumn("rank", F.row_number().over(order))
    )


def rolling_zscore(daily: DataFrame, window_rows: int = 28, threshold: float = 3.0) -> DataFrame:
    """Distance of each day from the mean of its preceding rows, in standard deviations."""
    before = Window.partitionBy("series").orderBy("ds").rowsBetween(-window_rows, -1)
    full = F.count("y").over(before) == window_rows
    mean, spread = F.avg("y").over(before), F.stddev_samp("y").over(before)
    return (
        daily.withColumn("_z", F.when(full, F.try_divide(F.col("y") - mean, spread)))
        .select("series", "ds", "y", F.round("_z", 4).alias("zscore"))
        .withColumn("is_outlier", F.coalesce(F.abs("zscore") > threshold, F.lit(False)))
    )


def _half_up(values: np.ndarray) -> np.ndarray:
    """Two decimals, halves up; numpy's own rounding takes halves to the even digit."""
    return np.floor(values * 100 + 0.5000001) / 100


def naive_seasonal(history: pd.DataFrame, periods: int) -> pd.DataFrame:
    """Example of a pluggable model: the mean of the same weekday over the last four weeks."""
    history = history.sort_values("ds")
    days = pd.to_datetime(history["ds"])
    recent = history[days > days.max() - pd.Timedelta(days=28)]
    by_day = recent["y"].groupby(pd.to_datetime(recent["ds"]).dt.dayofweek)
    mean, spread = by_day.mean(), by_day.std().fillna(0.0)
    ahead = pd.date_range(days.max() + pd.Timedelta(days=1), periods=periods, freq="D")
    level = mean.reindex(ahead.dayofweek).fillna(recent["y"].mean()).to_numpy()
    half = Z_SCORES[FORECAST_LEVEL] * spread.reindex(ahead.dayofweek).fillna(0.0).to_numpy()
    return pd.DataFrame({
        "series": history["series"].iloc[0],
        "ts": ahead,
        "forecast": _half_up(level),
        "lower_bound": _half_up(level - half),
        "upper_bound": _half_up(level + half),
    })


def forecast_pandas(
    daily: DataFrame,
    model_name: str,
    model: Callable[[pd.DataFrame, int], pd.DataFrame] = naive_seasonal,
    periods: int = 90,
) -> DataFrame:
    """Any per-series pandas model, run by Spark series by series.

    A group is the daily aggregate of one series, bounded by the calendar.
    """
    schema = "series string, ts timestamp_ntz, forecast double, lower_bound double, upper_bound double"
    fitted = daily.select("series", "ds", "y").groupBy("series").applyInPandas(lambda pdf: model(pdf, periods), schema)
    return fitted.select(F.lit(model_name).alias("model_name"), *[F.col(f) for f in ("series", "ts", "forecast", "lower_bound", "upper_bound")])
