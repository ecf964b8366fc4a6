"""Forecasts from trend, weekday, holiday and season at once, and what each of them is worth.

Every day of a series gives a short vector of calendar features. All that least squares needs of the days are the sums
of the products of these features with each other and with the value (the Gram matrix): plain sums, reduced map-side,
one row per series whatever its length, and mergeable. The small systems are then solved per series by elimination on
arrays, inside the JVM.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.functions.calendar import HOLIDAYS, dow0, is_holiday, is_weekend
from martlens.operators.series import FORECAST_LEVEL, Z_SCORES, densify, train_holdout_split

YEAR = 365.25
ORIGIN = dt.date(2000, 1, 1)

#: Added to the diagonal for every feature but the level and the trend: as much as one day that says "no effect".
RIDGE = 1.0

#: Days below which a season of the year is not fitted.
SEASON_DAYS = 365


def design(ds: Column, holidays: Sequence[str] = HOLIDAYS, weekend: bool = False) -> list[tuple[str, Column]]:
    """(feature, value) for each column of the model; several columns can belong to one feature."""
    years = F.datediff(ds, F.lit(ORIGIN)) / YEAR
    angle = F.dayofyear(ds) * (2 * math.pi / YEAR)
    columns = [("level", F.lit(1.0)), ("trend", years)]
    columns += [("day_of_week", (dow0(ds) == k).cast("double")) for k in range(1, 7)]
    columns += [("is_weekend", is_weekend(ds).cast("double"))] if weekend else []
    columns += [("is_holiday", is_holiday(ds, tuple(holidays)).cast("double"))]
    return columns + [("season", f(angle * h)) for h in (1, 2) for f in (F.sin, F.cos)]


def gram(daily: DataFrame, holidays: Sequence[str] = HOLIDAYS, weekend: bool = False) -> DataFrame:
    """One row per series: g (matrix of feature products), b (products with y), yy, n, first and last day."""
    columns = design(F.col("ds"), holidays, weekend)
    k = len(columns)
    rows = daily.where("y is not null").select("series", "ds", "y", *[c.alias(f"x{i}") for i, (_, c) in enumerate(columns)])
    sums = rows.groupBy("series").agg(
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"g{i}_{j}") for i in range(k) for j in range(i + 1)],
        *[F.sum(F.col(f"x{i}") * F.col("y")).alias(f"b{i}") for i in range(k)],
        F.sum(F.col("y") * F.col("y")).alias("yy"), F.count(F.lit(1)).alias("n"), F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"))
    matrix = F.array(*[F.array(*[F.col(f"g{max(i, j)}_{min(i, j)}") for j in range(k)]) for i in range(k)])
    return sums.select("series", matrix.alias("g"), F.array(*[F.col(f"b{i}") for i in range(k)]).alias("b"), "yy", "n", "first_ds", "last_ds")


def solved(g: Column, b: Column, ridge: Sequence[float], used: Column | None = None) -> Column:
    """Coefficients of (g + diag(ridge)) x = b by elimination; a feature with ``used`` false gets 0.

    The matrix is positive definite by the ridge, so no rows need to be exchanged.
    """
    penalty = F.array(*[F.lit(float(r)) for r in ridge])
    keep = F.array(*[F.lit(True)] * len(ridge)) if used is None else used

    def row(values: Column, i: Column) -> Column:
        own = F.transform(values, lambda v, j: F.when(F.get(keep, i) & F.get(keep, j), v + F.when(i == j, F.get(penalty, i)).otherwise(0.0))
                          .otherwise(F.when(i == j, 1.0).otherwise(0.0)))
        return F.concat(own, F.array(F.when(F.get(keep, i), F.get(b, i)).otherwise(0.0)))

    def eliminate(m: Column, p: Column) -> Column:
        head = F.transform(F.get(m, p), lambda v: v / F.get(F.get(m, p), p))
        return F.transform(m, lambda r, i: F.when(i == p, head).otherwise(F.zip_with(r, head, lambda x, h: x - F.get(r, p) * h)))

    steps = F.sequence(F.lit(0), F.lit(len(ridge) - 1))
    return F.transform(F.aggregate(steps, F.transform(g, row), eliminate), lambda r: F.get(r, F.lit(len(ridge))))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def _unexplained(x: Column) -> Column:
    """Sum of squared residuals of the coefficients ``x``, from the sums alone."""
    return F.greatest(F.col("yy") - 2 * _dot(x, F.col("b")) + _dot(x, F.transform("g", lambda r: _dot(r, x))), F.lit(0.0))


def fit_calendar(daily: DataFrame, holidays: Sequence[str] = HOLIDAYS, fill_gaps: bool = True) -> DataFrame:
    """(series, last_ds, coefficients, sigma).

    A season of the year is fitted for series that span at least ``SEASON_DAYS`` days, and kept if it lowers the
    Bayesian information criterion; both fits come from the same sums.
    """
    names = [n for n, _ in design(F.lit(ORIGIN), holidays)]
    ridge = [1e-9 if n in ("level", "trend") else RIDGE for n in names]
    n_season = names.count("season")
    sums = gram(densify(daily) if fill_gaps else daily, holidays)
    plain = F.array(*[F.lit(n != "season") for n in names])
    both = sums.withColumn("_plain", solved(F.col("g"), F.col("b"), ridge, plain)).withColumn("_full", solved(F.col("g"), F.col("b"), ridge))
    rated = both.withColumn("_left_plain", _unexplained(F.col("_plain"))).withColumn("_left_full", _unexplained(F.col("_full")))
    gain = F.col("n") * F.ln(F.try_divide(F.col("_left_plain"), F.col("_left_full")))
    season = (F.datediff("last_ds", "first_ds") + 1 >= SEASON_DAYS) & F.coalesce(gain > n_season * F.ln("n"), F.lit(False))
    chosen = rated.withColumn("_season", season)
    left = F.when(F.col("_season"), F.col("_left_full")).otherwise(F.col("_left_plain"))
    free = F.greatest(F.col("n") - F.when(F.col("_season"), len(names)).otherwise(len(names) - n_season), F.lit(1))
    return chosen.select("series", "last_ds", F.when(F.col("_season"), F.col("_full")).otherwise(F.col("_plain")).alias("coefficients"),
                         F.sqrt(left / free).alias("sigma"))


def forecast_calendar(
    daily: DataFrame, model_name: str, cutoff: dt.date | str | None = None, periods: int = 90,
    holidays: Sequence[str] = HOLIDAYS, level: float = FORECAST_LEVEL,
) -> DataFrame:
    """``periods`` daily forecasts with bounds after the last trained day of every series."""
    train = daily if cutoff is None else train_holdout_split(daily, cutoff)[0]
    ahead = fit_calendar(train, holidays).withColumn("ds", F.explode(F.sequence(F.date_add("last_ds", 1), F.date_add("last_ds", periods))))
    expected = _dot(F.col("coefficients"), F.array(*[c for _, c in design(F.col("ds"), holidays)]))
    half = F.lit(Z_SCORES[level]) * F.col("sigma")
    return ahead.withColumn("_f", expected).select(
        F.lit(model_name).alias("model_name"), "series", F.col("ds").cast("timestamp_ntz").alias("ts"), F.round("_f", 2).alias("forecast"),
        F.round(F.col("_f") - half, 2).alias("lower_bound"), F.round(F.col("_f") + half, 2).alias("upper_bound"))


def calendar_backtest(daily: DataFrame, cutoff: dt.date | str, periods: int = 90, holidays: Sequence[str] = HOLIDAYS) -> DataFrame:
    """Error and interval coverage on the held-out days, per series."""
    held = train_holdout_split(daily, cutoff)[1]
    ahead = forecast_calendar(daily, "backtest", cutoff, periods, holidays).withColumn("ds", F.to_date("ts"))
    joined = ahead.join(held, ["series", "ds"])
    inside = F.col("y").between(F.col("lower_bound"), F.col("upper_bound"))
    return joined.groupBy("series").agg(
        F.count(F.lit(1)).alias("n_days"), F.round(F.avg(F.abs(F.col("y") - F.col("forecast"))), 2).alias("mae"),
        F.round(F.avg(inside.cast("double")) * 100, 2).alias("coverage_pct"))


def feature_loss(daily: DataFrame, holidays: Sequence[str] = HOLIDAYS) -> DataFrame:
    """Share of the variance within series that is no longer explained when one feature leaves the model.

    Features that overlap share nothing twice: what a weekday says of the weekend counts for neither. All fits use
    blocks of one Gram matrix, in which each series is centred on its own mean.
    """
    columns = [n for n, _ in design(F.lit(ORIGIN), holidays, weekend=True)]
    names, k = columns[1:], len(columns) - 1
    sums = gram(daily, holidays, weekend=True)

    def centred(i: int, j: int) -> Column:
        return F.sum(sums["g"][i][j] - sums["g"][i][0] * sums["g"][j][0] / sums["n"])

    pooled = sums.agg(
        F.array(*[F.array(*[centred(i, j) for j in range(1, k + 1)]) for i in range(1, k + 1)]).alias("g"),
        F.array(*[F.sum(sums["b"][i] - sums["g"][i][0] * sums["b"][0] / sums["n"]) for i in range(1, k + 1)]).alias("b"),
        F.sum(sums["yy"] - sums["b"][0] * sums["b"][0] / sums["n"]).alias("yy"))
    features = list(dict.fromkeys(names))
    masks = F.array(*[F.struct(F.lit(f).alias("feature_name"), F.array(*[F.lit(n != f) for n in names]).alias("used")) for f in features])
    ridge = [1e-6] * k
    each = pooled.where("yy > 0").select("g", "b", "yy", F.inline(masks))
    full, without = solved(F.col("g"), F.col("b"), ridge), solved(F.col("g"), F.col("b"), ridge, F.col("used"))
    loss = (_dot(full, F.col("b")) - _dot(without, F.col("b"))) / F.col("yy")
    return each.select("feature_name", F.when(F.col("feature_name") == "trend", "numeric").otherwise("category").alias("feature_type"),
                       F.round(F.greatest(loss, F.lit(0.0)), 6).alias("score"))
