"""Forecast metrics as aggregate column expressions; an undefined metric is NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescast.schema import INTERVALS, q_name


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def wape(actual: Column | str, predicted: Column | str) -> Column:
    """Sum of absolute errors over the sum of absolute actuals; NULL when that sum is 0."""
    a, p = _c(actual).cast("double"), _c(predicted).cast("double")
    volume = F.sum(F.abs(a))
    return F.when(volume > 0, F.sum(F.abs(a - p)) / volume)


def pinball(actual: Column | str, predicted: Column | str, q: float) -> Column:
    """Mean quantile loss at ``q``."""
    err = _c(actual).cast("double") - _c(predicted)
    return F.avg(F.greatest(F.lit(q) * err, F.lit(q - 1.0) * err))


def mean_pinball(actual: Column | str, quantiles) -> Column:
    """Average of the pinball losses of the quantile columns."""
    qs = sorted(quantiles)
    total = pinball(actual, q_name(qs[0]), qs[0])
    for q in qs[1:]:
        total = total + pinball(actual, q_name(q), q)
    return total / F.lit(float(len(qs)))


def coverage(actual: Column | str, lower: Column | str, upper: Column | str) -> Column:
    """Share of actuals inside the closed interval."""
    inside = _c(actual).between(_c(lower), _c(upper))
    return F.avg(F.when(inside, F.lit(1.0)).otherwise(F.lit(0.0)))


def interval_coverages(actual: Column | str, columns: list[str]) -> list[Column]:
    """``coverage_50`` and ``coverage_90`` for the intervals whose columns exist."""
    out = []
    for nominal, (lo, hi) in INTERVALS.items():
        if q_name(lo) in columns and q_name(hi) in columns:
            out.append(coverage(actual, q_name(lo), q_name(hi)).alias(f"coverage_{nominal}"))
    return out


def scaled_mae(actual: Column | str, predicted: Column | str, scale: Column) -> Column:
    """MASE: mean absolute error over the seasonal-naive error; NULL unless scale > 0."""
    err = F.avg(F.abs(_c(actual).cast("double") - _c(predicted)))
    return F.when(scale > 0, err / scale)


def scaled_rmse(actual: Column | str, predicted: Column | str, scale: Column) -> Column:
    """RMSSE: root of the mean squared error over the naive MSE; NULL unless scale > 0."""
    diff = _c(actual).cast("double") - _c(predicted)
    return F.when(scale > 0, F.sqrt(F.avg(diff * diff) / scale))


def naive_scales(history: DataFrame, keys: list[str], season: int = 7) -> DataFrame:
    """Per group: mean |y - y[-season]| and mean (y - y[-1])^2 over rows ordered by day.

    The offset counts rows, so a group holds at most one row per day of history. Groups too
    short for an offset get NULL.
    """
    by_day = Window.partitionBy(*keys).orderBy("d")
    y = F.col("sales").cast("double")
    steps = history.select(
        *keys,
        F.abs(y - F.lag(y, season).over(by_day)).alias("_season"),
        F.pow(y - F.lag(y, 1).over(by_day), F.lit(2.0)).alias("_step"),
    )
    return steps.groupBy(*keys).agg(
        F.avg("_season").alias("seasonal_mae"), F.avg("_step").alias("naive_mse")
    )


def weighted_mean(value: Column | str, weight: Column | str) -> Column:
    """Weighted mean over the rows whose value is known; NULL when their weight is 0."""
    v, w = _c(value), _c(weight)
    mass = F.sum(F.when(v.isNotNull(), w))
    return F.when(mass != 0, F.sum(v * w) / mass)
