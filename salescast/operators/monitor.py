"""Monitoring of an archived batch: health, forecast error, headline and retrain flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.functions import metrics as M
from salescast.operators.drift import drift_windows, feature_drift
from salescast.schema import MEDIAN, MONITORED_COLS, Settings

NOT_SCORABLE = -1.0
RETRAIN_WAPE = 0.75


def operational_summary(archive: DataFrame) -> DataFrame:
    """One health row per batch: rows, series, cold series, horizons, run and origin.

    Run, version and origin are constant within a batch, so any row's value serves.
    """
    cold = F.col("is_cold_start") if "is_cold_start" in archive.columns else F.lit(False)

    def tag(column: str):
        value = F.max(F.col(column).cast("string")) if column in archive.columns else F.lit(None).cast("string")
        return value.alias(column)

    return archive.agg(
        tag("run_date"),
        tag("model_version"),
        F.max("origin").alias("origin"),
        F.count(F.lit(1)).alias("n_forecasts"),
        F.countDistinct("id").alias("n_series"),
        F.countDistinct(F.when(cold, F.col("id"))).alias("n_cold_start_series"),
        F.countDistinct("horizon").alias("horizons"),
    )


def with_actuals(archive: DataFrame, features: DataFrame) -> DataFrame:
    """Archived forecasts whose target day has been observed.

    The feature scan is cut to the batch's target days first, so that only those days are
    shuffled and not the whole history.
    """
    first = archive.agg(F.min("target_day")).scalar()
    last = archive.agg(F.max("target_day")).scalar()
    actuals = features.where((F.col("d") >= first) & (F.col("d") <= last)).select(
        "id", F.col("d").alias("target_day"), F.col("sales").alias("actual")
    )
    return archive.join(actuals, ["id", "target_day"])


def score_forecasts(archive: DataFrame, features: DataFrame, quantiles) -> DataFrame:
    """Rows, WAPE, pinball and coverages per horizon; no row when nothing is observed yet."""
    scored = with_actuals(archive, features)
    return scored.groupBy("horizon").agg(
        F.count(F.lit(1)).alias("n"),
        M.wape("actual", MEDIAN).alias("wape"),
        M.mean_pinball("actual", quantiles).alias("pinball"),
        *M.interval_coverages("actual", archive.columns),
    )


def drift_table(features: DataFrame, last: int, window: int) -> DataFrame:
    reference, current = drift_windows(features, last, window)
    return feature_drift(reference, current, MONITORED_COLS)


def summary(archive: DataFrame, features: DataFrame, last: int, settings: Settings = Settings()) -> DataFrame:
    """One row: overall WAPE (-1 when nothing can be scored), worst PSI and the counts."""
    error = with_actuals(archive, features).agg(
        M.wape("actual", MEDIAN).alias("wape"), F.count(F.lit(1)).alias("n_scored")
    )
    drift = drift_table(features, last, settings.drift_window).agg(
        F.max("psi").alias("max_psi"), F.count_if("drifted").alias("n_drifted")
    )
    series = archive.agg(F.countDistinct("id").alias("n_series"))
    rows = error.unionByName(drift, True).unionByName(series, True)
    one = rows.agg(*[F.max(c).alias(c) for c in rows.columns])
    return one.select(
        F.when(F.col("n_scored") == 0, F.lit(NOT_SCORABLE)).otherwise(F.col("wape")).alias("forecast_wape"),
        F.coalesce("max_psi", F.lit(0.0)).alias("max_psi"),
        "n_drifted", "n_scored", "n_series",
    )


def metric_rows(headline: DataFrame) -> DataFrame:
    """The headline as (metric, value, unit) rows."""
    named = [
        ("ForecastWAPE", "forecast_wape", "None"),
        ("MaxPSI", "max_psi", "None"),
        ("DriftedFeatures", "n_drifted", "Count"),
    ]
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("metric"), F.col(c).cast("double").alias("value"), F.lit(unit).alias("unit")
        )
        for name, c, unit in named
    ])
    return headline.select(F.inline(rows))


def retrain_trigger(headline: DataFrame, line: float = RETRAIN_WAPE) -> DataFrame:
    """Retrain when the forecast WAPE exceeds the line."""
    return headline.select("forecast_wape", (F.col("forecast_wape") > line).alias("retrain"))
