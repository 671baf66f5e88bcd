"""Prior and seasonal-naive forecasts, cold start, and checks on forecasts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.functions.joins import salted_join
from salescast.functions.quantiles import unit_quantiles
from salescast.operators.direct import direct_table
from salescast.schema import ID_COLS, q_names
from salescast.session import checkpointed

FORECAST_KEYS = [*ID_COLS, "origin", "horizon", "target_day"]
GROUP = ["store_id", "dept_id"]
CROSSING_TOLERANCE = 1e-6

# A forecaster maps direct-table rows to the same rows with quantile columns added.
Forecaster = Callable[[DataFrame], DataFrame]


def _tag_origins(features: DataFrame, origins: list[int], window: int) -> DataFrame:
    """Rows of the trailing window ``(origin - window, origin]`` of each origin."""
    hits = F.filter(
        F.array(*[F.lit(o) for o in origins]),
        lambda o: (F.col("d") <= o) & (F.col("d") > o - window),
    )
    oldest, newest = min(origins) - window, max(origins)
    near = features.where((F.col("d") > oldest) & (F.col("d") <= newest))
    return near.withColumn("origin", F.explode(hits))


def group_priors(features: DataFrame, origins: list[int], quantiles, window: int) -> DataFrame:
    """Exact unit quantiles of every store-department before each origin, in one job."""
    tagged = _tag_origins(features.select(*GROUP, "d", "sales"), origins, window)
    return unit_quantiles(tagged, ["origin", *GROUP], quantiles)


def cold_members(features: DataFrame, origin: int, min_history: int) -> DataFrame:
    """Identity of series with at least one, but fewer than ``min_history``, rows up to the origin."""
    return (
        features.where(F.col("d") <= origin)
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("n_days"), *[F.first(c).alias(c) for c in ID_COLS if c != "id"])
        .where(F.col("n_days") < min_history)
    )


def cold_series(features: DataFrame, origin: int, min_history: int) -> DataFrame:
    """(id, n_days) of :func:`cold_members`."""
    return cold_members(features, origin, min_history).select("id", "n_days")


def with_priors(rows: DataFrame, priors: DataFrame, quantiles) -> DataFrame:
    """Rows with the prior quantiles of their origin and group; an unseen group gets 0."""
    names = q_names(quantiles)
    joined = salted_join(rows, priors, ["origin", *GROUP], [F.col("id")])
    return joined.select(*rows.columns, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in names])


def cold_forecasts(
    cold: DataFrame, priors: DataFrame, origin: int, horizon: int, quantiles
) -> DataFrame:
    """The group prior of each cold series (with its identity), repeated over all horizons."""
    series = cold.select(*ID_COLS)
    flat = with_priors(series.withColumn("origin", F.lit(origin)), priors, quantiles)
    return flat.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).select(
        *ID_COLS, "origin", "horizon", (F.col("origin") + F.col("horizon")).alias("target_day"),
        *q_names(quantiles),
    )


def prior_forecaster(features: DataFrame, origins: list[int], quantiles, window: int) -> Forecaster:
    """Forecast every row with the store-department quantiles before its origin."""
    return from_priors(group_priors(features, origins, quantiles, window), quantiles)


def from_priors(priors: DataFrame, quantiles) -> Forecaster:
    """Forecast every row with the given quantiles of its origin and store-department."""
    return lambda rows: with_priors(rows, priors, quantiles)


def seasonal_naive_forecaster(
    features: DataFrame, origins: list[int], quantiles, season: int = 7
) -> Forecaster:
    """Repeat the last observed season; all quantiles are equal, an unseen day is 0."""
    recent = _tag_origins(features.select("id", "d", "sales"), origins, season)
    slot = F.col("d") - F.col("origin") + season
    seasons = recent.groupBy("id", "origin").agg(
        F.map_from_entries(F.collect_list(F.struct(slot.alias("slot"), "sales"))).alias("_season")
    )

    def transform(rows: DataFrame) -> DataFrame:
        joined = rows.join(seasons, ["id", "origin"], "left")
        value = F.coalesce(
            F.try_element_at("_season", (F.col("horizon") - 1) % season + 1), F.lit(0)
        ).cast("double")
        return joined.select(*rows.columns, *[value.alias(c) for c in q_names(quantiles)])

    return transform


def forecast_origin(
    features: DataFrame, forecaster: Forecaster, origin: int, horizon: int, quantiles
) -> DataFrame:
    """Quantile forecasts of every series that has a row right after the origin."""
    rows = direct_table(features, [origin], horizon)
    return forecaster(rows).select(*FORECAST_KEYS, *q_names(quantiles))


def catalogue(
    features: DataFrame, forecaster: Forecaster, origin: int, horizon: int, quantiles,
    min_history: int, priors: DataFrame,
) -> DataFrame:
    """All series: the model for warm ones, the group prior for cold ones, with a flag.

    The cold set is found once, with its identity, and written: it parts the features by an anti
    join and feeds the cold forecasts without another scan. A series with no row up to the
    origin is not in the counts, hence warm.
    """
    cold = checkpointed(cold_members(features, origin, min_history))
    warm_rows = features.join(cold.select("id"), "id", "left_anti")
    warm = forecast_origin(warm_rows, forecaster, origin, horizon, quantiles)
    chilly = cold_forecasts(cold, priors, origin, horizon, quantiles)
    return warm.withColumn("is_cold_start", F.lit(False)).unionByName(
        chilly.withColumn("is_cold_start", F.lit(True))
    )


def gate_columns(quantiles) -> list[Column]:
    """Row count, rows with a negative quantile, rows whose neighbouring quantiles cross."""
    names = q_names(quantiles)
    negative = F.coalesce(F.least(*[F.col(c) for c in names]) < 0, F.lit(False))
    crossing = F.lit(False)
    for lo, hi in zip(names, names[1:]):
        crossing = crossing | F.coalesce(F.col(hi) - F.col(lo) < -CROSSING_TOLERANCE, F.lit(False))
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(negative).alias("n_negative"),
        F.count_if(crossing).alias("n_crossing"),
    ]


def gate_counts(forecasts: DataFrame, quantiles) -> DataFrame:
    return forecasts.agg(*gate_columns(quantiles))


def refuse_bad(found: dict) -> None:
    """Raise on the counts of a batch with a negative or crossing forecast."""
    if found["n_negative"]:
        raise ValueError(f"forecasts rejected: {found['n_negative']} rows hold a negative quantile")
    if found["n_crossing"]:
        raise ValueError(f"forecasts rejected: quantiles cross in {found['n_crossing']} rows")


def check_forecasts(forecasts: DataFrame, quantiles) -> None:
    """Refuse a batch with a negative or crossing forecast."""
    refuse_bad(gate_counts(forecasts, quantiles).first().asDict())


def reassemble_checked(predictions: DataFrame, meta: DataFrame, quantiles) -> DataFrame:
    """Predictions beside their identity, matched by key because Spark rows have no position.

    Both sides meet in one aggregate on the key. A key that does not have exactly one row on each
    side stops the job that reads the result.
    """
    keys = ["id", "origin", "horizon"]
    names = q_names(quantiles)
    sides = meta.select(*FORECAST_KEYS, F.lit(1).alias("_m"), F.lit(0).alias("_p")).unionByName(
        predictions.select(*keys, *names, F.lit(0).alias("_m"), F.lit(1).alias("_p")), allowMissingColumns=True
    )
    rest = [c for c in [*FORECAST_KEYS, *names] if c not in keys]
    met = sides.groupBy(*keys).agg(
        F.sum("_m").alias("_m"), F.sum("_p").alias("_p"), *[F.max(c).alias(c) for c in rest]
    )
    partners = F.assert_true(
        (F.col("_m") == 1) & (F.col("_p") == 1), F.lit("row mismatch between predictions and their identity rows")
    )
    return met.where(partners.isNull()).select(*FORECAST_KEYS, *names)
