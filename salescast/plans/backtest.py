"""Rolling-origin backtests."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.operators.boosting import BoostParams, Fit, fit_together, score_each
from salescast.operators.direct import direct_table, train_origins
from salescast.operators.forecast import Forecaster
from salescast.schema import ID_COLS, Settings, q_names


def prediction_frame(scored: DataFrame, quantiles) -> DataFrame:
    """Identity, origin, horizon, target day, actual and quantiles."""
    return scored.select(
        *ID_COLS, "origin", "horizon", "target_day", F.col("sales").alias("actual"), *q_names(quantiles)
    )


def backtest(
    features: DataFrame, forecaster: Forecaster, folds: list[int], horizon: int, quantiles
) -> DataFrame:
    """All folds of a forecaster that needs no fit, in one job over one direct table."""
    return prediction_frame(forecaster(direct_table(features, folds, horizon)), quantiles)


def refit_backtest(
    features: DataFrame, fit: Callable[[DataFrame], Forecaster], folds: list[int], settings: Settings
) -> DataFrame:
    """Any forecaster refitted before every fold on origins whose targets end by then, fold by fold.

    The loop runs over the few folds; every fit and every scoring is a distributed job. A fold
    without a usable training origin is left out. :func:`boost_backtest` fits all folds at once.
    """
    frames = []
    for fold in folds:
        known = train_origins(fold, settings.n_train_origins, settings.origin_stride, settings.horizon)
        if not known:
            continue
        model = fit(direct_table(features, known, settings.horizon))
        test = direct_table(features, [fold], settings.horizon)
        frames.append(prediction_frame(model(test), settings.quantiles))
    if not frames:
        raise ValueError(f"no fold of {folds} has a training origin")
    return reduce(DataFrame.unionByName, frames)


def boost_backtest(features: DataFrame, folds: list[int], settings: Settings, params: BoostParams) -> DataFrame:
    """The boosted model refitted for every fold, all folds in the same jobs.

    A fold trains on origins whose targets end by then; the folds' training rows overlap and are built,
    binned and scanned once. Cuts and categories come from the oldest fold, so none sees a later
    one. A fold without a usable training origin is left out.
    """
    known = {f: train_origins(f, settings.n_train_origins, settings.origin_stride, settings.horizon) for f in folds}
    known = {f: o for f, o in sorted(known.items()) if o}
    if not known:
        raise ValueError(f"no fold of {folds} has a training origin")
    table = direct_table(features, sorted({o for each in known.values() for o in each}), settings.horizon)
    fits = {f: Fit(params, F.col("origin").isin(o)) for f, o in known.items()}
    models = fit_together(table, settings.quantiles, fits)
    test = direct_table(features, list(known), settings.horizon)
    return prediction_frame(score_each(test, models, F.col("origin")), settings.quantiles)
