import numpy as np
import pandas as pd
import pytest
from conftest import COLD, SERIES, units
from pyspark.sql import functions as F

from salescast.operators import direct as D
from salescast.operators import forecast as FC
from salescast.plans.backtest import backtest, refit_backtest
from salescast.schema import Settings, q_names

QS = (0.05, 0.5, 0.95)
NAMES = q_names(QS)


def test_cold_start_counts_rows_up_to_the_origin(cold_rows):
    cold = lambda least: {r["id"] for r in FC.cold_series(cold_rows, 91, least).collect()}
    assert cold(28) == {COLD} and cold(5) == set()


def test_series_without_any_row_is_not_cold(feature_rows):
    late = feature_rows.where((F.col("id") != "oak-west") | (F.col("d") > 91))
    assert {r["id"] for r in FC.cold_series(late, 91, 28).collect()} == set()
    model = FC.prior_forecaster(late, [91], QS, 28)
    out = FC.catalogue(late, model, 91, 5, QS, 28, FC.group_priors(late, [91], QS, 28))
    assert out.where((F.col("id") == "oak-west") & ~F.col("is_cold_start")).count() == 5


def test_priors_are_linear_quantiles_of_the_window(feature_rows):
    row = FC.group_priors(feature_rows, [40], QS, 28).where("store_id = 'OR_4'").first()
    values = [units(s, d) for d in range(13, 41) for s in SERIES if s != "oak-west"]
    assert np.allclose([row[c] for c in NAMES], np.quantile(values, QS))


def test_priors_of_many_origins_equal_one_by_one(feature_rows):
    both = {(r["origin"], r["store_id"]): r for r in FC.group_priors(feature_rows, [30, 40, 44], QS, 28).collect()}
    for o in (30, 40, 44):
        for r in FC.group_priors(feature_rows, [o], QS, 28).collect():
            assert both.pop((o, r["store_id"])) == r
    assert not both


def test_catalogue_covers_warm_and_cold(cold_rows):
    priors = FC.group_priors(cold_rows, [91], QS, 28)
    out = FC.catalogue(cold_rows, FC.from_priors(priors, QS), 91, 5, QS, 28, priors).toPandas()
    assert len(out) == 5 * len(SERIES) and not out.duplicated(["id", "horizon"]).any()
    assert set(out.loc[out["is_cold_start"], "id"]) == {COLD}
    assert (out["target_day"] == out["origin"] + out["horizon"]).all()
    assert (out[NAMES].to_numpy() >= 0).all() and (np.diff(out[NAMES].to_numpy(), axis=1) >= 0).all()


def test_cold_series_of_an_unseen_group_get_zero(cold_rows):
    moved = cold_rows.withColumn("store_id", F.when(F.col("id") == COLD, "NV_9").otherwise(F.col("store_id")))
    cold = FC.cold_members(moved, 91, 28)
    priors = FC.group_priors(moved, [91], QS, 28)
    out = FC.cold_forecasts(cold, priors, 91, 5, QS)
    assert out.count() == 5 and {tuple(r) for r in out.select(*NAMES).collect()} == {(0.0, 0.0, 0.0)}


def test_seasonal_naive_repeats_the_last_week(feature_rows):
    out = FC.forecast_origin(feature_rows, FC.seasonal_naive_forecaster(feature_rows, [40], QS), 40, 16, QS)
    for r in out.collect():
        assert r["q05"] == r["q50"] == r["q95"] == units(r["id"], 34 + (r["horizon"] - 1) % 7)


def frame(spark, q):
    return spark.createDataFrame([("a", *q)], "id string, q05 double, q50 double, q95 double")


def test_gate_refuses_negative_and_crossing(spark):
    FC.check_forecasts(frame(spark, (0.0, 1.0, 2.0)), QS)
    FC.check_forecasts(frame(spark, (0.0, 1.0, 1.0 - 5e-7)), QS)
    FC.check_forecasts(frame(spark, (None, 1.0, 2.0)), QS)
    with pytest.raises(ValueError, match="negative"):
        FC.check_forecasts(frame(spark, (-0.1, 1.0, 2.0)), QS)
    with pytest.raises(ValueError, match="cross"):
        FC.check_forecasts(frame(spark, (0.0, 1.0, 0.9)), QS)


def test_reassemble_needs_one_partner_per_row(feature_rows):
    table = D.direct_table(feature_rows, [40], 5)
    meta = table.select(*FC.FORECAST_KEYS)
    preds = FC.prior_forecaster(feature_rows, [40], QS, 28)(table).select("id", "origin", "horizon", *NAMES)
    assert FC.reassemble_checked(preds, meta, QS).count() == 5 * len(SERIES)
    for broken in (preds.where(F.col("horizon") > 1), preds.unionByName(preds.where(F.col("horizon") == 1))):
        with pytest.raises(Exception, match="mismatch"):
            FC.reassemble_checked(broken, meta, QS).count()


def test_backtest_in_one_job_equals_fold_by_fold(feature_rows):
    folds = [63, 91]
    whole = backtest(feature_rows, FC.prior_forecaster(feature_rows, folds, QS, 28), folds, 5, QS).toPandas()
    single = [backtest(feature_rows, FC.prior_forecaster(feature_rows, [f], QS, 28), [f], 5, QS).toPandas() for f in folds]
    key = ["id", "origin", "horizon"]
    want = pd.concat(single).sort_values(key, ignore_index=True)
    pd.testing.assert_frame_equal(whole.sort_values(key, ignore_index=True), want)
    assert list(whole["actual"]) == [units(i, d) for i, d in zip(whole["id"], whole["target_day"])]


def test_refit_sees_only_targets_up_to_the_fold(feature_rows):
    seen = []

    def fit(table):
        seen.append(table.agg(F.max("target_day")).first()[0])
        return FC.prior_forecaster(feature_rows, [63, 91], QS, 28)

    settings = Settings(horizon=5, quantiles=QS, n_train_origins=3, origin_stride=14)
    out = refit_backtest(feature_rows, fit, [3, 63, 91], settings)
    assert seen == [63, 91] and out.count() == 10 * len(SERIES)
    with pytest.raises(ValueError):
        refit_backtest(feature_rows, fit, [3], settings)
