from bisect import bisect_right
from math import log

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescast.operators import drift as DR
from salescast.operators import forecast as FC
from salescast.operators import monitor as MO
from salescast.plans import jobs
from salescast.schema import Settings

QS = (0.05, 0.25, 0.5, 0.75, 0.95)
SMALL = Settings(horizon=5, prior_window=28, min_history=28)


def brute_psi(ref, cur, bins=10):
    """The index by its definition: cuts at interpolated ranks of the sorted reference, values counted one by one."""
    ordered = sorted(float(v) for v in ref)
    cuts = []
    for step in range(bins + 1):
        rank = step * (len(ordered) - 1) / bins
        below = min(int(rank), len(ordered) - 2)
        cut = ordered[below] + (ordered[below + 1] - ordered[below]) * (rank - below)
        if not cuts or cut > cuts[-1]:
            cuts.append(cut)
    if len(cuts) == 1:
        return 0.0
    inner, total = cuts[1:-1], 0.0
    tallies = [[0] * (len(inner) + 1) for _ in range(2)]
    for tally, values in zip(tallies, (ref, cur)):
        for v in values:
            tally[bisect_right(inner, float(v))] += 1
    for was, now in zip(*tallies):
        p, q = max(was / len(ref), 1e-6), max(now / len(cur), 1e-6)
        total += (q - p) * log(q / p)
    return total


def frames(spark, ref, cur, name="x"):
    make = lambda v: spark.createDataFrame([(None if x is None else float(x),) for x in v], f"{name} double")
    return make(ref), make(cur)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_psi_equals_histograms_with_ties(spark, seed):
    rng = np.random.default_rng(seed)
    ref, cur = rng.poisson(1.5, 701) / 7.0, rng.poisson(2.0, 530) / 7.0
    got = DR.psi(*frames(spark, ref, cur), "x").first()[0]
    assert got == pytest.approx(brute_psi(ref, cur), abs=1e-9)


def test_psi_levels(spark):
    rng = np.random.default_rng(42)
    base, same = rng.normal(0, 1, 2000), rng.normal(0, 1, 2000)
    assert DR.psi(*frames(spark, base, same), "x").first()[0] < 0.05
    assert DR.psi(*frames(spark, base, same + 3), "x").first()[0] > 0.25
    assert DR.psi(*frames(spark, np.full(50, 2.0), same), "x").first()[0] == 0.0
    assert DR.psi(*frames(spark, [None, None], same), "x").first()[0] == 0.0


def test_drift_table_flags_and_skips_absent_columns(spark):
    rng = np.random.default_rng(7)
    a, b = rng.normal(0, 1, 1000), rng.normal(5, 1, 1000)
    ref = spark.createDataFrame([(float(x), float(y), 1.0) for x, y in zip(a, a)], "x double, y double, z double")
    cur = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "x double, y double")
    got = {r["feature"]: r for r in DR.feature_drift(ref, cur, ["x", "y", "z"]).collect()}
    assert got.keys() == {"x", "y"}
    assert not got["x"]["drifted"] and got["y"]["drifted"] and got["x"]["psi"] == pytest.approx(0.0)


def archived(features, path, run_date="2024-01-02"):
    model = FC.prior_forecaster(features, [91], QS, 28)
    jobs.run_batch(features, model, path, run_date, "prior", "v1", SMALL)


def test_batch_archive_and_monitoring(spark, cold_rows, tmp_path):
    from salescast.sources.archive import latest_archive
    from salescast.sources.runs import read_run

    path = f"{tmp_path}/archive"
    archived(cold_rows, path)
    batch = latest_archive(spark, path)
    health = MO.operational_summary(batch).first()
    assert health["n_forecasts"] == 20 and health["n_series"] == 4 and health["n_cold_start_series"] == 1
    assert health["horizons"] == 5 and health["origin"] == 91 and health["run_date"] == "2024-01-02"
    # The cut series has no observed days after the origin, so only three series can be scored.
    scored = MO.score_forecasts(batch, cold_rows, QS).orderBy("horizon").collect()
    assert [r["horizon"] for r in scored] == [1, 2, 3, 4, 5] and {r["n"] for r in scored} == {3}
    jobs.run_monitoring(spark, cold_rows, path, f"{tmp_path}/out", SMALL)
    run = read_run(spark, f"{tmp_path}/out")
    head = run["headline"].first()
    assert head["n_scored"] == 15 and head["n_series"] == 4
    assert run["data_drift"].count() == 6 and run["operational"].count() == 1 and run["forecast_error"].count() == 5
    with pytest.raises(ValueError, match="committed already"):
        jobs.run_monitoring(spark, cold_rows, path, f"{tmp_path}/out", SMALL)


def test_nothing_observed_scores_minus_one(spark, feature_rows, tmp_path):
    path = f"{tmp_path}/archive"
    archived(feature_rows, path)
    batch = spark.read.parquet(path)
    early = feature_rows.where(F.col("d") <= 91)
    assert MO.score_forecasts(batch, early, QS).count() == 0
    head = MO.summary(batch, early, 91, SMALL)
    assert head.first()["forecast_wape"] == -1.0 and head.first()["n_scored"] == 0
    assert not MO.retrain_trigger(head).first()["retrain"]


def test_metric_rows(spark):
    head = spark.createDataFrame([(0.8, 0.3, 2, 10, 5)], "forecast_wape double, max_psi double, n_drifted long, n_scored long, n_series long")
    got = {r["metric"]: (r["value"], r["unit"]) for r in MO.metric_rows(head).collect()}
    assert got == {"ForecastWAPE": (0.8, "None"), "MaxPSI": (0.3, "None"), "DriftedFeatures": (2.0, "Count")}
    assert MO.retrain_trigger(head).first()["retrain"]
