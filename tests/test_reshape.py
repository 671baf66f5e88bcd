import numpy as np
import pandas as pd
from conftest import COLD, SERIES
from pyspark.sql import functions as F

from salescast.operators import reshape as R


def test_grid_fills_units_and_covariates(spark):
    rows = [("a", 2, 5, None, 1.0), ("a", 4, None, 7.0, None), ("a", 6, 3, 9.0, 2.0), ("b", 3, 1, 4.0, 4.0), ("b", 9, 8, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id string, d int, sales int, x double, y double")
    out = R.contiguous(df, 7, ["x", "y"]).toPandas().sort_values(["id", "d"])
    for key, g in df.toPandas().groupby("id"):
        full = g.set_index("d").reindex(range(int(g["d"].min()), 8))
        want_x, want_y = full["x"].ffill().bfill(), full["y"].ffill().bfill()
        got = out[out["id"] == key]
        assert list(got["d"]) == list(full.index)
        assert list(got["sales"]) == list(full["sales"].fillna(0))
        assert np.allclose(got["x"], want_x) and np.allclose(got["y"], want_y)


def test_random_grid_equals_a_plain_reindex(spark):
    rng = np.random.default_rng(5)
    rows = []
    for s in range(12):
        for d in sorted(rng.choice(np.arange(1, 60), 15, replace=False)):
            x = None if rng.random() < 0.4 else float(rng.integers(0, 9))
            rows.append((f"s{s}", int(d), int(rng.integers(0, 4)), x))
    df = spark.createDataFrame(rows, "id string, d int, sales int, x double")
    got = R.contiguous(df, 65, ["x"]).toPandas().sort_values(["id", "d"], ignore_index=True)
    parts = []
    for key, g in pd.DataFrame(rows, columns=["id", "d", "sales", "x"]).groupby("id"):
        full = g.set_index("d").reindex(range(int(g["d"].min()), 66))
        x = full["x"].astype(float).ffill().bfill().to_numpy()
        units = full["sales"].fillna(0).to_numpy()
        parts.append(pd.DataFrame({"id": key, "d": full.index.to_numpy(), "sales": units, "x": x}))
    want = pd.concat(parts).sort_values(["id", "d"], ignore_index=True)
    assert np.array_equal(got["d"], want["d"]) and np.array_equal(got["sales"], want["sales"])
    assert np.allclose(got["x"], want["x"], equal_nan=True)


def test_codes_are_sorted_dense_and_minus_one_for_missing(spark):
    df = spark.createDataFrame([("a", "Z"), ("b", "M"), ("c", None), ("d", "Z")], "id string, e string")
    got = {r["id"]: r["e_code"] for r in R.with_codes(df, ["e"]).collect()}
    assert got == {"a": 1, "b": 0, "c": -1, "d": 1}


def test_cap_is_reproducible_and_zero_keeps_all(feature_rows):
    one = {r[0] for r in R.cap_series(feature_rows, 2, 42).select("id").distinct().collect()}
    two = {r[0] for r in R.cap_series(feature_rows.repartition(7), 2, 42).select("id").distinct().collect()}
    assert one == two and len(one) == 2
    assert R.cap_series(feature_rows, 0, 42).count() == feature_rows.count()
    assert R.cap_series(feature_rows, 9, 42).count() == feature_rows.count()


def test_eligible_series_need_history(cold_rows):
    got = {r["id"] for r in R.eligible_series(cold_rows, 47, 33, 5, 42).collect()}
    assert got == set(SERIES) - {COLD}


def test_state_filter(feature_rows):
    assert R.only_state(feature_rows, "OR").count() == 288
    assert R.only_state(feature_rows, "TX").count() == 0
    assert R.only_state(feature_rows, "").count() == 384


def test_history_window_cuts_and_skips_series_without_history(spark):
    rows = [("a", d, d, 1.0) for d in range(1, 21)] + [("late", d, d, 2.0) for d in range(16, 21)]
    df = spark.createDataFrame(rows, "id string, d int, sales int, x double")
    out = R.history_windows(df, 15, 3, 10, ["x"]).toPandas()
    assert set(out["id"]) == {"a"}
    assert sorted(out["d"]) == list(range(6, 19))
    assert out.loc[out["d"] > 15, "sales"].isna().all()
    assert list(out[out["d"] <= 15].sort_values("d")["sales"]) == list(range(6, 16))


def test_label_frame(spark):
    df = spark.createDataFrame([("CA_1", "F", 0), ("CA_1", "F", 3), ("TX_2", "F", 5), ("TX_2", "F", 0)], "store_id string, dept_id string, sales int")
    got = [(r["sold"], r["state_id"]) for r in R.label_frame(df).collect()]
    assert got == [(0, "CA"), (1, "CA"), (1, "TX"), (0, "TX")]


def test_sample_has_record_id_and_event_time(feature_rows):
    out = R.feature_sample(feature_rows, "2014-03-05", 5).orderBy("d").collect()
    assert len(out) == 5 and out[0]["record_id"] == "elm-east_1"
    assert out[0]["event_time"] == "2014-03-05T00:00:00Z" and out[1]["event_time"] == "2014-03-06T00:00:00Z"


def test_as_of_never_looks_ahead(cold_rows):
    got = {r["id"]: r["d"] for r in R.as_of(cold_rows, 40, ["sales"]).collect()}
    assert got == dict.fromkeys(SERIES, 40) | {COLD: 10}
    top = R.newest_rows(cold_rows, "2014-03-08T00:00:00Z", "2014-03-05", 5).collect()
    assert [r["d"] for r in top] == [4, 4, 4, 4, 3]


def test_calendar_export_writes_iso_dates(calendar):
    assert R.calendar_export(calendar).orderBy("date").first()["date"] == "2014-03-05"
    assert dict(R.calendar_export(calendar).dtypes)["date"] == "string"
