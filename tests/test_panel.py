"""The panel against a plain per-group loop on a small random frame."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from salescast.operators import panel as P
from salescast.schema import LEVELS


@pytest.fixture(scope="module")
def small():
    rng = np.random.default_rng(3)
    history, preds = [], []
    for s, store in enumerate(["CA_1", "CA_2", "TX_1"]):
        for i, dept in enumerate(["FOODS_1", "FOODS_2", "HOBBIES_1"]):
            ids = (f"{dept}_{store}", f"{dept}_00", dept, dept.split("_")[0], store, store[:2])
            flat = s == 2 and i == 2  # constant history: no scale
            length = 5 if s == 1 and i == 1 else 60  # too short for the season
            for d in range(61 - length, 61):
                history.append((*ids, d, 2 if flat else int(rng.integers(0, 6)), None if s == 0 and d < 40 else 1.5 + i))
            for origin in (60, 63):  # overlapping folds
                for h in range(1, 6):
                    q = np.sort(rng.gamma(2, 1, 5))
                    preds.append((*ids, origin, h, origin + h, int(rng.integers(0, 6)), *map(float, q)))
    cols = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]
    return (
        pd.DataFrame(history, columns=[*cols, "d", "sales", "sell_price"]),
        pd.DataFrame(preds, columns=[*cols, "origin", "horizon", "target_day", "actual", "q05", "q25", "q50", "q75", "q95"]),
    )


def brute(history, preds):
    recent = history[history["d"] > history["d"].max() - 28]
    weight = (recent["sell_price"] * recent["sales"]).groupby(recent["id"]).sum()
    out = {}
    for name, keys in LEVELS.items():
        h, p = history.assign(k="all"), preds.assign(k="all")
        by = keys or ["k"]
        rows = []
        for key, g in p.groupby(by):
            key = key if isinstance(key, tuple) else (key,)
            daily = g.groupby("target_day")[["actual", "q50"]].sum()
            part = h[(h[by] == list(key)).all(axis=1)].groupby("d")["sales"].sum().sort_index().to_numpy(float)
            smae = np.abs(part[7:] - part[:-7]).mean() if len(part) > 7 else np.nan
            nmse = (np.diff(part) ** 2).mean() if len(part) > 1 else np.nan
            err = (daily["actual"] - daily["q50"]).to_numpy()
            w = 1.0 if not keys else sum(weight.get(i, 0.0) for i in g["id"].unique())
            rows.append((np.abs(err).sum(), daily["actual"].abs().sum(),
                         np.abs(err).mean() / smae if smae > 0 else np.nan,
                         np.sqrt((err ** 2).mean() / nmse) if nmse > 0 else np.nan, w))
        ae, vol, mase, rmsse, w = map(np.array, zip(*rows))

        def mean(x):
            ok = ~np.isnan(x)
            return np.average(x[ok], weights=w[ok])

        out[name] = (len(rows), ae.sum() / vol.sum(), mean(mase), mean(rmsse))
    return out


def spark_frames(spark, small):
    schema = "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, "
    history = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in small[0].itertuples(index=False)]
    h = spark.createDataFrame(history, schema + "d int, sales int, sell_price double")
    p = spark.createDataFrame(
        list(small[1].itertuples(index=False, name=None)),
        schema + "origin int, horizon int, target_day int, actual int, q05 double, q25 double, q50 double, q75 double, q95 double",
    )
    return h, p


def test_levels_equal_a_loop_over_groups(spark, small):
    h, p = spark_frames(spark, small)
    got = {r["level"]: r for r in P.by_level(p, h).collect()}
    want = brute(*small)
    assert got.keys() == want.keys()
    for level, (n, *metrics) in want.items():
        assert got[level]["n_groups"] == n
        assert np.allclose([got[level][m] for m in ("wape", "mase", "rmsse")], metrics)


def test_horizon_calibration_and_headline(spark, small):
    h, p = spark_frames(spark, small)
    panel = P.build_panel(p, h.withColumn("d", F.col("d")), 60)
    preds = small[1]
    got = {r["horizon"]: r for r in panel["by_horizon"].collect()}
    for horizon, g in preds.groupby("horizon"):
        assert got[horizon]["wape"] == pytest.approx((g["actual"] - g["q50"]).abs().sum() / g["actual"].sum())
        assert got[horizon]["coverage_90"] == pytest.approx(g["actual"].between(g["q05"], g["q95"]).mean())
    cal = {r["nominal_coverage"]: r["empirical_coverage"] for r in panel["calibration"].collect()}
    assert cal[0.5] == pytest.approx(preds["actual"].between(preds["q25"], preds["q75"]).mean())
    head = P.headline(panel).first()
    levels = brute(*small)
    assert head["wape_total"] == pytest.approx(levels["total"][1])
    assert head["wrmsse"] == pytest.approx(np.mean([v[3] for v in levels.values()]))
    assert head["coverage_50"] == pytest.approx(cal[0.5])


def test_history_stops_at_the_earliest_origin(feature_rows):
    assert P.history_before(feature_rows, 47).agg(F.max("d")).first()[0] == 47


def test_comparison_has_both_models_per_level(spark, small):
    h, p = spark_frames(spark, small)
    worse = p.where("target_day % 3 <> 0").withColumn("q50", F.col("q50") * 1.5 + 1)
    both = P.compared({"a": p, "b": worse}, h)
    assert both.columns == ["level", "wape_a", "wape_b", "mase_a", "mase_b", "rmsse_a", "rmsse_b"]
    got = {r["level"]: r for r in both.collect()}
    assert set(got) == set(LEVELS)
    for name, preds in (("a", p), ("b", worse)):
        for r in P.by_level(preds, h).collect():
            for metric in ("wape", "mase", "rmsse"):
                assert got[r["level"]][f"{metric}_{name}"] == pytest.approx(r[metric])


def test_comparison_leaves_out_levels_without_both_models(spark, small):
    h, p = spark_frames(spark, small)
    assert P.compared({"a": p, "b": p.limit(0)}, h).count() == 0


def test_comparison_reads_the_history_as_often_as_one_model(spark, small, tmp_path):
    h, p = spark_frames(spark, small)
    h.write.parquet(str(tmp_path / "history"))
    h = spark.read.parquet(str(tmp_path / "history"))

    def scans(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("parquet")

    assert scans(P.compared({"a": p, "b": p}, h)) == scans(P.by_level(p, h)) > 0
