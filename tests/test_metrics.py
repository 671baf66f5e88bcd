import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescast.functions import metrics as M
from salescast.functions.joins import salted_join
from salescast.functions.quantiles import exact_quantiles, monotone, unit_quantiles
from salescast.schema import q_export_name, q_name


def one(spark, pairs, column):
    return spark.createDataFrame([(float(a), float(p)) for a, p in pairs], "a double, p double").agg(column).first()[0]


def test_known_values(spark):
    assert one(spark, [(2, 1), (0, 0), (4, 4)], M.wape("a", "p")) == pytest.approx(1 / 6)
    assert one(spark, [(0, 1), (0, 2)], M.wape("a", "p")) is None
    assert one(spark, [(1, 0)], M.pinball("a", "p", 0.5)) == pytest.approx(0.5)
    assert one(spark, [(10, 0)], M.pinball("a", "p", 0.9)) == pytest.approx(9)
    assert one(spark, [(0, 10)], M.pinball("a", "p", 0.9)) == pytest.approx(1)
    assert one(spark, [(2, 1), (4, 4)], M.scaled_mae("a", "p", F.lit(2.0))) == pytest.approx(0.25)
    assert one(spark, [(2, 1), (4, 4)], M.scaled_mae("a", "p", F.lit(0.0))) is None
    assert one(spark, [(2, 0), (4, 4)], M.scaled_rmse("a", "p", F.lit(4.0))) == pytest.approx(math.sqrt(0.5))
    inside = M.coverage("a", F.lit(0.0), F.lit(4.0))
    assert one(spark, [(1, 0), (5, 0), (9, 0)], inside) == pytest.approx(1 / 3)
    assert one(spark, [(0, 0), (4, 0)], inside) == 1.0


def test_naive_scales(spark):
    rows = [("a", d, d) for d in range(1, 10)] + [("b", d, d) for d in range(1, 8)] + [("c", d, s) for d, s in [(1, 1), (2, 3), (3, 6)]]
    got = {r["id"]: r for r in M.naive_scales(spark.createDataFrame(rows, "id string, d int, sales int"), ["id"]).collect()}
    assert got["a"]["seasonal_mae"] == 7 and got["b"]["seasonal_mae"] is None
    assert got["c"]["naive_mse"] == 6.5


def test_weighted_mean_skips_unknown_values(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 5.0), (4.0, 2.0)], "v double, w double")
    assert df.agg(M.weighted_mean("v", "w")).first()[0] == pytest.approx(3.0)
    none = spark.createDataFrame([(None, 5.0), (3.0, 0.0)], "v double, w double")
    assert none.agg(M.weighted_mean("v", "w")).first()[0] is None


def test_exact_quantiles_with_a_hot_group(spark):
    rng = np.random.default_rng(1)
    hot = rng.gamma(0.5, 3.0, 6000).round(2)
    rows = [("hot", float(x)) for x in hot] + [("one", 5.0)] + [("same", 2.0)] * 40
    rows += [(f"g{i % 30}", float(x)) for i, x in enumerate(rng.normal(0, 1, 3000))] + [("hot", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.05, 0.3, 0.5, 0.75, 0.999, 1.0]
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    assert len(got) == 33
    for g, r in got.items():
        values = [v for k, v in rows if k == g and v is not None]
        assert r["n"] == len(values)
        assert np.allclose(r["quantiles"], np.quantile(values, probs), rtol=0, atol=1e-12)


def test_counted_input_gives_the_same_quantiles(spark):
    rows = [("a", 1.0, 3), ("a", 2.0, 1), ("a", 9.0, 0), ("a", 4.0, 2)]
    df = spark.createDataFrame(rows, "g string, v double, c int")
    got = exact_quantiles(df, ["g"], "v", [0.25, 0.5, 0.9], count="c").first()
    assert np.allclose(got["quantiles"], np.quantile([1, 1, 1, 2, 4, 4], [0.25, 0.5, 0.9]))


def test_unit_quantiles_interpolate(spark):
    df = spark.createDataFrame([("g", x) for x in (0, 0, 1, 5)], "g string, sales int")
    row = unit_quantiles(df, ["g"], [0.5, 0.9]).first()
    assert row["q50"] == pytest.approx(0.5) and row["q90"] == pytest.approx(3.8)


def test_monotone_clips_and_sorts(spark):
    df = spark.createDataFrame([(1, 3.0, -1.0, 2.0)], "k int, q05 double, q50 double, q95 double")
    assert tuple(monotone(df, [0.05, 0.5, 0.95]).first()) == (1, 0.0, 2.0, 3.0)


def test_salted_join_equals_a_plain_join(spark):
    rows = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i) for i in range(300)], "k string, v int")
    lookup = spark.createDataFrame([("hot", 1), ("k3", 2), ("k9", 3)], "k string, x int")
    for how in ("left", "inner"):
        want = sorted(map(str, rows.join(lookup, "k", how).collect()))
        assert sorted(map(str, salted_join(rows, lookup, ["k"], [F.col("v")], 4, how).collect())) == want


def test_quantile_names():
    assert [q_name(q) for q in (0.05, 0.5, 0.95, 0.025)] == ["q05", "q50", "q95", "q025"]
    assert q_export_name(0.05) == "q0.05"
    with pytest.raises(ValueError):
        q_name(1.0)
