import math

import pytest
from conftest import UNITS
from pyspark.sql import functions as F

from salescast.operators import features as FE
from salescast.operators import reshape as R
from salescast.schema import Settings

SMALL = Settings(lags=(2,), windows=(3,))


def test_settings_are_checked():
    for bad in ({"horizon": 0}, {"quantiles": (0.5, 1.0)}, {"max_series": -1}, {"n_folds": 0}):
        with pytest.raises(ValueError):
            Settings(**bad)


def rows_of(df, *order):
    return [r.asDict() for r in df.orderBy(*order).collect()]


def test_long_form_orders_days_by_number(wide):
    long = R.to_long(wide)
    assert long.count() == 36
    first = rows_of(long.where(F.col("store_id") == "NV_2"), "d")
    assert [r["d"] for r in first] == list(range(1, 10))
    assert [r["sales"] for r in first] == UNITS["saw-west"]
    assert R.day_columns(wide)[-1] == "d_9"


def test_wide_and_long_are_inverse(wide):
    again = R.to_wide(R.to_long(wide), 9).select(*wide.columns)
    assert sorted(again.collect()) == sorted(wide.collect())


def test_snap_is_the_flag_of_the_own_state(wide, calendar):
    out = FE.attach_calendar(R.to_long(wide), calendar)
    east = rows_of(out.where(F.col("id") == "saw-east"), "d")
    west = rows_of(out.where(F.col("state_id") == "NV"), "d")
    assert [r["snap"] for r in east] == [0, 0, 1] * 3
    assert [r["snap"] for r in west] == [1] * 4 + [0] * 5
    other = R.to_long(wide).withColumn("state_id", F.lit("NY"))
    assert {r["snap"] for r in FE.attach_calendar(other, calendar).collect()} == {0}


def test_price_features(prices):
    out = {(r["store_id"], r["item_id"], r["wm_yr_wk"]): r for r in FE.price_features(prices).collect()}
    first, second = out[("OR_4", "TOOLS_7_18", 610)], out[("OR_4", "TOOLS_7_18", 611)]
    assert first["price_pct_change"] is None and second["price_pct_change"] == pytest.approx(-0.25)
    assert first["price_rel_dept"] == pytest.approx(12 / 8) and second["price_rel_dept"] == pytest.approx(9 / 6.5)
    alone = out[("NV_2", "TOOLS_7_18", 611)]
    assert alone["price_pct_change"] == 0.0 and alone["price_rel_dept"] == pytest.approx(1.0)


def test_item_without_underscore_is_its_own_department(spark):
    df = spark.createDataFrame([("TOOLS_7_18",), ("PLAIN",), ("A_",)], "item_id string")
    got = [r[0] for r in df.select(FE.item_department()).collect()]
    assert got == ["TOOLS_7", "PLAIN", "A"]


def test_lags_and_rolling_use_the_past_of_the_own_series(wide, calendar, prices):
    out = FE.build_features(R.to_long(wide), calendar, prices, SMALL)
    series = rows_of(out.where(F.col("id") == "saw-east"), "d")
    sales = [r["sales"] for r in series]
    assert [r["lag_2"] for r in series] == [None, None, *sales[:-2]]
    for i, r in enumerate(series):
        if i < 3:
            assert r["rolling_mean_3"] is None and r["rolling_std_3"] is None
        else:
            past = sales[i - 3:i]
            mean = sum(past) / 3
            assert r["rolling_mean_3"] == pytest.approx(mean)
            assert r["rolling_std_3"] == pytest.approx(math.sqrt(sum((x - mean) ** 2 for x in past) / 2))


def test_window_of_one_day_has_no_deviation(wide):
    out = FE.with_history(R.to_long(wide), [], [1])
    assert all(r["rolling_std_1"] is None for r in out.collect())


def test_a_missing_unit_leaves_the_window_short(spark):
    df = spark.createDataFrame([("a", d, None if d == 2 else d) for d in range(1, 7)], "id string, d int, sales int")
    out = rows_of(FE.with_history(df, [], [3]), "d")
    assert [r["rolling_mean_3"] for r in out] == [None, None, None, None, None, 4.0]


def test_days_without_a_price_are_dropped_after_the_windows(wide, calendar, prices):
    out = FE.build_features(R.to_long(wide), calendar, prices, SMALL)
    days = {r["d"] for r in out.where(F.col("item_id") == "YARD_3_55").collect()}
    assert days == set(range(6, 10))
    everything = FE.build_features(R.to_long(wide), calendar, prices, SMALL.but(drop_pre_release=False))
    assert everything.count() == 36


def test_no_leak_from_the_day_itself_or_later(wide, calendar, prices):
    """Change one day: earlier rows and other series stay, later rows of the series move."""
    sales = R.to_long(wide)
    target, day = "saw-east", 4
    bumped = sales.withColumn(
        "sales", F.when((F.col("id") == target) & (F.col("d") == day), 99).otherwise(F.col("sales"))
    )
    cols = ["id", "d", "lag_2", "rolling_mean_3", "rolling_std_3", "sell_price", "price_rel_dept", "snap"]
    before = {(r["id"], r["d"]): r for r in FE.build_features(sales, calendar, prices, SMALL).select(*cols).collect()}
    after = {(r["id"], r["d"]): r for r in FE.build_features(bumped, calendar, prices, SMALL).select(*cols).collect()}
    assert before.keys() == after.keys()
    moved = {k for k in before if before[k] != after[k]}
    assert moved and all(k[0] == target and k[1] > day for k in moved)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_plan_moves_the_daily_rows_once(wide, calendar, prices, tmp_path, spark):
    long = R.to_long(wide)
    for name, df in [("sales", long), ("calendar", calendar), ("prices", prices), ("series", FE.series_table(long))]:
        df.write.parquet(f"{tmp_path}/{name}")
    sales, cal, pr, series = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("sales", "calendar", "prices", "series"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = FE.build_features(sales, F.broadcast(cal), pr, SMALL, series)
        lines = plan_of(built).splitlines()
        rows = built.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == FE.build_features(long, calendar, prices, SMALL).count()
    scans = [x for x in lines if "FileScan" in x and f"{tmp_path}/sales" in x]
    assert len(scans) == 1 and "ReadSchema: struct<id:string,d:int,sales:int>" in scans[0]
    # The daily rows cross the network by series only; week, identity and prices come to them.
    dealt = [x for x in lines if "Exchange hashpartitioning(" in x]
    assert not [x for x in dealt if "wm_yr_wk" in x and "hashpartitioning(id" in x]
    assert sum("ShuffledHashJoin [id" in x and "wm_yr_wk" in x for x in lines) == 1
    assert not [x for x in lines if "map_from_entries" in x or "element_at" in x]
    assert sum("Sort [id" in x and ", d#" in x for x in lines) == 1


def test_a_table_bucketed_by_series_is_read_without_an_exchange(spark, feature_rows):
    from salescast.functions.metrics import naive_scales
    from salescast.operators.direct import direct_table
    from salescast.session import staged_by_key

    table = staged_by_key(spark, "bucket-test", lambda: feature_rows, "id", "d")
    assert sorted(table.collect()) == sorted(feature_rows.collect())
    assert "Exchange" not in plan_of(naive_scales(table, ["id"]))
    assert "Exchange hashpartitioning" not in plan_of(direct_table(table, [40, 54], 5))
