import json

import pytest
from conftest import IDS
from pyspark.sql import functions as F

from salescast.operators import reshape as R
from salescast.operators import validate as V
from salescast.sources import archive as A
from salescast.sources import export as X
from salescast.sources import tables as T


def csv_files(wide, calendar, prices, root):
    for name, df in [("sales", wide), ("calendar", calendar), ("prices", prices)]:
        df.coalesce(1).write.option("header", True).csv(f"{root}/{name}")
    return [f"{root}/{n}" for n in ("sales", "calendar", "prices")]


def test_conversion_keeps_values_and_reports(spark, wide, calendar, prices, tmp_path):
    stats = T.convert_csv(spark, *csv_files(wide, calendar, prices, f"{tmp_path}/csv"), f"{tmp_path}/out")
    assert stats["sales"] == {"n_series": 4, "n_days": 9, "zero_rate": pytest.approx(11 / 36)}
    assert stats["calendar"] == {"n_days": 9, "first_date": "2014-03-05", "last_date": "2014-03-13"}
    assert stats["prices"] == {"n_rows": 7, "n_items": 3}
    sales = spark.read.parquet(f"{tmp_path}/out/sales").select(*wide.columns)
    assert sorted(sales.collect()) == sorted(wide.collect())
    assert dict(spark.read.parquet(f"{tmp_path}/out/calendar").dtypes)["date"] == "date"
    assert dict(spark.read.parquet(f"{tmp_path}/out/prices").dtypes)["sell_price"] == "double"


def test_conversion_can_keep_fewer_series_but_all_prices(spark, wide, calendar, prices, tmp_path):
    T.convert_csv(spark, *csv_files(wide, calendar, prices, f"{tmp_path}/csv"), f"{tmp_path}/out", subsample=2)
    assert spark.read.parquet(f"{tmp_path}/out/sales").count() == 2
    assert spark.read.parquet(f"{tmp_path}/out/prices").count() == 7


@pytest.mark.parametrize("change, problem", [
    (lambda w: w.drop("state_id"), "missing"),
    (lambda w: w.drop("d_4"), "gap"),
    (lambda w: w.select("id", "item_id", "dept_id", "cat_id", "store_id", "state_id"), "no day"),
    (lambda w: w.withColumn("dept_id", F.lit(None).cast("string")), "NULL"),
    (lambda w: w.withColumn("id", F.lit("x")), "more than once"),
    (lambda w: w.withColumn("d_3", F.lit(None).cast("int")), "NULL units"),
    (lambda w: w.withColumn("d_3", F.lit(-1)), "negative"),
])
def test_broken_sales_are_refused(wide, change, problem):
    with pytest.raises(ValueError, match=problem):
        V.validate_sales(change(wide))


@pytest.mark.parametrize("change, problem", [
    (lambda c: c.drop("wday"), "missing"),
    (lambda c: c.where(F.col("d") != "d_4"), "skip"),
    (lambda c: c.withColumn("date", F.date_sub(F.lit("2020-01-01").cast("date"), F.dayofyear("date"))), "ascend"),
    (lambda c: c.withColumn("d", F.lit("d_1")), "more than once"),
    (lambda c: c.withColumn("snap_OR", F.lit(2)), "flag"),
    (lambda c: c.withColumn("snap_NV", F.lit(None).cast("int")), "flag"),
])
def test_broken_calendars_are_refused(calendar, change, problem):
    with pytest.raises(ValueError, match=problem):
        V.validate_calendar(change(calendar))


@pytest.mark.parametrize("change, problem", [
    (lambda p: p.drop("sell_price"), "missing"),
    (lambda p: p.withColumn("sell_price", F.when(F.col("store_id") == "NV_2", None).otherwise(F.col("sell_price"))), "NULL"),
    (lambda p: p.withColumn("sell_price", F.lit(0.0)), "at or below 0"),
    (lambda p: p.unionByName(p.limit(1)), "more than once"),
])
def test_broken_prices_are_refused(prices, change, problem):
    with pytest.raises(ValueError, match=problem):
        V.validate_prices(change(prices))


def test_quality_rules(feature_rows):
    good = {r["rule"]: r["passed"] for r in V.quality_rules(feature_rows, 200).collect()}
    assert all(good.values()) and len(good) == 7
    bad = feature_rows.withColumn("sales", F.when(F.col("d") == 1, -1).otherwise(F.col("sales"))).withColumn(
        "sell_price", F.when(F.col("d") == 2, None).otherwise(F.col("sell_price")))
    got = {r["rule"]: (r["observed"], r["passed"]) for r in V.quality_rules(bad, 1000).collect()}
    assert got["sales >= 0"] == (4, False) and got["sell_price > 0"] == (4, False) and not got["row count > 1000"][1]


def test_feature_scan_pushes_state_and_columns(spark, feature_rows, tmp_path):
    path = f"{tmp_path}/features"
    T.write_features(feature_rows.withColumn("unused", F.lit(1)), path)
    out = T.load_features(spark, path, "OR", 2, 42)
    assert out.select("id").distinct().count() == 2 and "unused" not in out.columns
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(state_id,OR)" in plan and "unused" not in plan
    assert T.load_features(spark, path, "TX").count() == 0


def test_views_answer_sql(spark, wide, calendar, prices, feature_rows):
    T.register_views(R.to_long(wide), calendar, prices, feature_rows)
    assert spark.sql("SELECT count(DISTINCT id) n FROM sales_long").first()["n"] == 4
    assert spark.sql("SELECT count(*) n FROM features").first()["n"] == 384


def test_catalog_tables_over_folders(spark, wide, calendar, prices, feature_rows, tmp_path):
    named = {"sales_long": R.to_long(wide), "calendar": calendar, "prices": prices, "features": feature_rows}
    for name, df in named.items():
        df.write.parquet(f"{tmp_path}/{name}")
        spark.catalog.dropTempView(name)
    T.create_external_tables(spark, str(tmp_path))
    got = spark.sql("SELECT state_id, sum(sales) AS units FROM default.sales_long GROUP BY state_id ORDER BY units DESC")
    assert [r["state_id"] for r in got.collect()] == ["OR", "NV"]
    for name in named:
        spark.sql(f"DROP TABLE default.{name}")  # external: the files stay
    assert spark.read.parquet(f"{tmp_path}/features").count() == 384


def forecasts(spark, value):
    rows = [(*IDS[0], 75, h, 75 + h, value, value, value) for h in (1, 2)]
    return spark.createDataFrame(
        rows, "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, "
        "origin int, horizon int, target_day int, q05 double, q50 double, q95 double")


def test_archive_replaces_a_run_date_and_keeps_the_others(spark, tmp_path):
    qs, path = (0.05, 0.5, 0.95), f"{tmp_path}/archive"
    with pytest.raises(FileNotFoundError):
        A.latest_archive(spark, path)
    for day, value in [("2024-01-01", 1.0), ("2024-01-02", 2.0), ("2024-01-02", 3.0)]:
        A.write_archive(forecasts(spark, value), path, day, "m", "v", qs)
    got = {(r["run_date"], r["q50"]) for r in A.read_archive(spark, path).collect()}
    assert got == {("2024-01-01", 1.0), ("2024-01-02", 3.0)}
    latest = A.latest_archive(spark, path)
    assert {r["run_date"] for r in latest.collect()} == {"2024-01-02"} and latest.count() == 2
    assert "PartitionFilters: [isnotnull(run_date" in latest._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        A.write_archive(forecasts(spark, -1.0), path, "2024-01-03", "m", "v", qs)
    assert A.run_dates(spark, path) == ["2024-01-01", "2024-01-02"]
    assert "q0.05" in A.export_names(latest, qs).columns


def test_series_lines_trim_and_drop(spark, tmp_path):
    def series(name, units):
        return [(name, "CA_1" if name != "S3" else "AZ_1", "F_1", d + 1, u) for d, u in enumerate(units)]

    rows = series("S1", [0] * 5 + [2] * 62) + series("S2", [0] * 67) + series("S3", [0] * 36 + [1] * 31)
    sales = spark.createDataFrame(rows, "id string, store_id string, dept_id string, d int, sales int")
    lines = X.series_json(sales, "2011-01-29", 28)
    got = {(r["split"], r["id"]): json.loads(r["line"]) for r in lines.collect()}
    assert got.keys() == {("train", "S1"), ("test", "S1")}
    assert got[("test", "S1")] == {"start": "2011-02-03", "target": [2] * 62, "cat": [1, 0]}
    assert got[("train", "S1")]["target"] == [2] * 34
    X.write_series_json(lines, f"{tmp_path}/json")
    assert json.loads(spark.read.text(f"{tmp_path}/json/train").first()[0])["start"] == "2011-02-03"


def test_panel_is_saved_as_csv(spark, tmp_path):
    table = spark.createDataFrame([("total", 0.5)], "level string, wape double")
    X.save_panel({"by_level": table}, f"{tmp_path}/panel")
    assert spark.read.option("header", True).csv(f"{tmp_path}/panel/by_level").first()["wape"] == "0.5"
