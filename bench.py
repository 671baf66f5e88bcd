"""Headline queries on one machine; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Every query runs whole and writes all its rows to the no-op sink. The staged tables
(daily sales, grid, calendar, prices, features, backtests) are built first and timed on their own.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from salescast.plans.catalog import QUERIES
from salescast.plans.mart import SalesMart

STAGES = ["daily", "sales", "calendar", "prices", "features", "prior_backtest", "naive_backtest"]
HEADLINE = [
    "features", "melt_wide", "calendar_snap", "price_features", "lag_features", "rolling_features",
    "direct_table", "contiguous_grid", "series_windows", "series_json", "forecast_catalogue",
    "backtest_prior", "by_level", "by_horizon", "panel_headline", "compare_models",
    "score_forecasts", "feature_drift", "monitor_summary", "bias_metrics", "dq_rules",
    "eda_units_store", "eda_zero_hist", "eda_weekday_mean", "eda_price_change", "eda_top20",
    "train_gbt", "forecast_gbt", "backtest_gbt",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    took: dict[str, float] = {}
    mart = SalesMart(spark, sf_dir)
    for stage in STAGES:
        begun = time.perf_counter()
        getattr(mart, stage)
        took[f"stage_{stage}"] = round(time.perf_counter() - begun, 3)
    for name in names:
        begun = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - begun, 3)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(took.values()), 3),
        "unit": "sec",
        "queries": took,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
