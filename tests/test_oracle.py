"""Every query with a SQL twin, compared on the smallest driver tables."""

import os

import duckdb
import pytest
from conftest import TESTDATA
from oracle_compare import TABLES, connect, difference
from pyspark.sql import functions as F

from salescast.plans.catalog import QUERIES
from salescast.plans.oracle import ORACLE

pytestmark = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="driver tables are not here")
ROWS_ONLY = {"train_gbt", "forecast_gbt", "backtest_gbt", "tune_holdout"}


@pytest.fixture(scope="module")
def con():
    return connect(TESTDATA)


def test_only_iterative_fits_lack_sql():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, TESTDATA), con, ORACLE[name]) is None


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The same tables with a third of the fact rows on one part and one supplier."""
    root = str(tmp_path_factory.mktemp("skewed"))
    for name in TABLES:
        df = spark.read.parquet(f"{TESTDATA}/{name}.parquet")
        if name == "lineitem":
            hot = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3)) == 0
            df = df.withColumns({
                c: F.when(hot, F.lit(1).cast("long")).otherwise(F.col(c)) for c in ("l_partkey", "l_suppkey")
            })
        df.write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.mark.parametrize(
    "name", ["features", "hierarchy_priors", "backtest_prior", "by_level", "feature_drift", "eda_price_change", "series_json"]
)
def test_query_equals_sql_with_a_hot_series(spark, skewed, name):
    con = connect(skewed, pattern="/*.parquet")
    assert difference(QUERIES[name](spark, skewed), con, ORACLE[name]) is None


@pytest.mark.parametrize("gaps", [(), ("ASIA",), ("AFRICA",)])
def test_bias_metrics_equal_sql_where_a_share_is_empty(spark, tmp_path, gaps):
    """Shops that sell every day leave the class of unsold days empty; a shop with a gap lacks the second day."""
    days = [("AFRICA", 0, d) for d in (1, 2, 3)] + [("ASIA", 1, d) for d in (1, 2, 3)]
    sold = [(0, key, 1.0, f"2001-03-0{d}") for state, key, d in days if state not in gaps or d != 2]
    tables = {
        "region": spark.createDataFrame([(0, "AFRICA"), (1, "ASIA")], "r_regionkey int, r_name string"),
        "nation": spark.createDataFrame([(0, "N_0", 0), (1, "N_1", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": spark.createDataFrame([(0, 0), (1, 1)], "s_suppkey long, s_nationkey int"),
        "part": spark.createDataFrame([(0, "Brand#4", "SMALL", 9.0)], "p_partkey long, p_brand string, p_type string, p_retailprice double"),
        "lineitem": spark.createDataFrame(sold, "l_partkey long, l_suppkey long, l_quantity double, day string").selectExpr(
            "l_partkey", "l_suppkey", "l_quantity", "CAST(day AS timestamp) AS l_shipdate"),
    }
    con = duckdb.connect()
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert difference(QUERIES["bias_metrics"](spark, str(tmp_path)), con, ORACLE["bias_metrics"]) is None
