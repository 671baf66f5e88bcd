"""CSV and Parquet tables: typed scans, conversion at ingest, feature scans, SQL views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.operators import validate as V
from salescast.operators.reshape import cap_series, only_state
from salescast.schema import (
    CALENDAR_SCHEMA_HEAD, DYNAMIC_COLS, HIERARCHY, ID_COLS, PRICE_SCHEMA, TARGET_COLS,
)


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line, without reading the data or inferring types."""
    return spark.read.option("header", True).csv(path).columns


def _typed(columns: list[str], known: T.StructType, other: T.DataType) -> T.StructType:
    types = {f.name: f.dataType for f in known}
    return T.StructType([T.StructField(c, types.get(c, other)) for c in columns])


def read_sales_csv(spark: SparkSession, path: str) -> DataFrame:
    """Wide sales: string identity columns and one integer column per day."""
    ids = T.StructType([T.StructField(c, T.StringType()) for c in ID_COLS])
    schema = _typed(_header(spark, path), ids, T.IntegerType())
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_calendar_csv(spark: SparkSession, path: str) -> DataFrame:
    """Calendar with a DATE column; any column beyond the fixed ones is a 0/1 flag."""
    schema = _typed(_header(spark, path), CALENDAR_SCHEMA_HEAD, T.IntegerType())
    raw = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    return raw.withColumn("date", F.to_date("date"))


def read_prices_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PRICE_SCHEMA).option("header", True).option("mode", "FAILFAST").csv(path)


def convert_csv(
    spark: SparkSession, sales_csv: str, calendar_csv: str, prices_csv: str, out: str,
    subsample: int = 0, seed: int = 42,
) -> dict[str, dict]:
    """Validate the three raw tables and write them as Parquet; returns their statistics.

    A positive ``subsample`` keeps that many series of the sales; prices stay whole, since a
    shelf mean needs every item.
    """
    sales = read_sales_csv(spark, sales_csv)
    calendar = read_calendar_csv(spark, calendar_csv)
    prices = read_prices_csv(spark, prices_csv)
    stats = {
        "sales": V.validate_sales(sales),
        "calendar": V.validate_calendar(calendar),
        "prices": V.validate_prices(prices),
    }
    cap_series(sales, subsample, seed).write.mode("overwrite").parquet(f"{out}/sales")
    calendar.write.mode("overwrite").parquet(f"{out}/calendar")
    prices.write.mode("overwrite").parquet(f"{out}/prices")
    return stats


def write_features(features: DataFrame, path: str) -> None:
    """Write the feature table clustered by series, so that id and day filters skip row groups.

    The rows arrive partitioned by series from the feature windows; only a local sort is added.
    """
    features.sortWithinPartitions("id", "d").write.mode("overwrite").parquet(path)


def load_features(
    spark: SparkSession, path: str, state: str = "", max_series: int = 0, seed: int = 42
) -> DataFrame:
    """Model columns of the feature table with state and series set applied at the scan.

    The state is a pushed Parquet filter and the columns a pruned read schema. The sampled ids
    are a top-n over one column; the semi join is broadcast while that set is small.
    """
    columns = list(dict.fromkeys(["id", "d", "sales", *HIERARCHY, *DYNAMIC_COLS, *TARGET_COLS]))
    rows = only_state(spark.read.parquet(path).select(*columns), state)
    return cap_series(rows, max_series, seed)


def register_views(sales: DataFrame, calendar: DataFrame, prices: DataFrame, features: DataFrame) -> None:
    """Expose the tables to ``spark.sql`` under their contract names."""
    named = {"sales_long": sales, "calendar": calendar, "prices": prices, "features": features}
    for name, df in named.items():
        df.createOrReplaceTempView(name)


def create_external_tables(spark: SparkSession, root: str, database: str = "default") -> None:
    """Catalog tables over Parquet folders ``<root>/<table>``; existing tables are left alone."""
    for name in ("sales_long", "calendar", "prices", "features"):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} USING parquet LOCATION '{root}/{name}'")
