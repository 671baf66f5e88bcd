"""Daily sales, calendar and weekly prices derived from a TPC-H-like star schema.

The mapping is described in FIXTURES.md. One pass over the fact rows yields a compact table
(one row per series and day with sales); the grid, the calendar and the prices come from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salescast.schema import HIERARCHY, ID_COLS

TABLES = ["lineitem", "part", "supplier", "nation", "region"]

# States with a benefit flag and the parity of its days, and the events.
EVEN_SNAP_STATES = ["AFRICA", "ASIA"]
ODD_SNAP_STATES = ["AMERICA", "EUROPE"]
EVENTS = {
    "12-25": ("Christmas", "National"),
    "07-04": ("IndependenceDay", "National"),
    "02-14": ("ValentinesDay", "Cultural"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def first_day(daily: DataFrame):
    """The day of the first sale, day 1 of all tables, as a scalar subquery."""
    return daily.agg(F.min("date")).scalar()


def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per series and day with sales: units and the highest list price.

    Fact columns are pruned to four before the joins. A part or a supplier that owns a large
    share of the facts is split by the adaptive skew join; the aggregation is combined before
    its shuffle, so a hot series costs at most one row per day and task.
    """
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.concat_ws(
            "_", "p_type", (F.regexp_replace("p_brand", "Brand#", "").cast("int") % 4).cast("string")
        ).alias("item_id"),
        F.col("p_type").alias("dept_id"),
        F.when(F.col("p_type").isin("SMALL", "MEDIUM", "LARGE"), "SIZED").otherwise("VALUE").alias("cat_id"),
        "p_retailprice",
    )
    place = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("l_suppkey"),
            F.concat_ws("_", "r_name", (F.col("n_nationkey") % 2).cast("string")).alias("store_id"),
            F.col("r_name").alias("state_id"),
        )
    )
    sold = (
        table(spark, sf_dir, "lineitem")
        .select("l_partkey", "l_suppkey", "l_quantity", F.col("l_shipdate").cast("date").alias("date"))
        .join(part, "l_partkey")
        .join(place, "l_suppkey")
    )
    return (
        sold.groupBy(*HIERARCHY, "date")
        .agg(F.sum("l_quantity").alias("units"), F.max("p_retailprice").alias("price"))
        .select(F.concat_ws("|", "store_id", "item_id").alias("id"), *HIERARCHY, "date", "units", "price")
    )


def calendar(daily: DataFrame) -> DataFrame:
    """The calendar table: one row per day from the first sale to the last."""
    day = F.col("date")
    mmdd = F.date_format(day, "MM-dd")

    def event(i: int):
        out = F.lit(None).cast("string")
        for key, names in EVENTS.items():
            out = F.when(mmdd == key, names[i]).otherwise(out)
        return out

    def snap(parity: int):
        return ((F.day(day) <= 10) & (F.day(day) % 2 == parity)).cast("int")

    n = F.datediff(day, F.col("first"))
    days = daily.agg(F.min("date").alias("first"), F.max("date").alias("last")).where("first is not null").select(
        "first", F.explode(F.sequence("first", "last")).alias("date")
    )
    return days.select(
        "date",
        (F.floor(n / 7) + 1).cast("int").alias("wm_yr_wk"),
        F.date_format(day, "EEEE").alias("weekday"),
        (F.dayofweek(day) % 7 + 1).alias("wday"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        F.concat(F.lit("d_"), (n + 1).cast("string")).alias("d"),
        event(0).alias("event_name_1"),
        event(1).alias("event_type_1"),
        F.lit(None).cast("string").alias("event_name_2"),
        F.lit(None).cast("string").alias("event_type_2"),
        *[snap(0).alias(f"snap_{s}") for s in EVEN_SNAP_STATES],
        *[snap(1).alias(f"snap_{s}") for s in ODD_SNAP_STATES],
    )


def sales_long(daily: DataFrame) -> DataFrame:
    """Gap-free day grid per series; a day without a fact row sold 0 units. Units are whole: halves round up."""
    first = first_day(daily)
    last = daily.agg(F.max("date")).scalar()
    grid = daily.select(*ID_COLS).distinct().select(
        *ID_COLS, F.explode(F.sequence(first, last)).alias("date")
    )
    return grid.join(daily.select("id", "date", "units"), ["id", "date"], "left").select(
        *ID_COLS,
        (F.datediff("date", first) + 1).alias("d"),
        F.round(F.coalesce(F.col("units"), F.lit(0.0))).cast("int").alias("sales"),
    )


def weekly_prices(daily: DataFrame) -> DataFrame:
    """Highest list price sold in the week, carried forward; no row before the first sale."""
    first = first_day(daily)
    keys = ["store_id", "item_id"]
    week = (F.floor(F.datediff("date", first) / 7) + 1).cast("int")
    sold = daily.groupBy(*keys, week.alias("wm_yr_wk")).agg(F.max("price").alias("_p"))
    last_week = sold.agg(F.max("wm_yr_wk")).scalar()
    # From the week of the first sale onwards: earlier weeks have no price.
    spans = sold.groupBy(*keys).agg(F.min("wm_yr_wk").alias("_first_week"))
    grid = spans.select(*keys, F.explode(F.sequence(F.col("_first_week"), last_week)).alias("wm_yr_wk"))
    so_far = Window.partitionBy(*keys).orderBy("wm_yr_wk").rowsBetween(Window.unboundedPreceding, 0)
    return grid.join(sold, [*keys, "wm_yr_wk"], "left").select(
        *keys, "wm_yr_wk", F.last("_p", ignorenulls=True).over(so_far).alias("sell_price")
    )
