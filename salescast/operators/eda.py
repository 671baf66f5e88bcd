"""Exploratory reports over long sales, calendar and prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast.functions.quantiles import exact_quantiles
from salescast.schema import HIERARCHY


def _no_sale():
    return F.when(F.col("sales") == 0, F.lit(1.0)).otherwise(F.lit(0.0))


def scale(sales: DataFrame) -> DataFrame:
    return sales.agg(
        F.countDistinct("id").alias("n_series"),
        F.countDistinct("d").alias("n_days"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def zero_share(sales: DataFrame) -> DataFrame:
    return sales.agg(F.avg(_no_sale()).alias("zero_sales_share"))


def units_by(sales: DataFrame, column: str) -> DataFrame:
    return sales.groupBy(column).agg(F.sum("sales").alias("total_units")).orderBy(
        F.desc("total_units"), column
    )


def top_series(sales: DataFrame, n: int = 20) -> DataFrame:
    return units_by(sales, "id").limit(n)


def cardinalities(sales: DataFrame) -> DataFrame:
    """Distinct members per hierarchy column, as rows.

    The dimension tuples are deduplicated first, so the distinct counts see one row per series.
    """
    members = sales.select(*HIERARCHY).distinct()
    found = members.agg(*[F.countDistinct(c).alias(c) for c in HIERARCHY])
    rows = F.array(*[F.struct(F.lit(c).alias("level"), F.col(c).alias("n")) for c in HIERARCHY])
    return found.select(F.inline(rows))


def zero_histogram(sales: DataFrame, bins: int = 50) -> DataFrame:
    """Series per bin of their zero share over the observed range, and the share above 0.9.

    Bins are even between the smallest and the largest share; the last one is closed. Every bin
    has a row; ``share_above_90`` is the same in all of them.
    """
    shares = sales.groupBy("id").agg(F.avg(_no_sale()).alias("share"))
    lowest = shares.agg(F.min("share")).scalar()
    highest = shares.agg(F.max("share")).scalar()
    spread = shares.withColumn("lo", lowest).withColumn("hi", highest)
    width = F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))
    slot = F.floor(F.coalesce((F.col("share") - F.col("lo")) / width, F.lit(0.0)) * bins)
    binned = spread.groupBy(F.least(slot, F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n_series"),
        F.count_if(F.col("share") > 0.9).alias("n_above_90"),
    )
    high = shares.agg(F.avg((F.col("share") > 0.9).cast("double"))).scalar()
    every = sales.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(binned, "bin", "left").na.fill(0, ["n_series", "n_above_90"]).withColumn("share_above_90", high)


def daily_total(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Units of all series per day with its date."""
    totals = sales.groupBy("d").agg(F.sum("sales").alias("total_units"))
    return totals.join(_days(calendar).select("d", "date"), "d").select("d", "date", "total_units")


def weekday_mean(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Mean of the daily totals per weekday: days are summed before they meet the calendar."""
    totals = sales.groupBy("d").agg(F.sum("sales").alias("total"))
    return totals.join(_days(calendar).select("d", "weekday"), "d").groupBy("weekday").agg(
        F.avg("total").alias("mean_units")
    )


def snap_lift(sales: DataFrame, calendar: DataFrame, category: str, state: str) -> DataFrame:
    """Mean daily units of one category in one state on benefit days against other days."""
    totals = (
        sales.where((F.col("cat_id") == category) & (F.col("state_id") == state))
        .groupBy("d")
        .agg(F.sum("sales").alias("total"))
    )
    flags = _days(calendar).select("d", F.col(f"snap_{state}").alias("flag"))
    means = totals.join(flags, "d").agg(
        F.avg(F.when(F.col("flag") == 1, F.col("total"))).alias("snap_mean"),
        F.avg(F.when(F.col("flag") == 0, F.col("total"))).alias("other_mean"),
    )
    return means.withColumn("lift", F.try_divide("snap_mean", "other_mean") - 1)


def price_changes(prices: DataFrame) -> DataFrame:
    """Share of listed weeks whose price changed, and the median absolute change."""
    by_week = Window.partitionBy("store_id", "item_id").orderBy("wm_yr_wk")
    change = F.try_divide(F.col("sell_price"), F.lag("sell_price").over(by_week)) - 1
    moves = prices.select(change.alias("change"))
    share = moves.agg(
        F.avg(F.when(F.coalesce("change", F.lit(0.0)) != 0, 1.0).otherwise(0.0)).alias("changed_share")
    )
    changed = moves.where(F.col("change") != 0).select(F.lit(0).alias("all"), F.abs("change").alias("size"))
    median = exact_quantiles(changed, ["all"], "size", [0.5]).select(
        F.col("quantiles")[0].alias("median_abs_change")
    )
    rows = share.unionByName(median, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in ["changed_share", "median_abs_change"]])


def _days(calendar: DataFrame) -> DataFrame:
    day = F.regexp_extract(F.col("d").cast("string"), r"(\d+)$", 1).cast("int")
    return calendar.withColumn("d", day)
