"""Point-in-time features: calendar, price, lag and rolling columns.

The row of day t sees sales before t only; calendar and price are those of t.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast.functions.joins import salted_join
from salescast.operators.reshape import listed_only
from salescast.schema import CALENDAR_ATTRS, ID_COLS, SNAP_PREFIX, Settings, snap_states
from salescast.session import deal_by_key_subset

# Prices are averaged as whole millionths: the sum is exact in any order.
PRICE_UNIT = 1_000_000


def attach_calendar(
    sales: DataFrame, calendar: DataFrame, attrs: list[str] | None = None, snap: bool = True
) -> DataFrame:
    """Add the calendar attributes of the day and the benefit flag of the row's own state.

    The calendar holds one row per day; Catalyst broadcasts it while its size estimate is
    under the threshold and shuffles otherwise.
    """
    states = snap_states(calendar) if snap else []
    days = calendar.select(
        F.regexp_extract(F.col("d").cast("string"), r"(\d+)$", 1).cast("int").alias("d"),
        *(CALENDAR_ATTRS if attrs is None else attrs),
        *[SNAP_PREFIX + s for s in states],
    )
    joined = sales.join(days, "d", "left")
    if not snap:
        return joined
    flag = reduce(
        lambda other, s: F.when(F.col("state_id") == s, F.col(SNAP_PREFIX + s)).otherwise(other),
        states,
        F.lit(0),
    )
    return joined.withColumn("snap", flag.cast("int")).drop(*[SNAP_PREFIX + s for s in states])


def item_department(item: str = "item_id"):
    """Everything before the last underscore; an id without one is its own department."""
    head = F.regexp_extract(item, r"^(.*)_[^_]*$", 1)
    return F.when(F.col(item).contains("_"), head).otherwise(F.col(item))


def price_features(prices: DataFrame) -> DataFrame:
    """Weekly price level, change over the previous listed week, and level on its shelf.

    Runs on the weekly table, before it meets the daily one. The shelf mean is a combined
    aggregate joined back over salted keys, so that a store-department with very many items
    is never gathered in one window partition.
    """
    by_week = Window.partitionBy("store_id", "item_id").orderBy("wm_yr_wk")
    weekly = prices.withColumn("_dept", item_department())
    shelf = ["store_id", "_dept", "wm_yr_wk"]
    means = weekly.groupBy(*shelf).agg(
        (
            F.sum(F.round(F.col("sell_price") * PRICE_UNIT).cast("long")).cast("double")
            / F.count("sell_price")
            / F.lit(float(PRICE_UNIT))
        ).alias("_shelf_mean")
    )
    changed = weekly.withColumn(
        "price_pct_change",
        F.try_divide(F.col("sell_price"), F.lag("sell_price").over(by_week)) - 1,
    )
    return salted_join(changed, means, shelf, [F.col("item_id")]).select(
        "store_id", "item_id", "wm_yr_wk", "sell_price", "price_pct_change",
        F.try_divide(F.col("sell_price"), F.col("_shelf_mean")).alias("price_rel_dept"),
    )


PRICE_FEATURES = ["sell_price", "price_pct_change", "price_rel_dept"]


def series_table(sales: DataFrame) -> DataFrame:
    """One row per series with its identity, combined before the shuffle."""
    return sales.select(*ID_COLS).distinct()


def series_prices(series: DataFrame, prices: DataFrame) -> DataFrame:
    """Weekly price features by series id: (id, wm_yr_wk, price features)."""
    keys = ["store_id", "item_id"]
    return price_features(prices).join(series.select("id", *keys), keys).select("id", "wm_yr_wk", *PRICE_FEATURES)


def merge_by_series(daily: DataFrame, weekly: DataFrame) -> DataFrame:
    """Daily rows (with id and week) and their week's price features; NULL before the first listed week.

    Both sides are dealt by the series id alone, a part of the join key: daily rows that windows have
    already exchanged by series stay where they lie and keep their order, and the weekly rows of
    their series come to them. Weekly rows are few beside daily ones and are the hashed side.
    """
    deal_by_key_subset(daily.sparkSession)
    return daily.join(weekly.hint("shuffle_hash"), ["id", "wm_yr_wk"], "left").select(
        *[daily[c] for c in daily.columns], *[weekly[c] for c in PRICE_FEATURES]
    )


def attach_prices(daily: DataFrame, prices: DataFrame, series: DataFrame | None = None) -> DataFrame:
    """Daily rows (with identity and week) and their week's price features."""
    return merge_by_series(daily, series_prices(series_table(daily) if series is None else series, prices))


def lag_columns(lags) -> list:
    by_day = Window.partitionBy("id").orderBy("d")
    return [F.lag("sales", k).over(by_day).alias(f"lag_{k}") for k in lags]


def _running() -> dict:
    """Running count, sum and sum of squares of the units up to and including the row."""
    upto = Window.partitionBy("id").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    units = F.col("sales").cast("long")
    return {
        "_n": F.count("sales").over(upto),
        "_s": F.coalesce(F.sum(units).over(upto), F.lit(0)),
        "_ss": F.coalesce(F.sum(units * units).over(upto), F.lit(0)),
    }


def rolling_columns(windows) -> list:
    """Mean and sample deviation of the ``w`` days before t; NULL until all ``w`` exist.

    Each statistic is a difference of two running integer sums, so its cost per row does not
    depend on ``w`` and whole units lose no precision.
    """
    by_day = Window.partitionBy("id").orderBy("d")

    def over_window(total: str, w: int):
        return F.lag(total, 1).over(by_day) - F.coalesce(F.lag(total, w + 1).over(by_day), F.lit(0))

    out = []
    for w in windows:
        n, s, ss = (over_window(c, w) for c in ("_n", "_s", "_ss"))
        variance = F.try_divide((ss * w - s * s).cast("double"), F.lit(float(w * (w - 1))))
        out += [
            F.when(n >= w, s.cast("double") / F.lit(float(w))).alias(f"rolling_mean_{w}"),
            F.when(n >= w, F.sqrt(variance)).alias(f"rolling_std_{w}"),
        ]
    return out


def with_history(daily: DataFrame, lags, windows) -> DataFrame:
    """Lag and rolling columns over one partitioning and one sort by series and day."""
    sums = _running() if windows else {}
    return daily.withColumns(sums).select(
        *daily.columns, *lag_columns(lags), *rolling_columns(windows)
    )


def build_features(
    sales: DataFrame, calendar: DataFrame, prices: DataFrame, settings: Settings = Settings(),
    series: DataFrame | None = None,
) -> DataFrame:
    """The feature table, one row per series and listed day.

    The daily table crosses the network and is sorted once, by series and day, as (id, d,
    units) only: the windows come first, and identity and weekly prices then join on the exchange
    by series that the windows made. Windows run over the full day grid before the pre-release
    rows go, so k rows are k days. ``series`` (:func:`series_table`) saves a second scan of the sales.
    """
    series = series_table(sales) if series is None else series
    history = with_history(sales.select("id", "d", "sales"), settings.lags, settings.windows)
    known = history.join(series.select(*ID_COLS), "id", "left")
    full = merge_by_series(attach_calendar(known, calendar), series_prices(series, prices))
    out = listed_only(full) if settings.drop_pre_release else full
    front = [*ID_COLS, "d", *CALENDAR_ATTRS, "snap", "sales", "sell_price", "price_pct_change", "price_rel_dept"]
    return out.select(*front, *[c for c in out.columns if c not in front])
