"""Reshapes, filters, sampling, day grids and codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescast.schema import ID_COLS, SALES_LONG_COLS

DAY_PREFIX = "d_"


def day_columns(wide: DataFrame) -> list[str]:
    """The ``d_<n>`` columns by day number."""
    found = [c for c in wide.columns if c.startswith(DAY_PREFIX) and c[len(DAY_PREFIX):].isdigit()]
    return sorted(found, key=lambda c: int(c[len(DAY_PREFIX):]))


def to_long(wide: DataFrame) -> DataFrame:
    """Wide sales (a column per day) to one row per series and day.

    The day columns become one array that is exploded by position: a single narrow step,
    where an unpivot of ~2,000 columns would carry as many projections through codegen.
    """
    cols = day_columns(wide)
    days = F.expr("array(" + ", ".join(c[len(DAY_PREFIX):] for c in cols) + ")")
    units = F.array(*cols).cast("array<int>")
    return wide.select(*ID_COLS, F.posexplode(units).alias("_pos", "sales")).select(
        *ID_COLS, F.get(days, F.col("_pos")).alias("d"), "sales"
    )


def to_wide(long: DataFrame, n_days: int) -> DataFrame:
    """One row per series with columns ``d_1 .. d_n`` (the raw layout of the sales file).

    The day list is given, so the pivot needs no extra pass to find it.
    """
    days = list(range(1, n_days + 1))
    wide = long.groupBy(*ID_COLS).pivot("d", days).agg(F.max("sales"))
    return wide.withColumnsRenamed({str(d): f"{DAY_PREFIX}{d}" for d in days})


def sales_long_export(wide: DataFrame) -> DataFrame:
    return to_long(wide).select(*SALES_LONG_COLS)


def calendar_export(calendar: DataFrame) -> DataFrame:
    """Calendar with ``date`` as an ISO string for engines that lack the source's date type."""
    return calendar.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def only_state(df: DataFrame, state: str) -> DataFrame:
    """Rows of one state; an empty state keeps all."""
    return df.where(F.col("state_id") == state) if state else df


def listed_only(df: DataFrame) -> DataFrame:
    """Drop the days before a series' first listed price."""
    return df.where(F.col("sell_price").isNotNull())


def sample_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col), F.lit(f"|{seed}")))


def pick_series(ids: DataFrame, n: int, seed: int) -> DataFrame:
    """``n`` ids in seeded hash order: reproducible on any partitioning (top-n, no full sort)."""
    return ids.orderBy(sample_key("id", seed), "id").limit(n)


def cap_series(df: DataFrame, n: int, seed: int) -> DataFrame:
    """Keep the rows of at most ``n`` series; 0 keeps all."""
    if n <= 0:
        return df
    return df.join(pick_series(df.select("id").distinct(), n, seed), "id", "left_semi")


def eligible_series(df: DataFrame, first_fold: int, min_history: int, n: int, seed: int) -> DataFrame:
    """Up to ``n`` series with at least ``min_history`` rows up to the earliest fold."""
    seen = df.where(F.col("d") <= first_fold).groupBy("id").agg(F.count(F.lit(1)).alias("n_days"))
    enough = seen.where(F.col("n_days") >= min_history)
    return pick_series(enough, n, seed) if n > 0 else enough


def contiguous(
    df: DataFrame, end_day: int, covariates: list[str], units: str = "sales"
) -> DataFrame:
    """Gap-free grid per series from its first day to ``end_day``.

    Missing units are 0; covariates are filled forward, then backward (before the first known
    value, that is the first known value of the series, which takes one pass). No join against a grid:
    every row carries its filled covariates and spreads over the days up to the next row of
    its series. One exchange and one sort; a series holds one row per day, so a window
    partition is bounded by the calendar.
    """
    by_day = Window.partitionBy("id").orderBy("d")
    past = by_day.rowsBetween(Window.unboundedPreceding, 0)
    series = by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = df.where(F.col("d") <= end_day).select(
        "id",
        F.col("d").alias("_from"),
        F.coalesce(F.lead("d").over(by_day) - 1, F.lit(end_day)).alias("_to"),
        F.col(units).alias("_units"),
        *[
            F.coalesce(F.last(c, ignorenulls=True).over(past), F.first(c, ignorenulls=True).over(series)).alias(c)
            for c in covariates
        ],
    )
    spread = known.withColumn("d", F.explode(F.sequence("_from", "_to")))
    own = F.when(F.col("d") == F.col("_from"), F.coalesce("_units", F.lit(0))).otherwise(F.lit(0))
    return spread.select("id", "d", own.alias(units), *covariates)


def dense_codes(values: DataFrame, column: str) -> DataFrame:
    """Dense integer codes of the sorted distinct values of one dimension column, from 0.

    The ranking runs over the distinct members of a dimension (stores, departments, event
    names), which are deduplicated before they meet in one window.
    """
    members = values.select(column).where(F.col(column).isNotNull()).distinct()
    ranked = Window.orderBy(column)
    return members.select(column, (F.row_number().over(ranked) - 1).alias(f"{column}_code"))


def with_codes(df: DataFrame, columns: list[str], names: list[str] | None = None) -> DataFrame:
    """Add global integer codes; a missing value gets -1."""
    out = df
    for column, name in zip(columns, names or [f"{c}_code" for c in columns], strict=True):
        codes = dense_codes(df, column).withColumnRenamed(f"{column}_code", "_code")
        out = out.join(codes, column, "left").withColumn(name, F.coalesce("_code", F.lit(-1))).drop("_code")
    return out


def history_windows(
    df: DataFrame, cutoff: int, horizon: int, history: int, covariates: list[str]
) -> DataFrame:
    """Per-series training window of one fold: units up to ``cutoff``, covariates beyond it.

    Units cover ``(cutoff - history, cutoff]``; covariates run to ``cutoff + horizon``. Series
    without a row in the history window are left out. Units after the cutoff are NULL.
    """
    start = cutoff - history
    cut = df.where((F.col("d") > start) & (F.col("d") <= cutoff + horizon))
    first_day = F.min("d").over(Window.partitionBy("id"))
    alive = cut.withColumn("_first", first_day).where(F.col("_first") <= cutoff).drop("_first")
    filled = contiguous(alive, cutoff + horizon, covariates)
    return filled.withColumn("sales", F.when(F.col("d") <= cutoff, F.col("sales")))


def label_frame(sales: DataFrame) -> DataFrame:
    """Binary label (sold or not) with its facets; the state is the store's prefix."""
    return sales.select(
        (F.col("sales") > 0).cast("int").alias("sold"),
        F.split("store_id", "_")[0].alias("state_id"),
        "dept_id",
        "store_id",
    )


def feature_sample(features: DataFrame, first_date: str, max_rows: int = 2000) -> DataFrame:
    """The first rows by series and day with a record id and an event time."""
    return (
        features.orderBy("id", "d")
        .limit(max_rows)
        .withColumn("record_id", F.concat_ws("_", "id", F.col("d").cast("string")))
        .withColumn("event_time", event_time(first_date))
    )


def event_time(first_date: str) -> Column:
    day = F.date_add(F.lit(first_date).cast("date"), F.col("d") - 1)
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00Z"))


def as_of(features: DataFrame, day: int, columns: list[str]) -> DataFrame:
    """Newest known row of every series on or before ``day``."""
    picked = features.where(F.col("d") <= day).groupBy("id").agg(
        F.max_by(F.struct("d", *columns), "d").alias("_row")
    )
    return picked.select("id", "_row.*")


def newest_rows(features: DataFrame, until: str, first_date: str, n: int = 10) -> DataFrame:
    """The ``n`` newest rows up to an event time; ties are broken by record id."""
    stamped = features.withColumn("event_time", event_time(first_date)).withColumn(
        "record_id", F.concat_ws("_", "id", F.col("d").cast("string"))
    )
    return stamped.where(F.col("event_time") <= until).orderBy(F.desc("event_time"), "record_id").limit(n)
