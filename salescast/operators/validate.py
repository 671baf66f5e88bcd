"""Ingest checks and data-quality rules: every table is checked in one aggregate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast.operators.reshape import DAY_PREFIX, day_columns
from salescast.schema import CALENDAR_BASE_COLS, ID_COLS, PRICE_COLS, SNAP_PREFIX, require_columns, snap_states


def _any_null(columns: list[str]):
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def sales_counts(wide: DataFrame) -> DataFrame:
    """Violation counts and statistics of the wide sales table.

    The day columns are folded per row as one array; duplicate ids come from a combined
    count per id.
    """
    units = F.array(*day_columns(wide))
    rows = wide.select(
        "id",
        _any_null(ID_COLS).alias("bad_id"),
        F.size(F.filter(units, lambda x: x.isNull())).alias("n_null"),
        F.size(F.filter(units, lambda x: x < 0)).alias("n_negative"),
        F.size(F.filter(units, lambda x: x == 0)).alias("n_zero"),
        F.size(units).alias("n_cells"),
    )
    per_id = rows.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("bad_id").alias("bad"),
        *[F.sum(c).alias(c) for c in ["n_null", "n_negative", "n_zero", "n_cells"]],
    )
    return per_id.agg(
        F.sum("n").alias("n_series"),
        F.max(F.lit(len(day_columns(wide)))).alias("n_days"),
        F.sum("bad").alias("null_ids"),
        F.count_if(F.col("n") > 1).alias("duplicate_ids"),
        F.sum("n_null").alias("null_units"),
        F.sum("n_negative").alias("negative_units"),
        (F.sum("n_zero") / F.sum("n_cells")).alias("zero_rate"),
    )


def _refuse(table: str, found, names: dict[str, str]) -> None:
    for column, problem in names.items():
        if found[column]:
            raise ValueError(f"{table}: {problem} ({found[column]})")


def validate_sales(wide: DataFrame) -> dict:
    """Raise on a broken sales table; otherwise return series, days and zero rate."""
    require_columns(wide, ID_COLS, "sales")
    days = [int(c[len(DAY_PREFIX):]) for c in day_columns(wide)]
    if not days:
        raise ValueError("sales: no day columns")
    if days != list(range(1, len(days) + 1)):
        raise ValueError("sales: day columns do not run from 1 without a gap")
    found = sales_counts(wide).first()
    _refuse("sales", found, {
        "null_ids": "NULL in an identity column",
        "duplicate_ids": "series ids occur more than once",
        "null_units": "NULL units",
        "negative_units": "negative units",
    })
    return {"n_series": found["n_series"], "n_days": found["n_days"], "zero_rate": found["zero_rate"]}


def calendar_counts(calendar: DataFrame) -> DataFrame:
    """Violation counts and the date span of the calendar.

    Order is that of the day key: the date must advance by one day per day number. The
    calendar has one row per day, so one ordered window holds it.
    """
    day = F.regexp_extract(F.col("d").cast("string"), r"(\d+)$", 1).cast("int")
    dated = calendar.withColumn("_date", F.to_date("date")).withColumn("_d", day)
    step = F.datediff("_date", F.lag("_date").over(Window.orderBy("_d", "_date")))
    flags = [SNAP_PREFIX + s for s in snap_states(calendar)]
    bad_flag = reduce(
        lambda a, b: a | b, [F.coalesce(~F.col(c).isin(0, 1), F.lit(True)) for c in flags], F.lit(False)
    )
    return dated.select("d", "_date", step.alias("_step"), bad_flag.alias("_bad")).agg(
        F.count(F.lit(1)).alias("n_days"),
        F.min("_date").cast("string").alias("first_date"),
        F.max("_date").cast("string").alias("last_date"),
        F.count_if(F.col("_step") < 0).alias("unsorted"),
        F.count_if((F.col("_step") >= 0) & (F.col("_step") != 1)).alias("gaps"),
        (F.count("d") - F.countDistinct("d")).alias("duplicate_days"),
        F.count_if("_bad").alias("bad_flags"),
    )


def validate_calendar(calendar: DataFrame) -> dict:
    require_columns(calendar, CALENDAR_BASE_COLS, "calendar")
    found = calendar_counts(calendar).first()
    _refuse("calendar", found, {
        "duplicate_days": "day keys occur more than once",
        "unsorted": "dates do not ascend",
        "gaps": "dates skip or repeat a day",
        "bad_flags": "a benefit flag is not 0 or 1",
    })
    return {k: found[k] for k in ("n_days", "first_date", "last_date")}


def price_counts(prices: DataFrame) -> DataFrame:
    """Violation counts of the weekly prices."""
    key = ["store_id", "item_id", "wm_yr_wk"]
    per_key = prices.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(_any_null(PRICE_COLS)).alias("nulls"),
        F.count_if(F.col("sell_price") <= 0).alias("low"),
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.countDistinct("item_id").alias("n_items"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("null_values"),
        F.coalesce(F.sum("low"), F.lit(0)).alias("non_positive"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
    )


def validate_prices(prices: DataFrame) -> dict:
    require_columns(prices, PRICE_COLS, "prices")
    found = price_counts(prices).first()
    _refuse("prices", found, {
        "null_values": "NULL values",
        "non_positive": "prices at or below 0",
        "duplicate_keys": "store, item and week occur more than once",
    })
    return {"n_rows": found["n_rows"], "n_items": found["n_items"]}


def quality_rules(features: DataFrame, min_rows: int, last_day: int = 2000) -> DataFrame:
    """One row per rule with the observed number of offending rows (or rows) and the verdict."""
    rules = {
        "id is complete": F.count_if(F.col("id").isNull()),
        "d is complete": F.count_if(F.col("d").isNull()),
        "sales >= 0": F.count_if(~F.coalesce(F.col("sales") >= 0, F.lit(False))),
        "sell_price > 0": F.count_if(~F.coalesce(F.col("sell_price") > 0, F.lit(False))),
        "d >= 1": F.count_if(~F.coalesce(F.col("d") >= 1, F.lit(False))),
        f"d <= {last_day}": F.count_if(~F.coalesce(F.col("d") <= last_day, F.lit(False))),
        f"row count > {min_rows}": F.count(F.lit(1)),
    }
    found = features.agg(*[rule.alias(f"r{i}") for i, rule in enumerate(rules.values())])
    rows = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"r{i}").alias("observed"),
            ((F.col(f"r{i}") > min_rows) if name.startswith("row count") else (F.col(f"r{i}") == 0)).alias("passed"),
        )
        for i, name in enumerate(rules)
    ]
    return found.select(F.inline(F.array(*rows)))
