"""Table contracts, hierarchy levels and pipeline settings."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values, down to the end of this module: column names, levels, intervals and defaults are the
# contract of the tables and reports.

# Identity of one series; every fact table carries these columns.
ID_COLS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]
HIERARCHY = ID_COLS[1:]
SALES_LONG_COLS = [*ID_COLS, "d", "sales"]

CALENDAR_BASE_COLS = [
    "date", "wm_yr_wk", "weekday", "wday", "month", "year", "d",
    "event_name_1", "event_type_1", "event_name_2", "event_type_2",
]
# Calendar attributes of day t that are known in advance.
CALENDAR_ATTRS = ["date", "wm_yr_wk", "wday", "month", "year", "event_name_1", "event_type_1"]
PRICE_COLS = ["store_id", "item_id", "wm_yr_wk", "sell_price"]
SNAP_PREFIX = "snap_"

CALENDAR_SCHEMA_HEAD = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("wm_yr_wk", T.IntegerType()),
    T.StructField("weekday", T.StringType()),
    T.StructField("wday", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("d", T.StringType()),
    T.StructField("event_name_1", T.StringType()),
    T.StructField("event_type_1", T.StringType()),
    T.StructField("event_name_2", T.StringType()),
    T.StructField("event_type_2", T.StringType()),
])
PRICE_SCHEMA = T.StructType([
    T.StructField("store_id", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("wm_yr_wk", T.IntegerType()),
    T.StructField("sell_price", T.DoubleType()),
])

# Model inputs: known at the origin, or known in advance for the target day.
DYNAMIC_COLS = [
    "lag_7", "lag_28", "rolling_mean_7", "rolling_std_7", "rolling_mean_28", "rolling_std_28",
]
TARGET_COLS = [
    "wday", "month", "event_name_1", "event_type_1", "snap", "sell_price", "price_rel_dept",
]
CATEGORICAL_COLS = [*HIERARCHY, "wday", "month", "event_name_1", "event_type_1", "snap"]
NUMERIC_COLS = [*DYNAMIC_COLS, "horizon", "sell_price", "price_rel_dept"]
MODEL_COLS = [*CATEGORICAL_COLS, *NUMERIC_COLS]

MONITORED_COLS = [
    "lag_7", "lag_28", "rolling_mean_7", "rolling_mean_28", "sell_price", "price_rel_dept",
]

# Hierarchy levels of the evaluation panel and the columns that key each group.
LEVELS: dict[str, list[str]] = {
    "total": [],
    "state": ["state_id"],
    "store": ["store_id"],
    "category": ["cat_id"],
    "department": ["store_id", "dept_id"],
    "item_store": ["id"],
}
# nominal coverage in percent -> (lower, upper) quantile
INTERVALS: dict[int, tuple[float, float]] = {50: (0.25, 0.75), 90: (0.05, 0.95)}


@dataclass(frozen=True)
class Settings:
    """Pipeline parameters; the defaults are the published operating point."""

    lags: tuple[int, ...] = (7, 28)
    windows: tuple[int, ...] = (7, 28)
    drop_pre_release: bool = True
    horizon: int = 28
    quantiles: tuple[float, ...] = (0.05, 0.25, 0.5, 0.75, 0.95)
    n_train_origins: int = 8
    origin_stride: int = 14
    n_folds: int = 3
    fold_stride: int = 28
    max_series: int = 0
    state_filter: str = ""
    min_history: int = 28
    prior_window: int = 28
    drift_window: int = 28
    seed: int = 42

    def __post_init__(self) -> None:
        positive = ["horizon", "n_train_origins", "origin_stride", "n_folds", "fold_stride",
                    "min_history", "prior_window", "drift_window"]
        for name in positive:
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
        if self.max_series < 0:
            raise ValueError("max_series must be 0 (all) or positive")
        if not self.quantiles or any(not 0.0 < q < 1.0 for q in self.quantiles):
            raise ValueError("quantiles must lie inside (0, 1)")

    def but(self, **changes: object) -> "Settings":
        return replace(self, **changes)


def q_name(q: float) -> str:
    """Column of a quantile: 0.05 -> ``q05``, 0.5 -> ``q50``, 0.025 -> ``q025``."""
    if not 0.0 < q < 1.0:
        raise ValueError(f"quantile outside (0, 1): {q}")
    return "q" + f"{q:.10f}".split(".")[1].rstrip("0").ljust(2, "0")


def q_names(quantiles) -> list[str]:
    return [q_name(q) for q in sorted(quantiles)]


def q_export_name(q: float) -> str:
    """Dotted name used in exported archives: 0.05 -> ``q0.05``."""
    return f"q{q}"


MEDIAN = q_name(0.5)


def snap_states(calendar: DataFrame) -> list[str]:
    """States that have their own ``snap_<state>`` flag in this calendar."""
    return [c[len(SNAP_PREFIX):] for c in calendar.columns if c.startswith(SNAP_PREFIX)]


def require_columns(df: DataFrame, needed: list[str], table: str) -> None:
    absent = sorted(set(needed) - set(df.columns))
    if absent:
        raise ValueError(f"{table}: required columns are missing: {absent}")
