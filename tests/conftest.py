"""Small fixtures; schemas and values are listed in FIXTURES.md."""

import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master(f"local[{min(8, os.cpu_count() or 1)}]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


IDS = [
    ("saw-east", "TOOLS_7_18", "TOOLS_7", "TOOLS", "OR_4", "OR"),
    ("saw-west", "TOOLS_7_18", "TOOLS_7", "TOOLS", "NV_2", "NV"),
    ("rake-east", "YARD_3_55", "YARD_3", "YARD", "OR_4", "OR"),
    ("rope-east", "TOOLS_7_61", "TOOLS_7", "TOOLS", "OR_4", "OR"),
]
UNITS = {
    "saw-east": [3, 0, 5, 1, 2, 0, 4, 6, 1],
    "saw-west": [0, 0, 2, 7, 1, 3, 0, 2, 2],
    "rake-east": [1, 4, 0, 0, 0, 2, 9, 3, 5],
    "rope-east": [2, 2, 1, 0, 6, 1, 0, 0, 3],
}
DAYS = 9
ID_SCHEMA = "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string"


@pytest.fixture
def wide(spark):
    days = ", ".join(f"d_{d} int" for d in range(1, DAYS + 1))
    return spark.createDataFrame([(*ids, *UNITS[ids[0]]) for ids in IDS], f"{ID_SCHEMA}, {days}")


@pytest.fixture
def calendar(spark):
    """Five days of week 610 and four of week 611; each state has its own pattern of flags."""
    return spark.sql(f"""
        SELECT date, IF(n <= 5, 610, 611) AS wm_yr_wk, date_format(date, 'EEEE') AS weekday,
            dayofweek(date) % 7 + 1 AS wday, month(date) AS month, year(date) AS year, concat('d_', n) AS d,
            IF(n = 2, 'Fair', NULL) AS event_name_1, IF(n = 2, 'Cultural', NULL) AS event_type_1,
            CAST(NULL AS string) AS event_name_2, CAST(NULL AS string) AS event_type_2,
            CAST(n % 3 = 0 AS int) AS snap_OR, CAST(n <= 4 AS int) AS snap_NV, 0 AS snap_CO
        FROM (SELECT explode(sequence(1, {DAYS})) AS n) LATERAL VIEW explode(array(date_add(DATE'2014-03-04', n))) AS date
    """)


@pytest.fixture
def prices(spark):
    """The rake has no price in the first week."""
    rows = [
        ("OR_4", "TOOLS_7_18", 610, 12.0), ("OR_4", "TOOLS_7_18", 611, 9.0), ("NV_2", "TOOLS_7_18", 610, 12.0),
        ("NV_2", "TOOLS_7_18", 611, 12.0), ("OR_4", "TOOLS_7_61", 610, 4.0), ("OR_4", "TOOLS_7_61", 611, 4.0),
        ("OR_4", "YARD_3_55", 611, 21.5),
    ]
    return spark.createDataFrame(rows, "store_id string, item_id string, wm_yr_wk int, sell_price double")


# Series of the feature table: their stores differ, their department is one. The last one can be cut short.
SERIES = ["elm-east", "oak-east", "oak-west", "fir-east"]
COLD = "fir-east"
LAST_DAY = 96


def units(name: str, d: int, series=SERIES) -> int:
    """Rising units whose place in the series can be told from the value."""
    return 2 * d + 7 * (list(series).index(name) % 5)


def designed(spark, series=SERIES, days=LAST_DAY):
    """Feature rows with true lags and rolling statistics of :func:`units`, a price step every 24 days and one fair."""
    rows = []
    for s, name in enumerate(series):
        west = name.endswith("west")
        for d in range(1, days + 1):
            y = [units(name, k, series) for k in range(1, d + 1)]
            past = y[:-1]
            rolling = []
            for w in (7, 28):
                cut = past[-w:]
                mean = sum(cut) / w if len(cut) == w else None
                rolling += [mean, (sum((v - mean) ** 2 for v in cut) / (w - 1)) ** 0.5 if mean is not None else None]
            lag = [float(past[-k]) if len(past) >= k else None for k in (7, 28)]
            rows.append((
                name, name.split("-")[0], "TREES_2", "TREES", "NV_2" if west else "OR_4", "NV" if west else "OR", d, y[-1], *lag, *rolling,
                (d + 2) % 7 + 1, 3 + d // 31, "Fair" if d % 40 == 9 else None, "Cultural" if d % 40 == 9 else None,
                int(d % 5 < 2), 6.5 + s % 5 + 0.75 * (d // 24), 0.9 + 0.05 * (s % 5),
            ))
    return spark.createDataFrame(
        rows,
        f"{ID_SCHEMA}, d int, sales int, lag_7 double, lag_28 double, rolling_mean_7 double, rolling_std_7 double, "
        "rolling_mean_28 double, rolling_std_28 double, wday int, month int, event_name_1 string, event_type_1 string, "
        "snap int, sell_price double, price_rel_dept double",
    )


@pytest.fixture
def feature_rows(spark):
    return designed(spark)


@pytest.fixture
def cold_rows(feature_rows):
    return feature_rows.where((F.col("id") != COLD) | (F.col("d") <= 10))
