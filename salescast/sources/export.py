"""Exports: series as JSON lines, batch-scoring rows, panel tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.operators.direct import direct_table
from salescast.operators.reshape import with_codes
from salescast.schema import MODEL_COLS


def series_json(sales: DataFrame, first_date: str, holdout: int) -> DataFrame:
    """JSON line per series for training (without the last ``holdout`` days) and testing.

    A series starts at its first positive sale. It is kept only when the training part has
    more than ``holdout`` days, so that there is history besides the scored window. One
    series becomes one array; its length is the number of days on record.
    """
    coded = with_codes(sales.select("id", "store_id", "dept_id", "d", "sales"), ["store_id", "dept_id"])
    packed = coded.groupBy("id").agg(
        F.min(F.when(F.col("sales") > 0, F.col("d"))).alias("_first"),
        F.array_sort(F.collect_list(F.struct("d", "sales"))).alias("_days"),
        F.min("store_id_code").alias("_store"),
        F.min("dept_id_code").alias("_dept"),
    ).where(F.col("_first").isNotNull())
    trimmed = packed.withColumn("_days", F.filter("_days", lambda x: x["d"] >= F.col("_first")))
    kept = trimmed.where(F.size("_days") - holdout > holdout)
    start = F.date_format(
        F.date_add(F.lit(first_date).cast("date"), F.get("_days", F.lit(0))["d"] - 1), "yyyy-MM-dd"
    )
    units = F.transform("_days", lambda x: x["sales"])
    parts = F.array(
        F.struct(F.lit("train").alias("split"), F.slice(units, 1, F.size("_days") - holdout).alias("target")),
        F.struct(F.lit("test").alias("split"), units.alias("target")),
    )
    return kept.select("id", start.alias("_start"), F.array("_store", "_dept").alias("_cat"), F.inline(parts)).select(
        "split",
        "id",
        F.to_json(
            F.struct(F.col("_start").alias("start"), "target", F.col("_cat").alias("cat"))
        ).alias("line"),
    )


def write_series_json(lines: DataFrame, path: str) -> None:
    """One text folder per split, ordered by series within each file."""
    for split in ("train", "test"):
        part = lines.where(F.col("split") == split).repartitionByRange("id")
        part.sortWithinPartitions("id").select("line").write.mode("overwrite").text(f"{path}/{split}")


def batch_inputs(features: DataFrame, origin: int, horizon: int) -> DataFrame:
    """Rows to score at one origin: identity and model inputs side by side."""
    table = direct_table(features, [origin], horizon)
    keys = ["id", "origin", "target_day"]
    return table.select(*keys, *[c for c in MODEL_COLS if c not in keys])


def save_panel(panel: dict[str, DataFrame], path: str) -> None:
    """Each panel table as a single CSV; these tables have a few dozen rows at most."""
    for name, table in panel.items():
        table.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}/{name}")
