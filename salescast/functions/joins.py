"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: list[str],
    spread_by: list[Column],
    salts: int | None = None,
    how: str = "left",
) -> DataFrame:
    """Join ``rows`` with a coarse ``lookup`` (one row per key) without a hot task.

    Each row takes one of ``salts`` salts from a hash of ``spread_by`` and the lookup row is
    repeated once per salt, so a key that owns a third of the rows is split over ``salts``
    tasks. The lookup holds one row per group; repeating it costs groups x salts rows. By default
    there is one salt for every eight shuffle partitions, 16 at least.
    Catalyst still broadcasts a lookup whose size estimate is under its threshold.
    """
    if how not in ("left", "inner"):
        raise ValueError("salted_join supports left and inner joins")
    salts = salts or max(16, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
    salted_rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_rows.join(repeated, [*on, "_salt"], how).drop("_salt")
