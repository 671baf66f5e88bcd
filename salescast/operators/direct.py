"""Origins, folds and the direct multi-horizon table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.schema import DYNAMIC_COLS, HIERARCHY, MODEL_COLS, TARGET_COLS


def last_day(features: DataFrame) -> int:
    """Newest day of a table: one aggregate over one column, returned as a scalar."""
    day = features.agg(F.max("d")).first()[0]
    if day is None:
        raise ValueError("the table has no rows")
    return int(day)


def _grid(latest: int, n: int, stride: int) -> list[int]:
    return [day for day in range(latest - (n - 1) * stride, latest + 1, stride) if day > 0]


def origin_grid(latest: Column, n: int, stride: int) -> Column:
    """The days of :func:`_grid` as an array expression."""
    return F.filter(F.sequence(latest - (n - 1) * stride, latest, F.lit(stride)), lambda day: day > 0)


def origins_ending(last: int, n: int, stride: int, horizon: int) -> list[int]:
    """The newest ``n`` origins, ``stride`` days apart, whose horizon is fully observed."""
    return _grid(last - horizon, n, stride)


def train_origins(fold: int, n: int, stride: int, horizon: int) -> list[int]:
    """Training origins of a fold: every target day lies on or before the fold."""
    return _grid(fold - horizon, n, stride)


def holdout(origins: list[int]) -> tuple[list[int], int]:
    """(training origins, newest origin); needs at least two."""
    if len(origins) < 2:
        raise ValueError(f"a holdout needs two or more origins, got {origins}")
    return origins[:-1], origins[-1]


def latest_origin(features: DataFrame, horizon: int) -> int:
    return last_day(features) - horizon


def direct_table(
    features: DataFrame, origins: list[int], horizon: int, extra: list[str] | None = None
) -> DataFrame:
    """One row per series, origin and horizon with the target and the model inputs.

    The row of day O+1 holds what was known at the end of day O; it becomes the origin's row.
    The origin rows of a series are gathered into one short array (at most one entry per
    origin) and meet the target days on ``id`` alone; each target day then fans out to the
    origins that reach it. Both sides are cut to the needed days at the scan, and only the
    observed days are shuffled instead of every (origin, horizon) pair.
    """
    wanted = sorted(origins)
    known = features.where(F.col("d").isin([o + 1 for o in wanted])).select(
        "id", F.struct((F.col("d") - 1).alias("origin"), *HIERARCHY, *DYNAMIC_COLS).alias("_row")
    )
    per_series = known.groupBy("id").agg(F.collect_list("_row").alias("_origins"))
    spans = [F.col("d").between(o + 1, o + horizon) for o in wanted]
    reach = spans[0] if spans else F.lit(False)
    for span in spans[1:]:
        reach = reach | span
    targets = features.where(reach).select(
        "id", F.col("d").alias("target_day"), "sales", *TARGET_COLS, *(extra or [])
    )
    reached = F.filter(
        "_origins", lambda o: F.col("target_day").between(o["origin"] + 1, o["origin"] + horizon)
    )
    return (
        targets.join(per_series, "id")
        .withColumn("_origin", F.explode(reached))
        .select(
            "id",
            *[F.col("_origin")[c].alias(c) for c in HIERARCHY],
            F.col("_origin")["origin"].alias("origin"),
            (F.col("target_day") - F.col("_origin")["origin"]).alias("horizon"),
            "target_day",
            "sales",
            *[F.col("_origin")[c].alias(c) for c in DYNAMIC_COLS],
            *TARGET_COLS,
            *(extra or []),
        )
    )


def model_frame(table: DataFrame) -> DataFrame:
    """Identity, label and the model inputs only."""
    front = ["id", "origin", "target_day", "sales"]
    return table.select(*front, *[c for c in MODEL_COLS if c not in front])
