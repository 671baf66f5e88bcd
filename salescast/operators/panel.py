"""Evaluation panel: metrics by hierarchy level, by horizon, and interval calibration."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.functions import metrics as M
from salescast.schema import HIERARCHY, INTERVALS, LEVELS, MEDIAN, q_name

# The finest grouping that still holds every key above the single series.
_UPPER = ["state_id", "store_id", "cat_id", "dept_id"]
_UPPER_LEVELS = {name: keys for name, keys in LEVELS.items() if "id" not in keys}
_SEP = "\u001f"


def dollar_weights(history: DataFrame, window: int = 28) -> DataFrame:
    """Price times units of each series over the last ``window`` days of the history."""
    newest = history.agg(F.max("d")).scalar()
    return (
        history.where(F.col("d") > newest - window)
        .groupBy("id")
        .agg(F.sum(F.col("sell_price") * F.col("sales")).alias("weight"))
    )


def _fan_out(df: DataFrame) -> DataFrame:
    """Repeat each pre-aggregated row once per upper level with that level's group key."""
    parts = [
        F.struct(
            F.lit(name).alias("level"),
            (F.concat_ws(_SEP, *keys) if keys else F.lit("")).alias("key"),
        )
        for name, keys in _UPPER_LEVELS.items()
    ]
    return df.withColumn("_part", F.explode(F.array(*parts))).withColumns(
        {"level": F.col("_part.level"), "key": F.col("_part.key")}
    ).drop("_part")


def _upper_sums(df: DataFrame, day: str, sums: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """Sums per (level, key, day) of the levels above the series, apart for each value of ``by``.

    One aggregate by store, category and department comes first, so the fan-out over levels
    touches that small result and not the series rows. Both combine before their shuffle.
    """
    totals = [F.sum(c).alias(c) for c in sums]
    return _fan_out(df.groupBy(*by, *_UPPER, day).agg(*totals)).groupBy(*by, "level", "key", day).agg(*totals)


def _series_level(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("id", "key").withColumn("level", F.lit("item_store"))


def level_scales(history: DataFrame, season: int = 7) -> DataFrame:
    """Naive scales of every group. A series has one row per day, so the series level needs
    no aggregate and reads a table bucketed by series without an exchange."""
    upper = M.naive_scales(_upper_sums(history, "d", ["sales"]), ["level", "key"], season)
    return upper.unionByName(_series_level(M.naive_scales(history, ["id"], season)))


def rolled_up(preds: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Actual and median summed per (level, key, target day), over all folds."""
    sums = ["actual", MEDIAN]
    series = preds.groupBy(*by, "id", "target_day").agg(*[F.sum(c).alias(c) for c in sums])
    return _upper_sums(preds, "target_day", sums, by).unionByName(_series_level(series))


def group_weights(preds: DataFrame, weights: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Weight of every group: the sum over its forecast series; 1 for the total level."""
    members = preds.select(*by, "id", *HIERARCHY).distinct().join(weights, "id")
    bottom = members.groupBy(*by, F.lit("item_store").alias("level"), F.col("id").alias("key")).agg(
        F.sum("weight").alias("weight")
    )
    upper = (
        _fan_out(members.groupBy(*by, *_UPPER).agg(F.sum("weight").alias("weight")))
        .groupBy(*by, "level", "key")
        .agg(F.sum("weight").alias("weight"))
        .where(F.col("level") != "total")
    )
    return bottom.unionByName(upper)


def by_level(preds: DataFrame, history: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """WAPE, MASE and RMSSE at each level; with ``by``, at each level for each of its values.

    WAPE is pooled over a level. MASE and RMSSE are scaled per group by the group's own
    history and then averaged by dollar weight; a group without a scale drops out.
    """
    keys = ["level", "key"]
    scales = level_scales(history)
    scored = rolled_up(preds.withColumn("actual", F.col("actual").cast("double")), by)
    err = F.abs(F.col("actual") - F.col(MEDIAN))
    errors = scored.groupBy(*by, *keys).agg(
        F.sum(err).alias("abs_err"),
        F.sum(F.abs("actual")).alias("volume"),
        F.avg(err).alias("mae"),
        F.avg((F.col("actual") - F.col(MEDIAN)) * (F.col("actual") - F.col(MEDIAN))).alias("mse"),
    )
    weights = group_weights(preds, dollar_weights(history), by)
    groups = errors.join(scales, keys, "left").join(weights, [*by, *keys], "left").select(
        *by,
        "level",
        "abs_err",
        "volume",
        F.when(F.col("seasonal_mae") > 0, F.col("mae") / F.col("seasonal_mae")).alias("g_mase"),
        F.when(F.col("naive_mse") > 0, F.sqrt(F.col("mse") / F.col("naive_mse"))).alias("g_rmsse"),
        F.when(F.col("level") == "total", 1.0).otherwise(F.coalesce("weight", F.lit(0.0))).alias("weight"),
    )
    return groups.groupBy(*by, "level").agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.when(F.sum("volume") > 0, F.sum("abs_err") / F.sum("volume")).alias("wape"),
        M.weighted_mean("g_mase", "weight").alias("mase"),
        M.weighted_mean("g_rmsse", "weight").alias("rmsse"),
    )


def by_horizon(preds: DataFrame) -> DataFrame:
    """WAPE and interval coverage of the series forecasts per horizon."""
    return preds.groupBy("horizon").agg(
        M.wape("actual", MEDIAN).alias("wape"), *M.interval_coverages("actual", preds.columns)
    )


def calibration(preds: DataFrame) -> DataFrame:
    """Nominal and empirical coverage of each interval: one aggregate, then one row each."""
    known = {
        n: (q_name(lo), q_name(hi))
        for n, (lo, hi) in INTERVALS.items()
        if q_name(lo) in preds.columns and q_name(hi) in preds.columns
    }
    found = preds.agg(*[M.coverage("actual", lo, hi).alias(f"c{n}") for n, (lo, hi) in known.items()])
    rows = F.array(*[
        F.struct(F.lit(n / 100.0).alias("nominal_coverage"), F.col(f"c{n}").alias("empirical_coverage"))
        for n in known
    ])
    return found.select(F.inline(rows))


def history_before(features: DataFrame, earliest_origin: int) -> DataFrame:
    """Rows that may set scales and weights: nothing after the earliest origin."""
    return features.where(F.col("d") <= earliest_origin).select(
        "id", *HIERARCHY, "d", "sales", "sell_price"
    )


def build_panel(preds: DataFrame, features: DataFrame, earliest_origin: int) -> dict[str, DataFrame]:
    return {
        "by_level": by_level(preds, history_before(features, earliest_origin)),
        "by_horizon": by_horizon(preds),
        "calibration": calibration(preds),
    }


def headline(panel: dict[str, DataFrame]) -> DataFrame:
    """One row: bottom and total WAPE, mean level RMSSE, and the coverages."""
    rows = panel["by_level"].select("level", "wape", "rmsse").unionByName(
        panel["calibration"], allowMissingColumns=True
    )

    def covered(nominal: int):
        hit = F.col("nominal_coverage") == nominal / 100.0
        return F.max(F.when(hit, F.col("empirical_coverage"))).alias(f"coverage_{nominal}")

    return rows.agg(
        F.max(F.when(F.col("level") == "item_store", F.col("wape"))).alias("wape_item_store"),
        F.max(F.when(F.col("level") == "total", F.col("wape"))).alias("wape_total"),
        F.avg("rmsse").alias("wrmsse"),
        *[covered(n) for n in INTERVALS],
    )


def compared(models: dict[str, DataFrame], history: DataFrame) -> DataFrame:
    """Levels of several models' forecasts side by side, metric columns suffixed by model name.

    The model is a grouping key over one roll-up, so history is scaled and weighed once for all of
    them. A level that some model lacks is left out.
    """
    columns = ["id", *HIERARCHY, "target_day", "actual", MEDIAN]
    named = [preds.select(*columns, F.lit(name).alias("model")) for name, preds in models.items()]
    levels = by_level(reduce(DataFrame.unionByName, named), history, ("model",))
    return levels.groupBy("level").agg(F.count(F.lit(1)).alias("n_models"), *[
        F.max(F.when(F.col("model") == name, F.col(m))).alias(f"{m}_{name}")
        for m in ("wape", "mase", "rmsse") for name in models
    ]).where(F.col("n_models") == len(models)).drop("n_models")


def fold_metrics(preds: DataFrame, quantiles) -> DataFrame:
    """Rows, WAPE and mean pinball loss of every fold."""
    return preds.groupBy(F.col("origin").alias("fold_origin")).agg(
        F.count(F.lit(1)).alias("n_test_rows"),
        M.wape("actual", MEDIAN).alias("wape"),
        M.mean_pinball("actual", quantiles).alias("mean_pinball"),
    )
