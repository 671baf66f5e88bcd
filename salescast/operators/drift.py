"""Input drift: population stability index per feature."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.functions.joins import salted_join
from salescast.functions.quantiles import exact_quantiles
from salescast.session import checkpointed

DRIFT_LINE = 0.2
SHARE_FLOOR = 1e-6


def bin_probabilities(bins: int) -> list[float]:
    """0 .. 1 in ``bins`` even steps, as multiples of the step."""
    step = 1.0 / bins
    return [i * step for i in range(bins)] + [1.0]


def drift_windows(features: DataFrame, last: int, window: int) -> tuple[DataFrame, DataFrame]:
    """(reference, current): the window before the last one, and the last one."""
    current = features.where(F.col("d") > last - window)
    reference = features.where((F.col("d") <= last - window) & (F.col("d") > last - 2 * window))
    return reference, current


def _long(df: DataFrame, columns: list[str], r: int, k: int) -> DataFrame:
    """(feature, value) rows that count for the reference (r) or the current side (k)."""
    parts = [
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns
    ]
    return df.select(F.inline(F.array(*parts))).where(
        F.col("value").isNotNull() & ~F.isnan("value")
    ).select("feature", "value", F.lit(r).alias("r"), F.lit(k).alias("k"))


def feature_drift(
    reference: DataFrame, current: DataFrame, columns: list[str],
    threshold: float = DRIFT_LINE, bins: int = 10,
) -> DataFrame:
    """PSI and drift flag of every column that both sides have.

    Bins are the distinct exact quantiles of the reference with open outer ends. Both sides are
    counted per feature and value in one aggregate, which is written: the edges and the bins
    both read it, so each side is scanned once and the join sees distinct values only. A feature
    with fewer than two distinct edges, or with an empty side, scores 0.
    """
    shared = [c for c in columns if c in reference.columns and c in current.columns]
    if not shared:
        raise ValueError("no monitored column exists on both sides")
    cells = checkpointed(
        _long(reference, shared, 1, 0)
        .unionByName(_long(current, shared, 0, 1))
        .groupBy("feature", "value")
        .agg(F.sum("r").alias("r"), F.sum("k").alias("k"))
    )
    edges = exact_quantiles(cells, ["feature"], "value", bin_probabilities(bins), count="r").select(
        "feature", F.array_distinct("quantiles").alias("edges")
    )
    inner = F.slice("edges", 2, F.greatest(F.size("edges") - 2, F.lit(0)))
    binned = (
        salted_join(cells, edges, ["feature"], [F.col("value")], how="inner")
        .where(F.size("edges") >= 2)
        .withColumn("bin", F.size(F.filter(inner, lambda e: e <= F.col("value"))))
        .groupBy("feature", "bin")
        .agg(F.sum("r").alias("r"), F.sum("k").alias("k"))
    )
    totals = binned.groupBy("feature").agg(
        F.sum("r").alias("nr"),
        F.sum("k").alias("nk"),
        F.collect_list(F.struct("r", "k")).alias("cells"),  # at most `bins` entries
    )

    def share(x, n):
        return F.greatest(x / n, F.lit(SHARE_FLOOR))

    def term(cell):
        c, r = share(cell["k"], F.col("nk")), share(cell["r"], F.col("nr"))
        return (c - r) * F.ln(c / r)

    scored = totals.where((F.col("nr") > 0) & (F.col("nk") > 0)).select(
        "feature",
        F.aggregate(F.transform("cells", term), F.lit(0.0), lambda acc, x: acc + x).alias("psi"),
    )
    # Every shared column gets a row; the list of features is the given list of columns.
    names = reference.sparkSession.createDataFrame([(c,) for c in shared], "feature string")
    return names.join(scored, "feature", "left").select(
        "feature",
        F.coalesce("psi", F.lit(0.0)).alias("psi"),
        (F.coalesce("psi", F.lit(0.0)) > threshold).alias("drifted"),
    )


def psi(reference: DataFrame, current: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """One row with the PSI of one column."""
    return feature_drift(reference, current, [column], bins=bins).select("psi")
