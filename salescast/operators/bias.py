"""Pre-training bias of a binary label between one facet value and the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bias_metrics(frame: DataFrame, facet: str, value: str, label: str = "sold") -> DataFrame:
    """Class imbalance and label-distribution distances as (metric, value) rows.

    ``d`` is the facet value, ``a`` everyone else; distances go from a to d. All follow from
    four conditional counts, so the frame is aggregated once. A distance that needs the log of
    an empty share is NULL.
    """
    in_facet = F.col(facet) == value
    counts = frame.agg(
        F.count_if(~in_facet).alias("na"),
        F.count_if(in_facet).alias("nd"),
        F.count_if(~in_facet & (F.col(label) == 1)).alias("pa"),
        F.count_if(in_facet & (F.col(label) == 1)).alias("pd"),
    )
    q = counts.select(
        "na", "nd",
        F.try_divide("pa", "na").alias("a1"),
        F.try_divide("pd", "nd").alias("d1"),
    ).withColumns({"a0": 1 - F.col("a1"), "d0": 1 - F.col("d1")})

    def kl(p: str, r):
        ratio = F.try_divide(F.col(p), r)
        return F.when(F.col(p) == 0, F.lit(0.0)).otherwise(F.col(p) * F.when(ratio > 0, F.ln(ratio)))

    gap0, gap1 = F.col("a0") - F.col("d0"), F.col("a1") - F.col("d1")
    mid0, mid1 = (F.col("a0") + F.col("d0")) / 2, (F.col("a1") + F.col("d1")) / 2
    metrics = {
        "CI": F.try_divide(F.col("na") - F.col("nd"), F.col("na") + F.col("nd")),
        "DPL": gap1,
        "KL": kl("a0", F.col("d0")) + kl("a1", F.col("d1")),
        "JS": (kl("a0", mid0) + kl("a1", mid1) + kl("d0", mid0) + kl("d1", mid1)) / 2,
        "KS": F.greatest(F.abs(gap0), F.abs(gap1)),
        "LP": F.sqrt(gap0 * gap0 + gap1 * gap1),
        "TVD": (F.abs(gap0) + F.abs(gap1)) / 2,
    }
    rows = [F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in metrics.items()]
    return q.select(F.inline(F.array(*rows)))
