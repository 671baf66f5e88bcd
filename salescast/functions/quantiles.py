"""Exact quantiles in parallel, and quantile-column post-processing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescast.schema import q_names


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: list[float], count: str | None = None,
    ranges: int = 64,
) -> DataFrame:
    """Exact linearly interpolated quantiles per group: ``keys, n, quantiles``.

    No group is ever sorted in one task. Values are first counted (map-side combined), then
    each group is cut into value ranges at approximate quantiles. The cuts only divide the
    work: prefix counts over the ranges locate the ranks, and just the ranges that hold a
    wanted rank are ordered, each on its own. NULLs are left out. With ``count`` the rows are
    already counted: one row per group and value.
    """
    known = df.where(F.col(value).isNotNull())
    number = F.col(value).cast("double").alias("_v")
    if count:
        counts = known.where(F.col(count) > 0).select(*keys, number, F.col(count).alias("_c"))
    else:
        counts = known.groupBy(*keys, number).agg(F.count(F.lit(1)).alias("_c"))
    splits = _doubles([i / ranges for i in range(1, ranges)])
    cuts = counts.groupBy(*keys).agg(
        F.percentile_approx("_v", splits, 10000).alias("_cuts"), F.sum("_c").alias("_n")
    )
    # Per group: how many rows lie in each range, and the ranks every probability needs.
    # A rank array has two entries per probability, a range array at most `ranges` entries.
    ranged = (
        _attach(counts, cuts, keys)
        .withColumn("_range", F.size(F.filter("_cuts", lambda c: c <= F.col("_v"))))
        .drop("_cuts")
    )
    sizes = ranged.groupBy(*keys, "_n", "_range").agg(F.sum("_c").alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    wanted = F.array_distinct(F.flatten(F.transform(
        _doubles(probs), lambda p: F.array(F.floor(_position(p)), F.ceil(_position(p)))
    )))
    holders = (
        starts.withColumn(
            "_ranks",
            F.filter(
                wanted,
                lambda r: (r >= F.col("_start")) & (r < F.col("_start") + F.col("_size")),
            ),
        )
        .where(F.size("_ranks") > 0)
        .select(*keys, "_range", "_start", "_ranks")
    )
    in_range = Window.partitionBy(*keys, "_range").orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    found = (
        ranged.join(holders, [*keys, "_range"])
        .withColumn("_end", F.col("_start") + F.sum("_c").over(in_range))
        .withColumn(
            "_rank",
            F.explode(F.filter(
                "_ranks",
                lambda r: (r >= F.col("_end") - F.col("_c")) & (r < F.col("_end")),
            )),
        )
    )
    by_rank = found.groupBy(*keys, "_n").agg(
        F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at")
    )
    return by_rank.select(
        *keys,
        F.col("_n").alias("n"),
        F.transform(_doubles(probs), _interpolated).alias("quantiles"),
    )


def _attach(counts: DataFrame, cuts: DataFrame, keys: list[str]) -> DataFrame:
    from salescast.functions.joins import salted_join

    return salted_join(counts, cuts, keys, [F.col("_v")], how="inner")


def _doubles(values: list[float]) -> Column:
    return F.expr("array(" + ", ".join(f"{v!r}D" for v in values) + ")")


def _position(p: Column) -> Column:
    return (F.col("_n") - 1).cast("double") * p


def _interpolated(p: Column) -> Column:
    pos = _position(p)
    low = F.element_at("_at", F.floor(pos))
    high = F.element_at("_at", F.ceil(pos))
    return low + (high - low) * (pos - F.floor(pos))


def unit_quantiles(df: DataFrame, keys: list[str], quantiles, value: str = "sales") -> DataFrame:
    """Exact quantile columns of integer units per group.

    Rows are first counted per group and unit value, combined before the shuffle. The
    ``percentile`` aggregate then sees one weighted row per distinct value, so its state is
    bounded by the largest daily unit count, not by the group.
    """
    qs = sorted(quantiles)
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    picked = counted.groupBy(*keys).agg(
        F.percentile(
            F.col(value).cast("double"), F.array(*[F.lit(float(q)) for q in qs]), F.col("_c")
        ).alias("_q")
    )
    return picked.select(
        *keys, *[F.col("_q")[i].alias(name) for i, name in enumerate(q_names(qs))]
    )


def monotone(df: DataFrame, quantiles, columns: list[str] | None = None) -> DataFrame:
    """Clip the quantile columns at zero, then order them within each row."""
    names = columns or q_names(quantiles)
    ordered = F.array_sort(F.array(*[F.greatest(F.col(c), F.lit(0.0)) for c in names]))
    keep = [c for c in df.columns if c not in names]
    return df.withColumn("_ordered", ordered).select(
        *keep, *[F.col("_ordered")[i].alias(c) for i, c in enumerate(names)]
    )
