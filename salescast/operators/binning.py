"""Model inputs as small integers: one byte per input and row.

How a column is read is declared, never measured: numbers are cut at quantiles, columns of
``CATEGORY_COLS`` keep one code per value, and a column of ``MEAN_COLS`` (items, whose values grow with the
catalogue) becomes a number, the mean units of its value over the training targets that were known at
the row's origin. A NULL, an unseen value and an unknown mean take code 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from salescast.functions.joins import salted_join
from salescast.schema import CATEGORICAL_COLS, MODEL_COLS
from salescast.session import checkpointed

MEAN_COLS = ["item_id"]
CATEGORY_COLS = [c for c in CATEGORICAL_COLS if c not in MEAN_COLS]
#: A code is one byte, and 0 is taken.
MOST_CODES = 255
ACCURACY = 10_000
MEANS_SCHEMA = "column string, value string, days array<int>, units array<double>, rows array<long>"


def mean_inputs(table: DataFrame) -> DataFrame:
    """Running sums of units per value of each mean column, by target day (``MEANS_SCHEMA``).

    The arrays hold at most one entry per training day.
    """
    values = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in MEAN_COLS])
    by_day = (
        table.select("target_day", F.col("sales").cast("double").alias("y"), F.inline(values))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value", "target_day")
        .agg(F.sum("y").alias("units"), F.count(F.lit(1)).alias("n"))
    )
    listed = by_day.groupBy("column", "value").agg(
        F.sort_array(F.collect_list(F.struct("target_day", "units", "n"))).alias("x")
    )
    start = F.struct(
        F.array().cast("array<int>").alias("days"), F.array().cast("array<double>").alias("units"),
        F.array().cast("array<bigint>").alias("rows"), F.lit(0.0).alias("u"), F.lit(0).cast("bigint").alias("n"),
    )
    run = F.aggregate("x", start, lambda s, x: F.struct(
        F.array_append(s["days"], x["target_day"]).alias("days"),
        F.array_append(s["units"], s["u"] + x["units"]).alias("units"),
        F.array_append(s["rows"], s["n"] + x["n"]).alias("rows"),
        (s["u"] + x["units"]).alias("u"), (s["n"] + x["n"]).alias("n"),
    ))
    return listed.select("column", "value", run.alias("r")).select("column", "value", "r.days", "r.units", "r.rows")


@dataclass
class Binner:
    """Cuts of the numbers, values of the categories, running means of the wide columns."""

    edges: dict[str, list[float]]
    categories: dict[str, list[str]]
    means: DataFrame

    @classmethod
    def fit(cls, table: DataFrame, bins: int, shape: Column | None = None) -> "Binner":
        """Cuts and values come from the rows where ``shape`` holds, means from all rows, each from its past."""
        rows = table.where(shape) if shape is not None else table
        pairs = F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in CATEGORY_COLS
        ])
        values = checkpointed(rows.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct())
        for r in values.groupBy("column").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MOST_CODES).collect():
            raise ValueError(f"{r['column']} has {r['n']} values: declare it in MEAN_COLS")
        categories: dict[str, list[str]] = {c: [] for c in CATEGORY_COLS}
        for r in values.collect():  # at most MOST_CODES per column
            categories[r["column"]].append(r["value"])
        means = checkpointed(mean_inputs(table))
        made = cls({}, {c: sorted(v) for c, v in categories.items()}, means)
        probs = F.array(*[F.lit(i / bins) for i in range(1, bins)])
        numbers = {c: e for c, e in made.inputs_of(rows) if c not in CATEGORY_COLS}
        cut = made.with_means(rows).agg(*[F.percentile_approx(e, probs, ACCURACY).alias(c) for c, e in numbers.items()]).first()
        made.edges = {c: sorted(set(cut[c] or [])) for c in numbers}
        return made

    @property
    def names(self) -> list[str]:
        return list(MODEL_COLS)

    @property
    def width(self) -> int:
        """Codes of the widest input."""
        return max([2, *[len(e) + 2 for e in self.edges.values()], *[len(v) + 1 for v in self.categories.values()]])

    def is_category(self) -> np.ndarray:
        return np.array([c in self.categories for c in self.names])

    def with_means(self, rows: DataFrame) -> DataFrame:
        """Rows with the as-of mean of each mean column, ``_m_<column>``."""
        for c in MEAN_COLS:
            lookup = self.means.where(F.col("column") == c).select(
                F.col("value").alias(c), F.col("days").alias("_d"), F.col("units").alias("_u"), F.col("rows").alias("_n")
            )
            known = F.size(F.filter("_d", lambda d: d <= F.col("origin")))
            mean = F.when(known > 0, F.element_at("_u", known) / F.element_at("_n", known))
            rows = salted_join(rows, lookup, [c], [F.col("id"), F.col("target_day")])
            rows = rows.withColumn(f"_m_{c}", mean).drop("_d", "_u", "_n")
        return rows

    def inputs_of(self, rows: DataFrame) -> list[tuple[str, Column]]:
        """Each input's name and its column in :meth:`with_means`."""
        out = []
        for c in self.names:
            if c in MEAN_COLS:
                out.append((c, F.col(f"_m_{c}")))
            else:
                out.append((c, F.col(c).cast("string" if c in CATEGORY_COLS else "double")))
        return out

    def codes(self, arrays: list[pa.Array]) -> np.ndarray:
        """(rows, inputs) codes of the input columns."""
        out = np.zeros((len(arrays[0]), len(self.names)), np.uint8)
        for i, (c, array) in enumerate(zip(self.names, arrays)):
            if c in self.categories:
                at = pc.index_in(array, value_set=pa.array(self.categories[c], pa.string()))
                out[:, i] = pc.fill_null(at, -1).to_numpy(zero_copy_only=False) + 1
            else:
                v = pc.fill_null(array, np.nan).to_numpy(zero_copy_only=False)
                out[:, i] = np.where(np.isnan(v), 0, np.searchsorted(np.array(self.edges[c]), v, "right") + 1)
        return out

    def frozen(self) -> "Binner":
        """Without the table of means: what a worker needs."""
        return Binner(self.edges, self.categories, None)


def packed(codes: np.ndarray) -> pa.Array:
    """Each row of a two-dimensional array as one binary value."""
    n, data = len(codes), np.ascontiguousarray(codes)
    size = data.shape[1] * data.itemsize
    offsets = np.arange(n + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def unpacked(values: pa.Array, dtype) -> np.ndarray:
    """Rows of equal size from binary values."""
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view(dtype).reshape(len(values), -1)


def binned(rows: DataFrame, binner: Binner) -> DataFrame:
    """Rows with their codes as one binary column, ``bins``."""
    small = binner.frozen()

    @arrow_udf("binary")
    def codes(*arrays: pa.Array) -> pa.Array:
        return packed(small.codes(list(arrays)))

    out = binner.with_means(rows)
    return out.withColumn("bins", codes(*[e for _, e in binner.inputs_of(out)]))
