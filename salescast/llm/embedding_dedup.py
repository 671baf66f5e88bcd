"""Embedding near-duplicates by a pivot-permutation index.

Reference points (pivots) are vectors taken from the table by hash of the id, about as many as the
square root of the rows. Every vector is described by its ``NEAREST`` pivots in order of closeness and
put into the inverted list of each. Two vectors of a list are candidates if they share at least
``SHARED`` of those pivots; candidates are verified by cosine in double precision. A pair met in several
lists counts in the list of the smallest pivot it shares, so links are summed without writing pairs, and
a list hands on a spanning forest of its links only.

Lists are kept per label and dimension. A list of more than ``BLOCK`` vectors is cut into blocks, and
every two blocks meet in a task of their own, so no task holds more than 2 * BLOCK vectors. Equal
vectors of a label are one entry with a weight. Measured recall against brute force is in the tests.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and vectors
with a null label, link with nothing; vectors of different dimensions never link; rows that repeat a
vec_id count once, with the least (label, vector); an empty table gives an empty result; extra columns
are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.common import components, pick, stage, table

NEAREST, SHARED = 8, 2
COSINE = 0.98
BLOCK = 2048
#: Pivots: the power of two above the square root of the rows, within these bounds.
PIVOTS = (32, 1024)
KEY = ["label", "dim", "pivot", "lo", "hi"]


def valid():
    """Whether a vector can have links."""
    e = F.col("embedding")
    return (
        F.col("label").isNotNull() & e.isNotNull() & (F.size(e) > 0)
        & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0))


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors / np.abs(vectors).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def pivots_of(sample: list[list[float]], many: int) -> dict[int, np.ndarray]:
    """Unit pivots by dimension."""
    by: dict[int, list] = {}
    for v in sample:
        by.setdefault(len(v), []).append(v)
    return {d: unit(np.array(vs, float))[:many] for d, vs in by.items()}


def padded(pivots: dict[int, np.ndarray], dim: int) -> np.ndarray:
    """The pivots of one dimension; seeded random ones fill up to ``NEAREST``."""
    own = pivots.get(dim, np.zeros((0, dim)))
    more = NEAREST - len(own)
    if more <= 0:
        return own
    return np.concatenate([own, unit(np.random.default_rng(dim).normal(size=(more, dim)))])


def _describe(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(2)
            dims = np.diff(np.asarray(values.offsets))
            flat = np.asarray(values.flatten(), float)
            start = np.cumsum(dims) - dims
            out: list = [None] * len(dims)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                pivots = padded(shared.value, int(dim))
                for few in np.array_split(at, -(-len(at) // 1024)):
                    v = unit(flat[start[few][:, None] + np.arange(dim)])
                    order = np.argsort(-(v @ pivots.T), axis=1, kind="stable")[:, :NEAREST]
                    for i, row in zip(few, order.astype(np.int32)):
                        out[i] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), values, batch.column(3), pa.array(out, pa.list_(pa.int32()))],
                ["id", "label", "embedding", "weight", "near"])

    return run


def links_of(v: np.ndarray, near: np.ndarray, pivot: int, cosine: float) -> np.ndarray:
    """Boolean matrix of verified links that belong to the list of ``pivot``."""
    have = np.zeros((len(v), int(near.max()) + 1), np.float32)
    np.put_along_axis(have, near, 1.0, axis=1)
    lower = have[:, :pivot]
    out = np.zeros((len(v), len(v)), bool)
    for a in range(0, len(v), 512):
        b = slice(a, a + 512)
        out[b] = (have[b] @ have.T >= SHARED) & (lower[b] @ lower.T == 0) & (v[b] @ v.T >= cosine)
    np.fill_diagonal(out, False)
    return out


def _meet(cosine: float):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, _, pivot, lo, hi = key
        pdf = pdf.sort_values("id", kind="stable")
        ids, weight = pdf["id"].to_numpy(), pdf["weight"].to_numpy()
        link = links_of(unit(np.array(pdf["embedding"].tolist(), float)), np.array(pdf["near"].tolist(), np.int64), int(pivot), cosine)
        if lo != hi:
            side = pdf["block"].to_numpy()
            link &= side[:, None] != side[None, :]
        n = link @ weight
        root = np.arange(len(ids))
        while True:
            low = np.minimum(root, np.where(link, root[None, :], len(ids)).min(1))
            low = low[low]
            if (low == root).all():
                break
            root = low
        some = n > 0
        return pd.DataFrame({"id": ids[some], "n": n[some], "root": ids[root][some]})

    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per vec_id."""
    spark = vectors.sparkSession
    rows = pick(vectors, "vec_id", "embedding", "label").groupBy("vec_id").agg(
        F.min(F.struct("label", "embedding")).alias("v")).select("vec_id", "v.label", "v.embedding")
    rows = stage(rows, "vectors")
    good = rows.where(valid() & F.col("vec_id").isNotNull())
    same = stage(good.groupBy("label", "embedding").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("weight")).select("id", "label", "embedding", "weight"), "vector-groups")
    many = 2 ** math.ceil(math.log2(max(1, math.sqrt(same.count()))))
    many = min(max(many, PIVOTS[0]), PIVOTS[1])
    sample = [r.embedding for r in same.orderBy(F.xxhash64("id"), "id").limit(many).select("embedding").collect()]
    shared = spark.sparkContext.broadcast(pivots_of(sample, many))
    kinds = dict(same.dtypes)
    described = stage(same.mapInArrow(_describe(shared), (
        f"id long, label {kinds['label']}, embedding {kinds['embedding']}, weight long, near array<int>")), "vector-index")
    entries = described.withColumn("dim", F.size("embedding")).withColumn("pivot", F.explode("near"))
    lists = entries.groupBy("label", "dim", "pivot").count().where("count > 1").select(
        "label", "dim", "pivot", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    entries = entries.join(lists, ["label", "dim", "pivot"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # An entry of block i meets all blocks; the pair (lo, hi) names the task.
    entries = entries.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
        {"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    met = stage(entries.select(*KEY, "id", "weight", "block", "near", "embedding").groupBy(*KEY).applyInPandas(
        _meet(cosine), "id long, n long, root long"), "vector-links")
    counts = met.groupBy("id").agg(F.sum("n").alias("n"))
    found = components(met.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")), "vector")
    per_group = same.join(counts, "id", "left").join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "label", "embedding", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    linked = good.join(per_group, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(valid(), F.lit(False)) | F.col("vec_id").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op1_embedding_dedup(spark, sf_dir) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
