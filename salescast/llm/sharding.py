"""Sharding by Karmarkar-Karp differencing: indivisible groups of equal texts, near equal bytes.

Groups are dealt by hash into buckets of about ``FAN`` groups. In each bucket the two partial
partitions with the largest spread are combined again and again, the heavy end of one on the light
end of the other, until one is left.

A bucket can only even out groups that are small beside its own share of a shard, so groups are taken in
classes of size, the largest class (one bucket) first. What the shards hold so far enters every bucket of
the next class as one more partial partition, divided by the number of buckets: each bucket fills its
part of the gaps, and the place of that partition names its shards. A class has a fraction of the groups
of the one below, so there are few; no task and not the driver ever holds more than a bucket.

Defined results: a null text counts as empty (size 8, crc32 0) and forms one group with empty
texts; repeated rows each take a slot; an empty table gives an empty result; extra columns are left
out. A group larger than total / n_shards stays whole, and the other groups even out around it.
"""

from __future__ import annotations

import heapq
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast.llm.common import partitions_for, pick, stage, table

N_SHARDS = 24
FAN = 1024
#: Groups of a class are at most this part of a bucket's bytes for one shard.
SMALL = 0.5
#: Rows of a shard and slot range that one task numbers.
SLOT_ROWS = 50_000


def difference(sums: list[list[int]]) -> list[list[int]]:
    """Place of each part of each partial partition in the combined one.

    ``sums[i]`` has k part sums; the answer's row i maps its part to a part of the whole.
    """
    k = len(sums[0])
    left: list[tuple] = [()] * len(sums)
    heap = []
    for i, s in enumerate(sums):
        order = sorted(range(k), key=s.__getitem__)
        vals = [s[j] for j in order]
        left[i] = (order,)
        heap.append((vals[0] - vals[-1], i, vals))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)
        _, b, y = heapq.heappop(heap)
        z = [p + q for p, q in zip(x, reversed(y))]
        order = sorted(range(k), key=z.__getitem__)
        vals = [z[j] for j in order]
        left.append((order, a, b))
        heapq.heappush(heap, (vals[0] - vals[-1], len(left) - 1, vals))
    where: list = [None] * len(left)
    where[heap[0][1]] = list(range(k))
    for node in range(len(left) - 1, -1, -1):
        order, *kids = left[node]
        spot = [0] * k
        for rank, j in enumerate(order):
            spot[j] = where[node][rank]
        where[node] = None
        if kids:
            where[kids[0]], where[kids[1]] = spot, spot[::-1]
        else:
            where[node] = spot
    return where[: len(sums)]


def _deal(k: int, held: list[int]):
    """Shards of a bucket's groups, beside which the shards hold ``held``."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("blob", kind="stable")
        places = difference([[int(v)] + [0] * (k - 1) for v in pdf["bytes"]] + [held])
        name = {place: i for i, place in enumerate(places[-1])}
        return pd.DataFrame({"blob": pdf["blob"], "bytes": pdf["bytes"], "shard": [name[p[0]] for p in places[:-1]]})

    return run


def size_classes(groups: DataFrame, n_shards: int) -> list[tuple[int, int]]:
    """(least bytes, groups) of each class, the smallest groups first."""
    out, low = [], 0
    n, total = groups.agg(F.count("*"), F.sum("bytes")).first()
    while n > FAN:
        high = int(SMALL * total * FAN / (n * n_shards)) + 1
        above, total_above = groups.where(F.col("bytes") >= high).agg(F.count("*"), F.sum("bytes")).first()
        out.append((low, n - above))
        low, n, total = high, above, total_above
    return [*out, (low, n)] if n else out


def group_shards(groups: DataFrame, n_shards: int) -> DataFrame:
    """(blob, shard) of groups (blob, bytes)."""
    held, done, high = [0] * n_shards, [], None
    for low, n in reversed(size_classes(groups, n_shards)):
        own = groups.where(F.col("bytes") >= low)
        own = own if high is None else own.where(F.col("bytes") < high)
        buckets = max(1, -(-n // FAN))
        dealt = own.withColumn("bucket", F.pmod(F.xxhash64("blob"), F.lit(buckets))).groupBy("bucket").applyInPandas(
            _deal(n_shards, [v // buckets for v in held]), "blob binary, bytes long, shard int")
        done.append(stage(dealt, "shard-class"))
        for r in done[-1].groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect():  # one row per shard
            held[r["shard"]] += r["bytes"]
        high = low
    return reduce(DataFrame.union, [d.select("blob", "shard") for d in done])


def shard(docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs``."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = pick(docs, "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("blob"))
    rows = stage(rows, "shard-rows")
    groups = stage(rows.groupBy("blob").agg(F.sum("size").alias("bytes")), "shard-groups")
    if groups.isEmpty():
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    at = group_shards(groups, n_shards)
    placed = stage(rows.join(at, "blob").select("doc_id", "size", "text_crc32", "shard"), "shard-placed")
    parts = partitions_for(spark, placed.count(), SLOT_ROWS)
    placed = placed.withColumn("range", F.pmod(F.xxhash64("doc_id"), F.lit(parts)))
    before = placed.groupBy("shard", "range").count().withColumn(
        "base", F.sum("count").over(Window.partitionBy("shard").orderBy("range")) - F.col("count")).drop("count")
    own = Window.partitionBy("shard", "range").orderBy("doc_id", "text_crc32", "size")
    return placed.withColumn("nth", F.row_number().over(own)).join(before, ["shard", "range"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("nth") - 1).alias("slot"))


def op10_sharding(spark, sf_dir) -> DataFrame:
    out = shard(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
