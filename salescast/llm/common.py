"""Helpers shared by the operators: column picking, stages, word shingles, components."""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salescast.session import scratch_path

DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Bytes of text that a task turns into numpy arrays at once (a longer text is taken alone).
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let_workers_import(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it, unless they were told another place."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH", ""), root]))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns by exact name; extra columns, also ones that differ in case only, are left out."""
    let_workers_import(df.sparkSession)
    have = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(have))])
    return plain.select(*[F.col(f"c{have.index(n)}").alias(n) for n in names])


def stage(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(spark: SparkSession, *paths_of: DataFrame) -> None:
    """Delete tables that :func:`stage` has written, once nothing that is still to run reads them."""
    for df in paths_of:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def partitions_for(spark: SparkSession, items: int, per_task: int) -> int:
    """Tasks for ``items`` so that none holds more than about ``per_task``."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-items // per_task))


def first_of_each(df: DataFrame, key: str, names: list[str], n: int, slices: int = 64) -> DataFrame:
    """The first ``n`` rows of each ``key`` by hash of the columns ``names``, then by these.

    Rows are ranked in slices of each key first, so that no task sorts more than a slice or slices * n rows.
    """
    hashed = F.xxhash64(*names)
    for parts in ([key, F.pmod(hashed, F.lit(slices))], [key]):
        rank = F.row_number().over(Window.partitionBy(*parts).orderBy(hashed, *names))
        df = df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
    return df


def mod_crc(doc_id: str, m: int):
    """crc32 of the id as text, modulo ``m``; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % m


# -- bytes of an Arrow batch ----------------------------------------------------------------

def slices(texts: pa.Array, limit: int = SLICE_BYTES):
    """(first row, bytes, offsets) of runs of rows with about ``limit`` bytes; null texts are empty."""
    flat = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    data = np.frombuffer(flat.buffers()[2], np.uint8) if flat.buffers()[2] is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(flat):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(flat))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x5851F42D4C957F2D)
_INV = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse modulo 2**64."""
    if len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES + 64)
        for key, base in (("up", _BASE), ("down", _INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all bits."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of byte * base**position, one more than bytes: a substring's hash is a difference."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=out[1:])
    return out


#: Fixed value: the white space that parts words.
SPACES = [0x20, *range(0x09, 0x0E)]
_WORD = np.ones(256, bool)
_WORD[SPACES] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = _WORD):
    """(document row, hash) of each word, in order. ``data`` is lower-cased by the caller."""
    ok = inside[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    start = ok.copy()
    start[1:] &= ~ok[:-1] | first[1:-1]
    stop = ok.copy()
    stop[:-1] &= ~ok[1:] | first[1:-1]
    s, e = np.flatnonzero(start), np.flatnonzero(stop) + 1
    # Each byte at its place in the word gives a mixed number; a word is their sum. A polynomial modulo 2**64 would
    # give some pairs of long words one hash whatever its base.
    place = np.arange(len(data)) - np.repeat(np.append(0, s), np.diff(np.append(np.append(0, s), len(data))))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(mix(_BYTE[data] + place.astype(np.uint64) * _BASE), out=sums[1:])
    return np.searchsorted(offsets, s, "right") - 1, mix(sums[e] - sums[s] + (e - s).astype(np.uint64))


def shingle_hashes(doc: np.ndarray, words: np.ndarray, k: int):
    """(document row, hash, first word) of each run of ``k`` words of a document."""
    n = len(words) - k + 1
    if n <= 0:
        return doc[:0], words[:0], doc[:0]
    at = np.flatnonzero(doc[:n] == doc[k - 1 :])
    h = np.full(len(at), k * 0x9E3779B97F4A7C15 % (1 << 64), np.uint64)
    for i in range(k):
        h += words[at + i] * _STEP[i]
    return doc[at], mix(h), at


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = 5):
    """(document row, hash) of all ``k``-word shingles; a text of fewer words is one shingle."""
    doc, words = word_hashes(lower_ascii(data), offsets)
    d, h, _ = shingle_hashes(doc, words, k)
    count = np.bincount(doc, minlength=len(offsets) - 1)
    for short in range(1, k):
        if (count == short).any():
            d2, h2, _ = shingle_hashes(doc, words, short)
            own = count[d2] == short
            d, h = np.concatenate([d, d2[own]]), np.concatenate([h, h2[own]])
    return d, h


def distinct_in_rows(d: np.ndarray, h: np.ndarray):
    """Distinct (row, hash) pairs, sorted by row, then hash."""
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    return d[new], h[new]


# -- connected components -----------------------------------------------------------------

def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node reachable.

    Alternates large-star and small-star steps; each is a partial aggregate and a join, so a node
    with very many links is combined before the shuffle and split by the adaptive skew join.
    Rounds are written, so that lost executors repeat one round at most.
    """
    now = stage(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-edges")
    mark = None
    while True:
        both = now.union(now.select(F.col("b"), F.col("a"))).toDF("a", "b")
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(low, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        now = stage(small.where("a <> b").distinct(), f"{name}-edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component")))
