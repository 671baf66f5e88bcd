"""Scratch storage: written tables that cut lineage and survive executor loss."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from hashlib import md5
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_own_base: dict[str, str] = {}
_staged: dict[tuple[str, str], str] = {}


def scratch_base(spark: SparkSession) -> str:
    """Shared folder of this application.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset (a local
    test session) a temporary folder is made.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app not in _own_base:
        base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="spark-")
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(base)
        _own_base[app] = f"{base.rstrip('/')}/salescast-{app}"
    return _own_base[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path that no other run uses."""
    return f"{scratch_base(spark)}/{name}-{uuid4().hex[:12]}"


def deal_by_key_subset(spark: SparkSession) -> None:
    """Let a join keep an exchange by a part of its keys in this session, instead of dealing by all of them anew."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of an iterative frame."""
    scratch_base(df.sparkSession)
    return df.checkpoint()


class Conflict(RuntimeError):
    """Another writer has committed first."""


def create_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file; raises :class:`Conflict` where it exists already.

    The file system decides which of two writers comes first (HDFS and local folders do; an object store
    without conditional writes does not).
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = fs.create(target, False)
    except Py4JJavaError as e:
        if fs.exists(target):
            raise Conflict(f"{path} exists") from e
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def inputs_fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Length and modification time of the inputs, so that changed files are read anew."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    marks = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        status = fs.getFileStatus(p)
        size = fs.getContentSummary(p).getLength()
        marks.append(f"{path}:{status.getModificationTime()}:{size}")
    return "|".join(marks)


def written_once(spark: SparkSession, key: str, write: Callable[[str], None]) -> str:
    """Path that ``write`` has filled, once per application and key."""
    slot = (spark.sparkContext.applicationId, key)
    if slot not in _staged:
        path = scratch_path(spark, "table")
        write(path)
        _staged[slot] = path
    return _staged[slot]


def staged(spark: SparkSession, key: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Write ``build()`` once per application and key as Parquet, then read it back.

    Downstream jobs get column pruning, pushed filters and no recomputation.
    """
    path = written_once(spark, key, lambda p: build().write.mode("overwrite").parquet(p))
    return spark.read.parquet(path)


def staged_by_key(spark: SparkSession, key: str, build: Callable[[], DataFrame], by: str, sort: str) -> DataFrame:
    """As :func:`staged`, bucketed by ``by``: later joins, aggregates and windows on that key
    read it without an exchange.

    One bucket per shuffle partition, the same hash: a frame that is already partitioned by
    the key is written as it lies, one file per bucket. The table is registered in the
    session's own catalog; with an external metastore plain Parquet is written instead.
    """
    if spark.conf.get("spark.sql.catalogImplementation") != "in-memory":
        return staged(spark, key, build)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = "salescast_" + md5(key.encode()).hexdigest()

    def write(path: str) -> None:
        (
            build().write.format("parquet").mode("overwrite").option("path", path)
            .bucketBy(buckets, by).sortBy(by, sort).saveAsTable(name)
        )

    written_once(spark, key, write)
    return spark.table(name)
