"""Model registry as an append-only log of events: newest version, promotion, rollback, traffic split.

The state of the registry is the fold of its events. A command reads the state, decides, and commits one
event under the next number; where another command has taken that number it fails with
:class:`~salescast.session.Conflict` and nothing is changed.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salescast.session import create_once, path_exists

# Approval states.
APPROVED = "Approved"
PENDING = "PendingManualApproval"
REJECTED = "Rejected"

REGISTER_WAPE = 0.75


def versions(registry: DataFrame) -> DataFrame:
    """All versions, newest first."""
    return registry.orderBy(F.desc("created"), F.desc("version"))


def newest_by_status(registry: DataFrame) -> DataFrame:
    """The newest version of every approval status with its WAPE."""
    row = F.struct("created", "version", "wape")
    return registry.groupBy("status").agg(F.max_by(row, F.struct("created", "version")).alias("_r")).select(
        "status", "_r.version", "_r.created", "_r.wape"
    )


def promote_decision(registry: DataFrame, register_line: float = REGISTER_WAPE) -> DataFrame:
    """Incumbent (newest approved) against candidate (newest pending), in one row.

    ``registrable`` is the gate of the training pipeline: backtest WAPE at or under the line.
    """
    def newest(status: str, field: str):
        hit = F.col("status") == status
        return F.max_by(field, F.when(hit, F.struct("created", "version")))

    pair = registry.agg(
        newest(APPROVED, "version").alias("incumbent"),
        newest(APPROVED, "wape").alias("incumbent_wape"),
        newest(PENDING, "version").alias("candidate"),
        newest(PENDING, "wape").alias("candidate_wape"),
    )
    wins = (
        F.when(F.col("candidate").isNull(), F.lit(False))
        .when(F.col("incumbent_wape").isNull(), F.lit(True))
        .when(F.col("candidate_wape").isNull(), F.lit(False))
        .otherwise(F.col("candidate_wape") <= F.col("incumbent_wape"))
    )
    return pair.withColumn("promote", wins).withColumn(
        "registrable", F.coalesce(F.col("candidate_wape") <= register_line, F.lit(False))
    )


def with_status(registry: DataFrame, version: int, status: str) -> DataFrame:
    """The registry with one version's status changed."""
    return registry.withColumn(
        "status", F.when(F.col("version") == version, F.lit(status)).otherwise(F.col("status"))
    )


def rolled_back(registry: DataFrame) -> DataFrame:
    """Reject the newest approved version, so the one before it is in production again."""
    rank = F.row_number().over(Window.partitionBy("status").orderBy(F.desc("created"), F.desc("version")))
    ranked = registry.withColumn("_rank", rank)
    top = (F.col("status") == APPROVED) & (F.col("_rank") == 1)
    return ranked.withColumn("status", F.when(top, F.lit(REJECTED)).otherwise(F.col("status"))).drop("_rank")


# -- the log ----------------------------------------------------------------------------------

EVENTS = "seq long, event string, version int, created long, status string, wape double, reason string"
REGISTERED, MOVED = "registered", "moved"


def events(spark: SparkSession, path: str) -> DataFrame:
    """All committed events; an absent log is an empty one."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], EVENTS)
    return spark.read.schema(EVENTS).json(path)


def state(log: DataFrame) -> DataFrame:
    """(version, created, status, wape) of every version: its registration, and the status of its last event."""
    born = F.col("event") == REGISTERED
    return log.groupBy("version").agg(
        F.max(F.when(born, F.col("created"))).alias("created"), F.max_by("status", "seq").alias("status"),
        F.max(F.when(born, F.col("wape"))).alias("wape"),
    )


def last_seq(log: DataFrame) -> int:
    return log.agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]


def commit(spark: SparkSession, path: str, seen: int, **event) -> int:
    """Append one event on top of the ``seen`` ones; returns its number."""
    seq = seen + 1
    create_once(spark, f"{path}/{seq:012d}.json", json.dumps({"seq": seq, **event}) + "\n")
    return seq


def register(spark: SparkSession, path: str, created: int, wape: float | None, line: float | None = REGISTER_WAPE) -> int | None:
    """A new pending version, if its backtest WAPE is at or under ``line`` (no gate when None); its number or None."""
    if line is not None and (wape is None or wape > line):
        return None
    log = events(spark, path)
    version = (log.agg(F.max("version")).first()[0] or 0) + 1
    commit(spark, path, last_seq(log), event=REGISTERED, version=version, created=created, status=PENDING, wape=wape)
    return version


def set_status(spark: SparkSession, path: str, version: int, status: str, reason: str = "", seen: int | None = None) -> int:
    """Move one version to a status. ``seen`` is the log the caller has decided on (the newest when None)."""
    log = events(spark, path)
    if log.where(F.col("version") == version).isEmpty():
        raise ValueError(f"version {version} is not registered")
    return commit(spark, path, last_seq(log) if seen is None else seen, event=MOVED, version=version, status=status, reason=reason)


def promote(spark: SparkSession, path: str) -> bool | None:
    """Approve the newest pending version if the rule lets it replace the incumbent, else reject it; None without one."""
    log = events(spark, path)
    seen, row = last_seq(log), promote_decision(state(log)).first()
    if row["candidate"] is None:
        return None
    set_status(spark, path, row["candidate"], APPROVED if row["promote"] else REJECTED, "promotion", seen)
    return row["promote"]


def roll_back(spark: SparkSession, path: str) -> int | None:
    """Reject the newest approved version, so the one before it is in production again; that one or None."""
    log = events(spark, path)
    seen = last_seq(log)
    approved = versions(state(log).where(F.col("status") == APPROVED)).limit(2).collect()
    if not approved:
        return None
    set_status(spark, path, approved[0]["version"], REJECTED, "rollback", seen)
    return approved[1]["version"] if len(approved) > 1 else None


# -- traffic ----------------------------------------------------------------------------------

def traffic_bucket(id_col: str = "id"):
    """0..99 from the first eight hex digits of the id's md5."""
    return (F.conv(F.substring(F.md5(id_col), 1, 8), 16, 10).cast("long") % 100).cast("int")


def ab_split(champion: DataFrame, challenger: DataFrame, percent: int) -> DataFrame:
    """Serve ``percent`` of the series from the challenger, by a stable hash of the id."""
    own = champion.where(traffic_bucket() >= percent).withColumn("variant", F.lit("champion"))
    new = challenger.where(traffic_bucket() < percent).withColumn("variant", F.lit("challenger"))
    return own.unionByName(new)


def shadow(champion: DataFrame, challenger: DataFrame) -> DataFrame:
    """Both models score every series; only the champion's rows are served."""
    return champion.withColumns({"variant": F.lit("champion"), "served": F.lit(True)}).unionByName(
        challenger.withColumns({"variant": F.lit("challenger"), "served": F.lit(False)})
    )
