"""Runs of several tables that become visible together.

The tables of a run are written under its own folder; a manifest, created last and at once, names
them. Readers go by the manifest, so a run that broke off is never seen, and a run is written once.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.session import create_once, path_exists

MANIFEST = "run string, name string, path string, rows long, schema string"


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """One row per table of every committed run."""
    if not path_exists(spark, f"{root}/_runs"):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(f"{root}/_runs")


def write_run(spark: SparkSession, root: str, run: str, tables: dict[str, DataFrame]) -> None:
    """Write small result tables and commit them as one run; a committed run is refused."""
    if path_exists(spark, f"{root}/_runs/{run}.json"):
        raise ValueError(f"run {run} is committed already")
    lines = []
    for name, table in tables.items():
        path = f"{root}/{run}/{name}"
        table.coalesce(1).write.mode("overwrite").parquet(path)
        rows = spark.read.parquet(path).count()
        lines.append(json.dumps({"run": run, "name": name, "path": path, "rows": rows, "schema": table.schema.simpleString()}))
    create_once(spark, f"{root}/_runs/{run}.json", "\n".join(lines) + "\n")


def read_run(spark: SparkSession, root: str, run: str | None = None) -> dict[str, DataFrame]:
    """The tables of a run (the newest by name when None); a table that lost rows is refused."""
    listed = manifests(spark, root)
    if run is None:
        run = listed.agg(F.max("run")).first()[0]
    found = listed.where(F.col("run") == run).collect() if run is not None else []  # one row per table
    if not found:
        raise FileNotFoundError(f"no committed run {run or ''} under {root}")
    out = {r["name"]: spark.read.parquet(r["path"]) for r in found}
    for r in found:
        if out[r["name"]].count() != r["rows"]:
            raise ValueError(f"{r['path']} does not hold the {r['rows']} rows of its manifest")
    return out
