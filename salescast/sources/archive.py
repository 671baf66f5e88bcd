"""Prediction archive: partitioned by run date, one batch per date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salescast.operators.forecast import gate_columns, refuse_bad
from salescast.schema import q_export_name, q_name
from salescast.session import scratch_path


def write_archive(
    forecasts: DataFrame, path: str, run_date: str, model_name: str, model_version: str, quantiles
) -> None:
    """Check a batch and store it; a batch already stored for that date is replaced.

    The forecasts are computed once, into a scratch table, and counted on the way. Only a good
    batch moves to the archive. Dynamic partition overwrite touches only this run date.
    """
    spark = forecasts.sparkSession
    counted = Observation()
    draft = scratch_path(spark, "batch")
    forecasts.observe(counted, *gate_columns(quantiles)).write.parquet(draft)
    refuse_bad(counted.get)
    batch = spark.read.parquet(draft).withColumns({
        "run_date": F.lit(run_date),
        "model_name": F.lit(model_name),
        "model_version": F.lit(model_version),
    })
    (
        batch.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date")
        .parquet(path)
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """All batches; the run date is read back as a string (it is a partition name)."""
    return spark.read.parquet(path).withColumn("run_date", F.col("run_date").cast("string"))


def run_dates(spark: SparkSession, path: str) -> list[str]:
    """Partition names on storage, ascending. Lists one folder and reads no data."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith("run_date="))


def latest_archive(spark: SparkSession, path: str) -> DataFrame:
    """The newest batch; the literal run date prunes all other partitions."""
    dates = run_dates(spark, path)
    if not dates:
        raise FileNotFoundError(f"no prediction archive under {path}")
    return spark.read.parquet(path).where(F.col("run_date") == F.lit(dates[-1])).withColumn(
        "run_date", F.col("run_date").cast("string")
    )


def export_names(forecasts: DataFrame, quantiles) -> DataFrame:
    """Quantile columns under their dotted export names."""
    return forecasts.withColumnsRenamed({q_name(q): q_export_name(q) for q in quantiles})
