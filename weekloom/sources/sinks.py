"""Parquet and JSON sinks of the layer tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weekloom.schemas import RUN_METADATA


def write_table(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, *columns: str) -> str:
    """One folder per partition value, so that a read for one value touches only its files.

    Dynamic overwrite replaces only the partitions present in ``df``. Rows stay in the tasks
    that hold them: no repartition by the few-valued columns, which would make one hot task.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )
    return path


def write_refined(panel: DataFrame, path: str) -> str:
    """Refined panel, one folder per demand type."""
    return write_partitioned(panel, path, "demand_type")


def read_refined(spark: SparkSession, path: str, demand_type: str | None = None) -> DataFrame:
    """All demand types as one panel, or one of them by partition pruning."""
    df = spark.read.parquet(path)
    return df if demand_type is None else df.where(F.col("demand_type") == demand_type)


def write_dated(df: DataFrame, path: str) -> str:
    """Backtest and forecast tables: one folder per reference and run date."""
    return write_partitioned(df, path, "ref_date", "run_date")


def write_metadata(runs: DataFrame, path: str) -> str:
    """Run metadata as JSON lines (one small row per demand type)."""
    runs.write.mode("overwrite").json(path)
    return path


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Run metadata written by ``write_metadata``; an empty table if the folder does not exist."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        return spark.createDataFrame([], RUN_METADATA)
    return spark.read.schema(RUN_METADATA).json(path)
