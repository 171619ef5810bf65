"""File sinks, per-batch output and audit rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    files: int | None = None,
) -> None:
    """Parquet, as many files as the plan has tasks unless `files` says otherwise."""
    _writer(df, mode, partition_by, files).parquet(path)


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    files: int | None = None,
) -> None:
    """CSV with header."""
    _writer(df, mode, partition_by, files).option("header", True).csv(path)


def _writer(df: DataFrame, mode: str, partition_by: Sequence[str], files: int | None):
    writer = (df.repartition(files) if files else df).write.mode(mode)
    return writer.partitionBy(*partition_by) if partition_by else writer


def batch_path(root: str, batch_id: int) -> str:
    return f"{root}/batch_id={batch_id}"


def write_batch_csv(df: DataFrame, batch_id: int, root: str) -> str:
    """One folder per micro-batch; a replayed batch overwrites its own folder."""
    write_csv(df, batch_path(root, batch_id))
    return "csv"


def write_batch_parquet(df: DataFrame, batch_id: int, root: str) -> str:
    write_parquet(df, batch_path(root, batch_id))
    return "parquet"


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder wherever the session's file systems reach; False if it was not there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def verify_output(spark: SparkSession, path: str, file_format: str = "parquet", expected: int | None = None) -> int:
    """Rows written at a path; an output without rows, or with other than the expected number, is an error."""
    rows = spark.read.format(file_format).option("header", True).load(path).count()
    if rows == 0:
        raise ValueError(f"no rows at {path}")
    if expected is not None and rows != expected:
        raise ValueError(f"{rows} rows at {path}, expected {expected}")
    return rows


def run_id(now: dt.datetime | None = None) -> str:
    return (now or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")


def save_model(model: MLWritable, root: str, name: str, run: str | None = None) -> str:
    """Save under <root>/<name>_model_<run> and return that path."""
    path = f"{root}/{name.lower()}_model_{run or run_id()}"
    model.write().overwrite().save(path)
    return path


def write_versioned(df: DataFrame, root: str, run: str) -> None:
    """One version of an output plus an audit row with its size; older versions stay."""
    write_parquet(df, f"{root}/data/run_id={run}")
    spark = df.sparkSession
    audit = spark.read.parquet(f"{root}/data/run_id={run}").agg(F.count("*").alias("rows"))
    write_parquet(audit.withColumn("written_at", F.current_timestamp()), f"{root}/audit/run_id={run}")
