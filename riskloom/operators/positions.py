"""Row numbers without ordering rows: by their place in files, or in range partitions of distinct keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.session import run_dir


def number_by_file(spark: SparkSession, path: str, columns: Sequence[str] | None = None, out: str = "position") -> DataFrame:
    """Rows of Parquet files numbered from 0 in order of file path, then of their place in the file.

    Parquet tells each row's index in its file. What has to be summed up is one row count per file, from the same
    metadata; no row is sorted or shuffled for its number.
    """
    found = spark.read.parquet(path)
    file, index = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    sizes = found.select(file.alias("file"), index.alias("index")).groupBy("file").agg((F.max("index") + 1).alias("rows"))
    before = F.sum("rows").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("file", F.coalesce(before, F.lit(0)).alias("offset"))  # one row per file
    kept = found.columns if columns is None else list(columns)
    rows = found.select(*kept, file.alias("_file"), index.alias("_index"))
    joined = rows.join(offsets, F.col("_file") == F.col("file"))
    return joined.select(*kept, (F.col("offset") + F.col("_index")).alias(out))


def attach_by_file_position(spark: SparkSession, left: str, right: str, columns: Sequence[str]) -> DataFrame:
    """Rows of the files at `left` with `columns` of the rows in the same places at `right`, NULL past their end."""
    numbered = number_by_file(spark, left, out="_position")
    source = number_by_file(spark, right, columns, "_position")
    return numbered.drop(*columns).join(source, "_position", "left").drop("_position")


def number_in_order(df: DataFrame, order: Sequence[Column], out: str = "position") -> DataFrame:
    """Distinct rows numbered from 0 in the given order.

    Range partitions are sorted and written with each row's place in its task; one count per task then gives
    the offsets. There is no bucket that grows and no limit to their number.
    """
    spark, place = df.sparkSession, run_dir(df.sparkSession, "positions")
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.withColumn("_place", F.monotonically_increasing_id()).write.parquet(place)  # the task above bit 33, the row below
    rows = spark.read.parquet(place).withColumn("_task", F.shiftright("_place", 33))
    sizes = rows.groupBy("_task").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_task", F.coalesce(before, F.lit(0)).alias("_offset"))  # one row per task
    number = F.col("_offset") + F.col("_place").bitwiseAND((1 << 33) - 1)
    return rows.join(offsets, "_task").withColumn(out, number).drop("_task", "_place", "_offset")
