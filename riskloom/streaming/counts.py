"""Running counts over a stream, written as changes per micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.sinks.files import write_batch_parquet
from riskloom.streaming.scoring import start_query


def per_minute(stream: DataFrame, time: Column, late: str | None, size: str = "1 minute") -> DataFrame:
    """(window_start, n) per tumbling minute.

    A window older than `late` is final and leaves the state; None only for a stream that ends.
    """
    timed = stream.select(time.cast("timestamp").alias("time"))
    if late:
        timed = timed.withWatermark("time", late)
    windows = timed.groupBy(F.window("time", size)).agg(F.count("*").alias("n"))
    return windows.select(F.col("window.start").alias("window_start"), "n")


def start_counts(counts: DataFrame, root: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write only the groups a micro-batch has changed, under root/batch_id=N."""

    def run(changed: DataFrame, batch_id: int) -> None:
        write_batch_parquet(changed, batch_id, root)

    return start_query(counts.writeStream.outputMode("update").foreachBatch(run), checkpoint, every)


def _changes(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.option("basePath", root).parquet(root)


def compact_counts(spark: SparkSession, root: str, keys: Sequence[str], target: str) -> None:
    """Fold the changes of all batches but the last into one folder under a new root, to go on from there.

    The last batch keeps its own folder: if it is replayed after a failure it replaces only its own changes.
    A query restarted with the same checkpoint and the new root adds to both.
    """
    changes = _changes(spark, root)
    last = changes.agg(F.max("batch_id")).first()[0]
    earlier = changes.where(F.col("batch_id") < last)
    if not earlier.isEmpty():
        write_batch_parquet(earlier.groupBy(*keys).agg(F.max_by("n", "batch_id").alias("n")), last - 1, target)
    write_batch_parquet(changes.where(F.col("batch_id") == last).drop("batch_id"), last, target)


def latest_counts(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """The newest count of every group."""
    changes = _changes(spark, root)
    return changes.groupBy(*keys).agg(F.max_by("n", "batch_id").alias("n"))


def message_totals(minutes: DataFrame) -> DataFrame:
    """(total, per_min): all messages, and those of the newest minute; zeros without any."""
    return minutes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total"),
        F.coalesce(F.max_by("n", "window_start"), F.lit(0)).cast("long").alias("per_min"),
    )
