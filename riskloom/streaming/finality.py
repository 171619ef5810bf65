"""Windows that become final: counts behind a watermark, and a side table for rows that come too late.

Spark drops rows behind a watermark without a trace. Here every micro-batch writes, under its own id, the rows that were too
late, the windows it made final, the open windows with their counts so far, and the newest time seen. The next one starts
from these, so the state holds only open windows, each row is either counted or in the side table, and a
replayed batch replaces what it had written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from riskloom.sinks.files import batch_path, delete_path, write_batch_parquet
from riskloom.streaming.scoring import start_query

SECOND = 1_000_000
WINDOWS = "start long, n long"


def start_final_windows(
    stream: DataFrame, time: Column, root: str, checkpoint: str, late: int, size: int = 60, every: str | None = None
) -> StreamingQuery:
    """Count rows per tumbling window of `size` seconds; a window is final `late` seconds after its end.

    The watermark of a batch is the newest time of the batches before it, less `late`. Rows of windows that have
    ended by then, and rows without a time, go to the side table as they are.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(F.struct("*").alias("row"), F.unix_micros(time.cast("timestamp")).alias("at"))
        rows = rows.withColumn("start", F.col("at") - F.pmod("at", F.lit(size * SECOND)))
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            newest = _newest(spark, root, batch_id - 1)
            ended = F.lit(False) if newest is None else _ended(newest, late, size)
            too_late = F.col("at").isNull() | ended
            write_batch_parquet(rows.where(too_late).select("row.*"), batch_id, f"{root}/late")
            counted = rows.where(~too_late).groupBy("start").agg(F.count("*").alias("n"))
            if batch_id > 0:
                before = spark.read.schema(WINDOWS).parquet(batch_path(f"{root}/open", batch_id - 1))
                counted = counted.unionByName(before).groupBy("start").agg(F.sum("n").alias("n"))
            marks = rows.agg(F.max("at").alias("newest"), F.count("*").alias("rows"), F.count_if(too_late).alias("late"))
            marks = marks.withColumn("newest", F.greatest("newest", F.lit(newest).cast("long")))
            now = marks.first()["newest"]
            ended = F.lit(False) if now is None else _ended(now, late, size)
            counted = counted.persist(StorageLevel.MEMORY_AND_DISK)  # one row per open window
            write_batch_parquet(counted.where(ended), batch_id, f"{root}/final")
            write_batch_parquet(counted.where(~ended), batch_id, f"{root}/open")
            counted.unpersist()
            write_batch_parquet(marks, batch_id, f"{root}/marks")
            if batch_id > 1:
                delete_path(spark, batch_path(f"{root}/open", batch_id - 2))
        finally:
            rows.unpersist()

    return start_query(stream.writeStream.foreachBatch(run), checkpoint, every)


def _ended(newest: int, late: int, size: int) -> Column:
    return F.col("start") + size * SECOND <= newest - late * SECOND


def _newest(spark: SparkSession, root: str, batch_id: int) -> int | None:
    if batch_id < 0:
        return None
    return spark.read.parquet(batch_path(f"{root}/marks", batch_id)).first()["newest"]


def final_windows(spark: SparkSession, root: str, ended: bool = False) -> DataFrame:
    """(window_start, n) of all final windows; with `ended`, of a stream that is over, the open ones too."""
    found = spark.read.schema(WINDOWS).parquet(f"{root}/final").select("start", "n")
    if ended:
        last = marks(spark, root).agg(F.max("batch_id")).first()[0]
        found = found.unionByName(spark.read.schema(WINDOWS).parquet(batch_path(f"{root}/open", last)))
    return found.select(F.timestamp_micros("start").alias("window_start"), "n")


def late_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows that came too late, with the batch_id that brought them."""
    return spark.read.option("basePath", f"{root}/late").parquet(f"{root}/late")


def marks(spark: SparkSession, root: str) -> DataFrame:
    """(batch_id, newest, rows, late) per micro-batch; newest in microseconds."""
    return spark.read.option("basePath", f"{root}/marks").parquet(f"{root}/marks")
