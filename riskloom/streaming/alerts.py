"""Rate alerts on a stream: each window that becomes final is held against the mean and deviation of those before it.

A micro-batch writes, under its own id, the rows that came too late, the windows it made final with their judgement, the
windows still open, and per key a ring of the newest final windows. The next batch starts from the last two, so the state
is a few rows per key, and a replayed batch replaces what it had written. Windows become final in the order of time, because
rows of a window that ended before the watermark are late.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from riskloom.functions.nulls import nan_to_null
from riskloom.sinks.files import batch_path, delete_path, write_batch_parquet
from riskloom.streaming.finality import SECOND
from riskloom.streaming.scoring import start_query

DAY = 24 * 3600
CELL = "start long, n long, total double"


def _schema(stream: DataFrame, by: Sequence[str]) -> str:
    return ", ".join([*[f"`{b}` {stream.schema[b].dataType.simpleString()}" for b in by], CELL])


def judged(cells: DataFrame, by: Sequence[str], windows: int, k: float) -> DataFrame:
    """Cells (*by, start, n, total) with rate, trailing_mean, trailing_sd over the `windows` cells before, and alert.

    A window of which all values are missing has no rate, gives none to the mean, and raises no alert.
    """
    trailing = Window.partitionBy(*by).orderBy("start").rowsBetween(-windows, -1)
    rated = cells.withColumn("rate", F.try_divide("total", "n"))
    rated = rated.withColumns({"trailing_mean": F.avg("rate").over(trailing), "trailing_sd": F.stddev_pop("rate").over(trailing)})
    beyond = F.abs(F.col("rate") - F.col("trailing_mean")) > k * F.col("trailing_sd")
    return rated.withColumn("alert", F.coalesce(beyond, F.lit(False)))


def start_rate_alerts(
    stream: DataFrame,
    time: Column,
    value: Column,
    root: str,
    checkpoint: str,
    late: int,
    by: Sequence[str] = (),
    size: int = DAY,
    windows: int = 7,
    k: float = 2.0,
    every: str | None = None,
) -> StreamingQuery:
    """Judge the mean of `value` per key and tumbling window of `size` seconds, final `late` seconds after its end.

    The watermark of a batch is the newest time of the batches before it, less `late`. Rows of windows that have ended by
    then, and rows without a time, go to the side table as they are. A NULL key is a key; a NULL or NaN value is not counted.
    """
    schema, keys = _schema(stream, by), [*by, "start"]

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        at = F.unix_micros(time.cast("timestamp"))
        rows = batch.select(*by, F.struct("*").alias("_row"), at.alias("at"), nan_to_null(value.cast("double")).alias("_value"))
        rows = rows.withColumn("start", F.col("at") - F.pmod("at", F.lit(size * SECOND))).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            newest = None if batch_id == 0 else spark.read.parquet(batch_path(f"{root}/marks", batch_id - 1)).first()["newest"]
            too_late = F.col("at").isNull() | _ended(newest, late, size)
            write_batch_parquet(rows.where(too_late).select("_row.*"), batch_id, f"{root}/late")
            found = rows.where(~too_late).groupBy(*keys).agg(F.count("_value").alias("n"), F.sum("_value").alias("total"))
            ring = None
            if batch_id > 0:
                waiting = spark.read.schema(schema).parquet(batch_path(f"{root}/open", batch_id - 1))
                found = found.unionByName(waiting).groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
                ring = spark.read.schema(schema).parquet(batch_path(f"{root}/ring", batch_id - 1))
            seen = rows.agg(F.max("at").alias("newest"), F.count("*").alias("rows"), F.count_if(too_late).alias("late"))
            seen = seen.withColumn("newest", F.greatest("newest", F.lit(newest).cast("long")))
            now = _ended(seen.first()["newest"], late, size)
            found = found.persist(StorageLevel.MEMORY_AND_DISK)  # a row per key and window not final before
            closed = found.where(now)
            history = closed if ring is None else closed.unionByName(ring)
            told = judged(history, by, windows, k).where(~_ended(newest, late, size))  # the ring's were told before
            write_batch_parquet(told, batch_id, f"{root}/final")
            latest = Window.partitionBy(*by).orderBy(F.desc("start"))
            kept = history.withColumn("_place", F.row_number().over(latest)).where(F.col("_place") <= windows).drop("_place")
            write_batch_parquet(kept, batch_id, f"{root}/ring")
            write_batch_parquet(found.where(~now), batch_id, f"{root}/open")
            found.unpersist()
            write_batch_parquet(seen, batch_id, f"{root}/marks")
            if batch_id > 1:
                for name in ("open", "ring"):
                    delete_path(spark, batch_path(f"{root}/{name}", batch_id - 2))
        finally:
            rows.unpersist()

    return start_query(stream.writeStream.foreachBatch(run), checkpoint, every)


def _ended(newest: int | None, late: int, size: int) -> Column:
    return F.lit(False) if newest is None else F.col("start") + size * SECOND <= newest - late * SECOND


def read_rate_alerts(spark: SparkSession, root: str, by: Sequence[str] = ()) -> DataFrame:
    """(*by, window_start, n, rate, trailing_mean, trailing_sd, alert) of all final windows."""
    found = spark.read.option("basePath", f"{root}/final").parquet(f"{root}/final")
    return found.select(*by, F.timestamp_micros("start").alias("window_start"), "n", "rate", "trailing_mean", "trailing_sd", "alert")
