"""Correlations of a stream: co-moments of each micro-batch, merged on read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskloom.operators.comoments import comoment_cells, merge_comoments
from riskloom.sinks.files import write_batch_parquet
from riskloom.streaming.scoring import start_query


def start_comoments(
    stream: DataFrame, columns: Sequence[str], root: str, checkpoint: str, by: Sequence[str] = (), every: str | None = None
) -> StreamingQuery:
    """Write the cells of each micro-batch under root/batch_id=N; a replayed batch replaces its own."""

    def run(batch: DataFrame, batch_id: int) -> None:
        write_batch_parquet(comoment_cells(batch, columns, by), batch_id, root)

    return start_query(stream.writeStream.foreachBatch(run), checkpoint, every)


def read_comoments(spark: SparkSession, root: str, by: Sequence[str] = ()) -> DataFrame:
    """The cells of all batches so far, merged."""
    return merge_comoments(spark.read.option("basePath", root).parquet(root), by)
