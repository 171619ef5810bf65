"""Micro-batch scoring that a restart neither loses nor repeats."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from riskloom.operators.metrics import batch_accuracy
from riskloom.operators.models import score, spread
from riskloom.schema import to_scored_rows
from riskloom.sinks.files import write_batch_parquet

BatchSink = Callable[[DataFrame, int], object]


def start_query(writer, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start with its own checkpoint: at an interval, or over what is there now when None."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def start_scoring(
    events: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    model: Transformer | None = None,
    keep: tuple[str, ...] = (),
    metrics_root: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Score every micro-batch with the model, or the rules without one, and hand it to `sink`.

    The batch is computed once for all its uses. Sinks write to a place named by the batch id,
    so a replayed batch replaces itself. Errors stop the query; no batch is skipped.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = batch if model is None else spread(batch)
        scored = to_scored_rows(score(rows, model), keep).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if scored.isEmpty():
                return
            sink(scored, batch_id)
            if metrics_root:
                write_batch_parquet(batch_accuracy(scored), batch_id, metrics_root)
        finally:
            scored.unpersist()

    return start_query(events.writeStream.foreachBatch(run), checkpoint, every)


def batch_metrics_total(metrics: DataFrame) -> DataFrame:
    """(total, correct) over all logged batches."""
    return metrics.agg(F.sum("n").alias("total"), F.sum("correct").alias("correct"))
