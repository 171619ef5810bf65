"""Streaming scoring: messages in, scored rows to a database or, failing that, to CSV."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.sinks.files import write_batch_csv
from riskloom.sinks.jdbc import append_batch, write_with_fallback
from riskloom.sources.files import load_model
from riskloom.sources.jdbc import jdbc_available
from riskloom.sources.kafka import read_kafka
from riskloom.streaming.finality import start_final_windows
from riskloom.streaming.messages import parse_messages, stamped
from riskloom.streaming.scoring import start_scoring


# What the sink gets besides the scored columns: the row's identity and its own time.
KEPT = ("message_id", "event_time")
PER_BATCH = 1_000_000


def database_or_csv(options: dict[str, str], table: str, key: str, csv_root: str):
    """Batch sink: append to the database, or write the batch as CSV when that fails.

    An append that fails halfway leaves some rows in both places; `key` tells them apart.
    """

    def store(df: DataFrame, batch_id: int) -> None:
        if not jdbc_available(df.sparkSession, options):
            raise ConnectionError("database not available")
        append_batch(df, batch_id, options, table, key)

    def sink(df: DataFrame, batch_id: int) -> str:
        csv = partial(write_batch_csv, batch_id=batch_id, root=csv_root)
        return write_with_fallback(df, partial(store, batch_id=batch_id), csv)

    return sink


def serve(
    spark: SparkSession,
    servers: str,
    topic: str,
    sink,
    checkpoint: str,
    model_path: str | None = None,
    metrics_root: str | None = None,
    every: str = "3 seconds",
    per_batch: int = PER_BATCH,
) -> StreamingQuery:
    """Score a topic until stopped. The message key and offsets identify a row in the sink.

    A micro-batch takes at most `per_batch` messages; what is left waits for the next one.
    """
    source = read_kafka(spark, servers, topic, maxOffsetsPerTrigger=str(per_batch)).selectExpr(
        "concat_ws('-', topic, partition, offset) AS message_id", "value"
    )
    events = stamped(parse_messages(source, keep=("message_id",)))
    model = load_model(model_path) if model_path else None
    return start_scoring(events, sink, checkpoint, model, KEPT, metrics_root, every)


def count_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    root: str,
    checkpoint: str,
    late: int = 600,
    every: str = "3 seconds",
    per_batch: int = PER_BATCH,
) -> StreamingQuery:
    """Count a topic's messages per minute until stopped, by the time the broker took them.

    A minute is final `late` seconds after its end; `finality.final_windows` reads the counts, `late_rows` what came later.
    """
    messages = read_kafka(spark, servers, topic, maxOffsetsPerTrigger=str(per_batch))
    kept = messages.select("topic", "partition", "offset", "timestamp")
    return start_final_windows(kept, F.col("timestamp"), root, checkpoint, late, every=every)
