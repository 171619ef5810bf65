"""Streams: every query plays the events back as a file stream and reads its result as a table."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.catalog.observations import LEVELS_SQL, OBS, SCORED, observations, observed, table
from riskloom.operators import profile
from riskloom.schema import EVENT_SCHEMA
from riskloom.session import counting_session, run_dir
from riskloom.sinks.files import write_batch_parquet
from riskloom.sinks.kafka import to_messages
from riskloom.sources.files import read_file_stream
from riskloom.sources.kafka import messages_per_partition as per_partition
from riskloom.streaming import counts
from riskloom.streaming.messages import parse_messages
from riskloom.streaming.scoring import batch_metrics_total, start_query, start_scoring

MESSAGE_SCHEMA = T.StructType([T.StructField(f.name.lower(), f.dataType) for f in EVENT_SCHEMA])
PROPS_SCHEMA = T.StructType([T.StructField("k", T.IntegerType())])


def event_stream(spark, sf_dir) -> DataFrame:
    """The events table as a stream; the glob matches a single file and a folder alike."""
    schema = table(spark, sf_dir, "events").schema
    return read_file_stream(spark, f"{sf_dir}/events.parque[t]", schema)


def parse_events(spark, sf_dir):
    out, checkpoint = run_dir(spark, "parsed"), run_dir(spark, "checkpoint")
    raw = event_stream(spark, sf_dir).select("event_id", F.col("props").cast("binary").alias("value"))
    parsed = parse_messages(raw, PROPS_SCHEMA, keep=("event_id",))
    writer = parsed.writeStream.format("parquet").option("path", out)
    start_query(writer, checkpoint).awaitTermination()
    return spark.read.schema(parsed.schema).parquet(out)


def encode_messages(spark, sf_dir):
    rows = observations(spark, sf_dir).drop("patient_id", "processing_time")
    messages = to_messages(rows, "obs_id", F.lit(1_700_000_000).cast("long"))
    return parse_messages(messages, MESSAGE_SCHEMA, keep=("key",))


def messages_per_partition(spark, sf_dir):
    messages = table(spark, sf_dir, "events").select((F.col("event_id") % 4).cast("int").alias("partition"))
    return per_partition(messages)


def _score(spark, sf_dir, model=None, metrics_root=None) -> DataFrame:
    out, checkpoint = run_dir(spark, "scored"), run_dir(spark, "checkpoint")
    events = observed(event_stream(spark, sf_dir))
    sink = partial(write_batch_parquet, root=out)
    start_scoring(events, sink, checkpoint, model, ("obs_id",), metrics_root).awaitTermination()
    return spark.read.parquet(out).select("obs_id", F.col("predicted_diabetes").alias("predicted"))


def score_stream_rules(spark, sf_dir):
    return _score(spark, sf_dir)


def stream_batch_accuracy(spark, sf_dir):
    metrics_root = run_dir(spark, "metrics")
    _score(spark, sf_dir, metrics_root=metrics_root)
    return batch_metrics_total(spark.read.parquet(metrics_root))


def _minutes(spark, sf_dir) -> DataFrame:
    out, checkpoint = run_dir(spark, "minutes"), run_dir(spark, "checkpoint")
    minutes = counts.per_minute(event_stream(counting_session(spark), sf_dir), F.col("ts"), late=None)
    counts.start_counts(minutes, out, checkpoint).awaitTermination()
    return counts.latest_counts(spark, out, ["window_start"])


def messages_per_minute(spark, sf_dir):
    return _minutes(spark, sf_dir).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n")


def message_total(spark, sf_dir):
    return counts.message_totals(_minutes(spark, sf_dir))


def stream_risk_levels(spark, sf_dir):
    out, checkpoint = run_dir(spark, "levels"), run_dir(spark, "checkpoint")
    rows = profile.with_risk(observed(event_stream(counting_session(spark), sf_dir)))
    levels = rows.groupBy("risk_level").agg(F.count("*").alias("n"))
    counts.start_counts(levels, out, checkpoint).awaitTermination()
    return profile.complete_levels(counts.latest_counts(spark, out, ["risk_level"])).select("risk_level", "n")


QUERIES = {
    f.__name__: f
    for f in (
        parse_events,
        encode_messages,
        messages_per_partition,
        score_stream_rules,
        stream_batch_accuracy,
        messages_per_minute,
        message_total,
        stream_risk_levels,
    )
}

_MESSAGE = [c for c in MESSAGE_SCHEMA.names if c != "timestamp"]

ORACLES = {
    "parse_events": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "encode_messages": f"""{OBS}
SELECT CAST(obs_id AS VARCHAR) AS key, {', '.join(_MESSAGE)}, CAST(1700000000 AS BIGINT) AS "timestamp" FROM obs""",
    "messages_per_partition": """SELECT CAST(event_id % 4 AS INTEGER) AS "partition", COUNT(*) AS n FROM events GROUP BY 1""",
    "score_stream_rules": f"{SCORED} SELECT obs_id, predicted_diabetes AS predicted FROM scored",
    "stream_batch_accuracy": f"""{SCORED}
SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE prediction_match) AS correct FROM scored""",
    "messages_per_minute": """SELECT date_trunc('minute', ts) AS window_start, COUNT(*) AS n FROM events GROUP BY 1""",
    "message_total": """SELECT COUNT(*) AS total,
  COUNT(*) FILTER (WHERE date_trunc('minute', ts) = (SELECT date_trunc('minute', MAX(ts)) FROM events)) AS per_min
FROM events""",
    "stream_risk_levels": f"""{SCORED}
SELECT lv.risk_level, COUNT(s.obs_id) AS n FROM {LEVELS_SQL} LEFT JOIN scored s USING (risk_level) GROUP BY 1""",
}
