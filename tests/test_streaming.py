import json
from functools import partial

import pytest
from helpers import BLANK, events
from pyspark.sql import functions as F

from riskloom.operators.models import score
from riskloom.sinks.files import write_batch_csv, write_batch_parquet
from riskloom.sinks.kafka import to_messages
from riskloom.sources.files import read_counter, read_csv, read_file_stream
from riskloom.streaming import counts
from riskloom.streaming.messages import parse_messages, replay, stamped
from riskloom.streaming.scoring import batch_metrics_total, start_query, start_scoring

MESSAGE = "key string, value string"


def text(**changes):
    return json.dumps({**BLANK, **changes})


def parsed(spark, *values, **options):
    return parse_messages(spark.createDataFrame([(v,) for v in values], "value string"), **options)


def test_whole_number_sent_as_float_is_kept(spark):
    row = parsed(spark, text(hypertension=1.0, diabetes=0.0, timestamp=1.7e9)).first()
    assert (row["hypertension"], row["diabetes"], row["timestamp"]) == (1, 0, 1_700_000_000)
    assert parsed(spark, text(hypertension=0.5)).first()["hypertension"] is None


def test_bad_fields_and_junk_become_null(spark):
    rows = parsed(spark, text(age="old"), json.dumps({"bmi": 30.5}), "junk", None).collect()
    assert rows[0]["age"] is None and rows[0]["bmi"] == BLANK["bmi"]
    assert rows[1]["bmi"] == 30.5 and rows[1]["gender"] is None
    assert all(v is None for v in rows[2]) and all(v is None for v in rows[3])


def test_corrupt_text_is_kept_on_request(spark):
    rows = parsed(spark, "junk", text(), keep_corrupt=True).collect()
    assert rows[0]["_corrupt_record"] == "junk" and rows[1]["_corrupt_record"] is None


def test_messages_carry_null_for_missing_values(spark):
    frame = events(spark, {"bmi": float("nan"), "gender": None}).drop("timestamp").withColumn("id", F.lit(7))
    row = to_messages(frame, "id", F.lit(5)).first()
    body = json.loads(row["value"])
    assert row["key"] == "7" and body["bmi"] is None and body["gender"] is None and body["timestamp"] == 5
    assert "id" not in body


def test_event_time_is_kept_next_to_the_scoring_time(spark):
    row = stamped(events(spark, {}), F.lit("2024-01-01 00:00:00").cast("timestamp")).first()
    assert row["event_time"].timestamp() == BLANK["timestamp"] and row["processing_time"].year == 2024


def stream_of(spark, folder, max_files=1):
    raw = read_file_stream(spark, folder, spark.createDataFrame([], MESSAGE).schema, max_files)
    return stamped(parse_messages(raw, keep=("key",)))


def people(spark, first, n):
    changes = [{"age": 20.0 + (i % 60), "timestamp": 1_700_000_000 + 20 * i, "diabetes": i % 2} for i in range(first, first + n)]
    frame = events(spark, *changes)
    return frame.withColumn("key", ((F.col("timestamp") - 1_700_000_000) / 20).cast("int").cast("string"))


def send(spark, folder, first, n, files=3):
    frame = people(spark, first, n)
    body = F.to_json(F.struct(*[c for c in frame.columns if c != "key"]), {"ignoreNullFields": "false"})
    replay(frame.select("key", body.alias("value")), folder, files)


def test_stream_equals_batch_and_survives_a_restart(spark, path):
    inbox, out, log, checkpoint = (f"{path}/{n}" for n in ("in", "out", "log", "cp"))
    send(spark, inbox, 0, 30)

    def run():
        start_scoring(
            stream_of(spark, inbox), partial(write_batch_parquet, root=out), checkpoint, None, ("key",), log
        ).awaitTermination()

    run()
    run()  # nothing new
    assert spark.read.parquet(out).count() == 30
    send(spark, inbox, 30, 10)
    run()
    got = {(r["key"], r["predicted_diabetes"]) for r in spark.read.parquet(out).collect()}
    want = {(r["key"], r["predicted_diabetes"]) for r in score(people(spark, 0, 40)).collect()}
    assert got == want and spark.read.parquet(out).count() == 40
    assert spark.read.parquet(out).select("batch_id").distinct().count() > 1
    total = batch_metrics_total(spark.read.parquet(log)).first()
    assert total["total"] == 40


def test_failed_batch_stops_the_query_and_is_scored_again(spark, path):
    inbox, out, checkpoint = (f"{path}/{n}" for n in ("in", "out", "cp"))
    send(spark, inbox, 0, 10, files=1)

    def broken(df, batch_id):
        write_batch_parquet(df, batch_id, out)
        raise OSError("lost")

    query = start_scoring(stream_of(spark, inbox), broken, checkpoint, keep=("key",))
    with pytest.raises(Exception, match="lost"):
        query.awaitTermination()
    start_scoring(stream_of(spark, inbox), partial(write_batch_parquet, root=out), checkpoint, keep=("key",)).awaitTermination()
    assert spark.read.parquet(out).count() == 10


def test_empty_batches_are_skipped(spark, path):
    inbox = f"{path}/in"
    send(spark, inbox, 0, 4, files=1)
    seen = []
    nothing = stream_of(spark, inbox).where("age < 0")
    start_scoring(nothing, lambda df, batch_id: seen.append(batch_id), f"{path}/cp").awaitTermination()
    assert seen == []


def test_batch_csv_replaces_itself(spark, path):
    frame = score(events(spark, {}, {})).drop("timestamp")
    write_batch_csv(frame, 3, path)
    write_batch_csv(frame, 3, path)
    assert read_csv(spark, f"{path}/batch_id=3", frame.schema).count() == 2


def test_counts_per_minute_over_restarts(spark, path):
    inbox, out, checkpoint = (f"{path}/{n}" for n in ("in", "out", "cp"))
    assert tuple(read_counter(spark, out).first()) == (0, 0)
    for first in (0, 4):
        send(spark, inbox, first, 4, files=2)
        minutes = counts.per_minute(stream_of(spark, inbox), F.col("event_time"), late=None)
        counts.start_counts(minutes, out, checkpoint).awaitTermination()
        if first == 0:  # go on in a compacted folder
            counts.compact_counts(spark, out, ["window_start"], f"{path}/compact")
            out = f"{path}/compact"
    rows = counts.latest_counts(spark, out, ["window_start"]).orderBy("window_start").collect()
    assert [r["n"] for r in rows] == [2, 3, 3]
    assert tuple(read_counter(spark, out).first()) == (8, 3)


def test_old_windows_leave_the_state_with_a_watermark(spark, path):
    inbox, checkpoint = f"{path}/in", f"{path}/cp"
    states = []
    for first in (0, 100, 200):
        send(spark, inbox, first, 4, files=1)
        minutes = counts.per_minute(stream_of(spark, inbox), F.col("event_time"), late="1 minute")
        query = counts.start_counts(minutes, f"{path}/out", checkpoint)
        query.awaitTermination()
        states.append(sum(op["numRowsTotal"] for op in query.lastProgress["stateOperators"]))
    assert max(states) <= 4


def test_interval_trigger(spark, path):
    inbox = f"{path}/in"
    send(spark, inbox, 0, 3, files=1)
    writer = stream_of(spark, inbox).writeStream.format("parquet").option("path", f"{path}/out")
    query = start_query(writer, f"{path}/cp", every="1 second")
    try:
        query.processAllAvailable()
        assert spark.read.parquet(f"{path}/out").count() == 3
    finally:
        query.stop()


def test_replay_after_compaction_keeps_the_counts(spark, path):
    for batch, rows in enumerate(([("a", 1)], [("a", 5)], [("b", 9)])):
        write_batch_parquet(spark.createDataFrame(rows, "k string, n long"), batch, f"{path}/all")
    counts.compact_counts(spark, f"{path}/all", ["k"], f"{path}/less")
    write_batch_parquet(spark.createDataFrame([("b", 9)], "k string, n long"), 2, f"{path}/less")
    assert sorted(map(tuple, counts.latest_counts(spark, f"{path}/less", ["k"]).collect())) == [("a", 5), ("b", 9)]
