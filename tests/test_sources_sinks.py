import datetime as dt
from unittest.mock import MagicMock

import pytest

from riskloom.sources.files import read_csv
from helpers import events, scored
from pyspark.errors import AnalysisException

from riskloom import session
from riskloom.sinks import files, jdbc, tables
from riskloom.sinks import kafka as to_topic
from riskloom.sources import files as sources
from riskloom.sources import jdbc as database
from riskloom.sources import kafka


def test_kafka_options():
    stream = kafka.stream_options("h:9092", "t", minPartitions="8")
    assert stream["startingOffsets"] == "latest" and stream["failOnDataLoss"] == "false"
    assert stream["subscribe"] == "t" and stream["minPartitions"] == "8"
    assert kafka.stream_options("h", "t", startingOffsets="earliest")["startingOffsets"] == "earliest"
    assert kafka.batch_options("h", "t")["startingOffsets"] == "earliest"


def test_messages_per_partition(spark):
    frame = spark.createDataFrame([(0,), (0,), (1,)], "partition int")
    assert {r["partition"]: r["n"] for r in kafka.messages_per_partition(frame).collect()} == {0: 2, 1: 1}


def test_probe_reads_one_constant():
    options = database.jdbc_options("jdbc:x", "u", "p", "d", dbtable="big")
    probe = database.probe_options(options)
    assert probe["query"] == "SELECT 1 AS ok" and "dbtable" not in probe


def test_database_without_driver_is_not_available(spark):
    options = database.jdbc_options("jdbc:nothing://none", "u", "p", "no.such.Driver")
    assert database.jdbc_available(spark, options) is False


def test_predictions_after_the_session_start_in_order(spark):
    times = [dt.datetime(2024, 1, 1, h) for h in (9, 7, 8)]
    frame = scored(spark, *[{"processing_time": t} for t in times])
    rows = database.read_predictions(frame, dt.datetime(2024, 1, 1, 7)).collect()
    assert [r["processing_time"].hour for r in rows] == [8, 9] and len(rows[0]) == 11


def test_fallback_sink(spark, path):
    frame = events(spark, {})

    def broken(df):
        raise ConnectionError("down")

    stored = []
    assert jdbc.write_with_fallback(frame, broken, stored.append) == "fallback" and len(stored) == 1
    assert jdbc.write_with_fallback(frame, stored.append, broken) == "primary"
    with pytest.raises(ConnectionError):
        jdbc.write_with_fallback(frame, broken, broken)


def test_retried_batch_appends_only_what_is_missing(spark):
    batch = spark.createDataFrame([("a",), ("b",)], "id string")
    written = spark.createDataFrame([("a", 4), ("b", 3)], "id string, batch_id long")
    left = jdbc.not_yet_written(batch, 4, written, "id").collect()
    assert [tuple(r) for r in left] == [("b", 4)]


@pytest.mark.parametrize("truncate", [True, False])
def test_clear_table(spark, truncate):
    name = f"cleared_{truncate}".lower()
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.range(7).write.format("parquet").saveAsTable(name)
    assert tables.clear_table(spark, name, truncate) == 7
    assert spark.table(name).count() == 0 and spark.table(name).columns == ["id"]
    spark.sql(f"DROP TABLE {name}")


def test_verify_output(spark, path):
    files.write_parquet(spark.range(3), f"{path}/some")
    assert files.verify_output(spark, f"{path}/some") == 3
    files.write_parquet(spark.range(0), f"{path}/none")
    with pytest.raises(ValueError, match="no rows"):
        files.verify_output(spark, f"{path}/none")


def test_file_count_is_up_to_the_caller(spark, path):
    files.write_parquet(spark.range(100).repartition(4), f"{path}/many")
    files.write_csv(spark.range(100).repartition(4), f"{path}/one", files=1)
    assert spark.read.parquet(f"{path}/many").inputFiles().__len__() == 4
    assert len(sources.read_csv(spark, f"{path}/one").inputFiles()) == 1


def test_csv_with_fallback_reads_every_part(spark, path):
    files.write_csv(spark.range(100).repartition(3), f"{path}/parts")
    frame = sources.read_csv_or(spark, [f"{path}/absent", f"{path}/parts"], "id long")
    assert frame.count() == 100
    with pytest.raises(FileNotFoundError):
        sources.read_csv_or(spark, [f"{path}/absent"], "id long")


def test_inferred_csv(spark, path):
    files.write_csv(spark.createDataFrame([("a", 1.5)], "g string, v double"), path, mode="overwrite")
    assert sources.read_csv(spark, path).dtypes == [("g", "string"), ("v", "double")]


def test_versions_are_kept_and_audited(spark, path):
    files.write_versioned(spark.range(3), path, "r1")
    files.write_versioned(spark.range(5), path, "r2")
    audit = {r["run_id"]: r["rows"] for r in spark.read.parquet(f"{path}/audit").collect()}
    assert audit == {"r1": 3, "r2": 5}
    assert spark.read.parquet(f"{path}/data").count() == 8
    assert files.run_id(dt.datetime(2025, 3, 30, 17, 44, 32)) == "20250330_174432"


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get(session.CHECKPOINT_DIR)
    assert session.run_dir(spark, "x").startswith(folder)
    assert session.run_dir(spark, "x") != session.run_dir(spark, "x")


class Unset:
    """A session whose checkpoint folder is not set."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})


def test_only_a_local_session_may_go_without_a_shared_folder():
    assert session.shared_dir(Unset("local[2]")) == session.shared_dir(Unset("local[4]"))
    with pytest.raises(ValueError, match="checkpoint.dir"):
        session.shared_dir(Unset("spark://host:7077"))


class Recorder:
    """A reader or writer that notes its options."""

    def __init__(self):
        self.noted = {}

    def format(self, name):
        self.noted["format"] = name
        return self

    def options(self, **options):
        self.noted.update(options)
        return self

    def option(self, key, value):
        self.noted[key] = value
        return self

    def mode(self, mode):
        self.noted["mode"] = mode
        return self

    def save(self):
        self.noted["saved"] = True

    load = save


def test_jdbc_append_options():
    frame = MagicMock(write=Recorder())
    jdbc.write_jdbc(frame, database.jdbc_options("jdbc:x", "u", "p", "d"), "predictions")
    noted = frame.write.noted
    assert (noted["format"], noted["dbtable"], noted["mode"], noted["saved"]) == ("jdbc", "predictions", "append", True)


def test_partitioned_jdbc_read_options():
    spark = MagicMock(read=Recorder())
    database.read_table(spark, {"url": "jdbc:x"}, "predictions", "processing_time", "2024-01-01", "2024-02-01", 8)
    noted = spark.read.noted
    assert noted["partitionColumn"] == "processing_time" and noted["numPartitions"] == 8


def test_jdbc_table_is_emptied_by_truncating_overwrite(spark):
    writer = Recorder()
    fake = MagicMock()
    fake.read.format().options().load().select().first.return_value = (12,)
    fake.createDataFrame.return_value = MagicMock(write=writer)
    assert tables.clear_jdbc_table(fake, {"url": "jdbc:x"}, "predictions", spark.range(1).schema) == 12
    assert writer.noted["truncate"] is True and writer.noted["mode"] == "overwrite"


def test_messages_go_to_the_topic():
    frame = MagicMock(write=Recorder())
    to_topic.write_kafka(frame, "h:9092", "t")
    assert frame.write.noted["topic"] == "t" and frame.write.noted["format"] == "kafka"


def test_kafka_readers_ask_for_the_connector(spark):
    for read in (kafka.read_kafka, kafka.read_kafka_batch):
        with pytest.raises(AnalysisException, match="kafka"):
            read(spark, "h:9092", "t")


def test_csv_columns_go_by_name_and_whole_numbers_stay(spark, path):
    with open(f"{path}/a.csv", "w") as file:
        file.write("b,a,label\n1.0,x,1.0\n2.5,y,0\n")
    rows = read_csv(spark, f"{path}/a.csv", "a string, b int, label int, absent double")
    assert rows.columns == ["a", "b", "label"]
    assert [tuple(r) for r in rows.collect()] == [("x", 1, 1), ("y", None, 0)]
