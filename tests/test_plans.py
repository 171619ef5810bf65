import csv
import glob
import os
import random
from functools import partial

import pytest
from helpers import column
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from riskloom.operators.models import forest, logistic, score
from riskloom.plans import serving
from riskloom.plans.analytics import enriched, summaries
from riskloom.plans.preparation import prepare
from riskloom.plans.publishing import message_rows, publish
from riskloom.plans.serving import database_or_csv
from riskloom.plans.training import compare_models, save_comparison
from riskloom.sinks.files import write_batch_parquet
from riskloom.sinks.kafka import to_messages
from riskloom.sources.files import load_model, read_file_stream
from riskloom.sources.jdbc import jdbc_options
from riskloom.streaming.messages import parse_messages, replay, stamped
from riskloom.streaming.scoring import start_scoring


@pytest.fixture
def raw_csv(path):
    rng = random.Random(7)
    file = f"{path}/raw.csv"
    with open(file, "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(
            "gender,age,hypertension,heart_disease,smoking_history,bmi,HbA1c_level,blood_glucose_level,diabetes".split(",")
        )
        for i in range(400):
            glucose = rng.randint(80, 220)
            writer.writerow(
                [
                    rng.choice(["Female", "Male", ""]),
                    rng.randint(1, 80),
                    rng.choice([0, 0, 1]),
                    0,
                    rng.choice(["never", "current", "No Info"]),
                    "" if i % 10 == 0 else 500 if i == 1 else round(rng.uniform(17, 40), 1),
                    round(rng.uniform(4, 9), 1),
                    glucose,
                    int(glucose > 150),
                ]
            )
    return file


def test_prepare_train_stream_and_summarise(spark, raw_csv, path):
    done = prepare(spark, raw_csv, f"{path}/out")
    assert done.rows == 400
    missing = {r["column"]: r["missing"] for r in done.missing.collect()}
    assert missing["bmi"] == 40 and missing["gender"] > 0 and missing["age"] == 0
    cleaned = spark.read.parquet(done.cleaned_path)
    assert cleaned.where("bmi IS NULL OR gender IS NULL").count() == 0
    assert cleaned.agg(F.max("bmi")).first()[0] < 100
    assert spark.read.parquet(done.features_path).columns == ["features", "diabetes"]
    assert spark.read.option("header", True).csv(done.csv_path).count() == 400

    rows = cleaned.withColumn("id", F.xxhash64(*cleaned.columns))
    small = {"RandomForest": lambda label: forest(label, numTrees=5, maxDepth=3), "LogisticRegression": logistic}
    comparison = compare_models(rows, load_model(done.feature_model_path), "id", small)
    saved = save_comparison(comparison, f"{path}/models", f"{path}/best")

    replay(to_messages(rows, "id"), f"{path}/inbox", files=4)
    raw = read_file_stream(spark, f"{path}/inbox", to_messages(rows, "id").schema, max_files=2)
    stream = stamped(parse_messages(raw, keep=("key",)))
    model = load_model(saved[comparison.best])
    start_scoring(
        stream, partial(write_batch_parquet, root=f"{path}/scored"), f"{path}/cp", model, ("key",)
    ).awaitTermination()
    table = spark.read.parquet(f"{path}/scored")
    direct = {r["id"]: r["predicted_diabetes"] for r in score(rows, model).collect()}
    assert {int(r["key"]): r["predicted_diabetes"] for r in table.collect()} == direct

    found = summaries(enriched(table))
    assert found["headline"].first()["n"] == table.count()
    assert sum(column(found["risk_levels"], "n")) == table.count()


def test_without_database_a_batch_goes_to_csv(spark, path):
    options = jdbc_options("jdbc:nothing://none", "u", "p", "no.such.Driver")
    sink = database_or_csv(options, "predictions", "id", f"{path}/csv")
    assert sink(spark.range(3), 5) == "fallback"
    assert spark.read.option("header", True).csv(f"{path}/csv/batch_id=5").count() == 3


# --- physical plans -------------------------------------------------------------------------


BATCH = sorted(
    set(entry_module.queries())
    - {"forest_metrics", "logistic_metrics", "model_comparison", "best_predictions", "score_stream_model", "cv_best"}
)


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python_rows(spark, sf_dir, name):
    plan = entry_module.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("messages_per_partition", {"event_id"}),
        ("daily_trend", {"ts"}),
        ("order_status_share", {"o_orderstatus", "o_orderpriority"}),
        ("risk_level_distribution", {"event_id", "user_id", "event_type", "value"}),
        ("age_decade_mode", {"event_id", "user_id"}),
    ],
)
def test_only_needed_columns_are_read(spark, sf_dir, name, columns):
    plan = entry_module.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    read = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {part.split(":")[0] for part in read.split(",")} == columns


def test_session_filter_reaches_the_scan(spark, sf_dir):
    plan = entry_module.queries()["session_predictions"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts," in plan


# --- rows scored elsewhere ------------------------------------------------------------------


@pytest.mark.skipif("SCORED_CSV_DIR" not in os.environ, reason="SCORED_CSV_DIR names a folder of scored CSV batches")
def test_rule_classifier_reproduces_scored_batches(spark):
    folders = glob.glob(os.environ["SCORED_CSV_DIR"] + "/*")
    frame = spark.read.option("header", True).option("inferSchema", True).csv(folders)
    given = frame.withColumnRenamed("predicted_diabetes", "given")
    assert given.count() > 0 and score(given).where("predicted_diabetes <> given").count() == 0


def test_publish_takes_categories_from_the_original(spark, path):
    spark.createDataFrame([(1, 20.0), (2, 30.0)], "id long, bmi double").write.csv(f"{path}/o", header=True)
    rows = [(7, "Female", "never"), (9, "Male", "current")]
    original = spark.createDataFrame(rows, "n long, gender string, smoking_history string")
    sent = []
    publish(spark, [f"{path}/o"], "id", sent.append, "id long, bmi double", F.lit(9), original, ("id", "n"))
    found = {r["key"]: r["gender"] for r in parse_messages(sent[0], keep=("key",)).collect()}
    assert found == {"1": "Female", "2": "Male"}


def test_serve_bounds_its_batches(spark, monkeypatch):
    seen = {}

    def no_broker(spark, servers, topic, **options):
        seen.update(options)
        raise ConnectionError

    monkeypatch.setattr(serving, "read_kafka", no_broker)
    with pytest.raises(ConnectionError):
        serving.serve(spark, "h:9092", "t", None, "c", per_batch=50)
    assert seen == {"maxOffsetsPerTrigger": "50"}


def test_publish_completes_and_encodes_rows(spark, path):
    spark.createDataFrame([(1, 30.5), (2, None)], "id long, bmi double").write.option("header", True).csv(f"{path}/p")
    sent = []
    publish(spark, [f"{path}/absent", f"{path}/p"], "id", sent.append, "id long, bmi double", F.lit(9))
    rows = {r["key"]: r for r in parse_messages(sent[0], keep=("key",)).collect()}
    assert rows["1"]["bmi"] == 30.5 and rows["2"]["bmi"] is None
    assert rows["1"]["gender"] == "Female" and rows["1"]["timestamp"] == 9


def test_categories_come_from_the_original_rows(spark):
    prepared = spark.createDataFrame([(5, 1.0), (6, 2.0)], "id long, bmi double")
    original = spark.createDataFrame([(1, "Male", "former"), (2, "Other", "ever")], "row long, gender string, smoking_history string")
    rows = message_rows(prepared, original, ("id", "row")).orderBy("id").collect()
    assert [(r["gender"], r["smoking_history"], r["age"]) for r in rows] == [("Male", "former", 0.0), ("Other", "ever", 0.0)]
