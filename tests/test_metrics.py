import random

import pytest
from helpers import column, scored
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from riskloom.operators import metrics


def pairs(spark, *rows):
    return scored(spark, *[{"actual_diabetes": a, "predicted_diabetes": p} for a, p in rows])


def test_match_is_false_for_null(spark):
    assert column(metrics.with_match(pairs(spark, (None, 1), (1, None), (None, None), (1, 1))), "prediction_match") == [
        False,
        False,
        False,
        True,
    ]


def test_null_labels_count_in_the_accuracy_denominator_only(spark):
    frame = pairs(spark, (1, 1), (0, 0), (None, 1), (None, 0))
    assert metrics.confusion(frame).first().asDict() == {"tp": 1, "tn": 1, "fp": 0, "fn": 0}
    row = metrics.classification_metrics(frame).first()
    assert (row["accuracy_pct"], row["precision_pct"], row["recall_pct"], row["f1"]) == (50.0, 100.0, 100.0, 1.0)


@pytest.mark.parametrize("rows", [[], [(0, 0)], [(1, 0)], [(None, None)]])
def test_zero_denominators_are_zero(spark, rows):
    frame = pairs(spark, *rows) if rows else pairs(spark, (0, 0)).limit(0)
    row = metrics.classification_metrics(frame).first()
    assert row["precision_pct"] == row["recall_pct"] == row["f1"] == 0
    head = metrics.headline(frame).first()
    assert (head["n"], head["positive"], head["positive_pct"]) == (len(rows), 0, 0)


def test_weighted_metrics_equal_the_evaluator(spark):
    rng = random.Random(3)
    rows = [(float(rng.choice([0, 0, 1])), float(rng.choice([0, 1, 1]))) for _ in range(500)]
    frame = spark.createDataFrame(rows, "label double, prediction double")
    mine = metrics.weighted_metrics(frame, "label", "prediction").first()
    for name, theirs in (
        ("accuracy", "accuracy"),
        ("weighted_precision", "weightedPrecision"),
        ("weighted_recall", "weightedRecall"),
        ("f1", "f1"),
    ):
        assert mine[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(frame))
    assert mine["weighted_recall"] == pytest.approx(mine["accuracy"])


def test_weighted_metrics_with_a_class_never_predicted(spark):
    frame = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (2.0, 2.0)], "label double, prediction double")
    mine = metrics.weighted_metrics(frame, "label", "prediction").first()
    theirs = MulticlassClassificationEvaluator(metricName="f1").evaluate(frame)
    assert mine["f1"] == pytest.approx(theirs) and mine["accuracy"] == pytest.approx(2 / 3)


def test_confusion_adds_up_by_group(spark):
    rng = random.Random(4)
    frame = pairs(spark, *[(rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(200)])
    frame = frame.withColumn("day", F.lit(1))
    cells = metrics.confusion(frame, ["day"]).first()
    whole = frame.where("actual_diabetes IS NOT NULL AND predicted_diabetes IS NOT NULL").count()
    assert cells["tp"] + cells["tn"] + cells["fp"] + cells["fn"] == whole
    accuracy = metrics.batch_accuracy(frame, ["day"]).first()
    assert accuracy["correct"] == cells["tp"] + cells["tn"] == metrics.correct_only(frame).count()


def test_hba1c_bands(spark):
    frame = scored(spark, *[{"HbA1c_level": v} for v in (5.6, 5.7, 6.4, 6.5, None)])
    found = {r["band"]: r["n"] for r in metrics.accuracy_by_hba1c_band(frame).collect()}
    assert found == {"normal": 1, "borderline": 2, "high": 1, "unknown": 1}
