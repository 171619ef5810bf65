import random

import pytest
from helpers import column, events
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskloom.operators import models
from riskloom.operators.features import fit_features
from riskloom.plans.training import compare_models, save_comparison
from riskloom.sinks.files import save_model
from riskloom.sources.files import load_model, read_csv


@pytest.fixture(scope="module")
def patients(spark):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        glucose = rng.uniform(80, 220)
        rows.append(
            {
                "gender": rng.choice(["Female", "Male"]),
                "smoking_history": rng.choice(["never", "current", "former"]),
                "blood_glucose_level": glucose,
                "HbA1c_level": rng.uniform(4, 9),
                "diabetes": int(glucose + rng.gauss(0, 10) > 150),
                "timestamp": i,
            }
        )
    return events(spark, *rows).cache()


SMALL = {
    "RandomForest": lambda label: models.forest(label, numTrees=5, maxDepth=3),
    "LogisticRegression": models.logistic,
}


@pytest.fixture(scope="module")
def comparison(patients):
    return compare_models(patients, fit_features(patients), "timestamp", SMALL)


def test_defaults(spark):
    assert models.forest().getNumTrees() == 100 and models.forest().getMaxDepth() == 10
    assert models.logistic().getMaxIter() == 20 and models.logistic().getRegParam() == 0.1


def test_comparison(comparison):
    rows = comparison.table.collect()
    assert [r["model"] for r in rows if r["is_best"]] == [comparison.best]
    assert all(r["accuracy"] > 0.8 for r in rows)
    assert comparison.best_predictions().count() == comparison.holdout.count()


def test_rows_without_label_are_left_out(spark, patients):
    some = patients.unionByName(events(spark, {"diabetes": None, "timestamp": 10**6}))
    found = compare_models(some, fit_features(some), "timestamp", {"LogisticRegression": models.logistic})
    assert found.best_predictions().where("diabetes IS NULL").count() == 0


def test_first_model_wins_a_tie(spark):
    schema = "model string, accuracy double, auc double, precision double, recall double, f1 double"
    tied = [spark.createDataFrame([(name, 0.5, 0.1, 0.1, 0.1, 0.1)], schema) for name in ("zeta", "alpha")]
    assert models.best_model(models.model_comparison(tied)) == "zeta"


def test_saved_model_scores_raw_rows_on_its_own(spark, patients, comparison, path):
    saved = save_comparison(comparison, f"{path}/models", f"{path}/best")
    assert set(saved) == set(SMALL) and "randomforest_model_" in saved["RandomForest"]
    loaded = load_model(saved["RandomForest"])
    one = models.score(patients.limit(1), loaded)
    many = models.score(patients, comparison.models["RandomForest"])
    assert dict(one.dtypes)["predicted_diabetes"] == "int"
    key = one.first()["timestamp"]
    assert one.first()["predicted_diabetes"] == many.where(F.col("timestamp") == key).first()["predicted_diabetes"]
    written = read_csv(spark, f"{path}/best")
    assert written.columns == ["diabetes", "prediction", "diabetes_probability"]
    assert written.count() == comparison.holdout.count()


def test_unusable_models_fall_back_to_the_rules(spark, patients, path):
    assert load_model(f"{path}/none") is None
    bare = LogisticRegression(labelCol="diabetes", maxIter=1).fit(fit_features(patients).transform(patients))
    bare.write().overwrite().save(f"{path}/bare")
    assert load_model(f"{path}/bare") is None
    assert models.score(events(spark, {"age": 70.0}), load_model(f"{path}/bare")).first()["predicted_diabetes"] == 1


def test_scoring_takes_missing_and_unseen_values(spark, comparison):
    frame = events(spark, {"bmi": None, "gender": "new", "smoking_history": None})
    row = models.score(frame, comparison.models["RandomForest"]).first()
    assert row["predicted_diabetes"] in (0, 1)


def test_model_from_strict_features_still_scores_missing_values(spark, patients):
    strict = fit_features(patients, handle_invalid="error")
    model = models.fit_classifier(strict, models.logistic(), patients)
    assert models.score(events(spark, {"bmi": None}), model).count() == 1
    with pytest.raises(Exception, match="NaN"):
        models.fit_classifier(strict, models.logistic(), patients.withColumn("bmi", F.lit(None).cast("double")))


def test_positive_probability(spark):
    frame = spark.createDataFrame([(Vectors.dense([0.3, 0.7]),), (Vectors.dense([1.0]),)], ["probability"])
    assert column(frame.select(models.positive_probability().alias("p")), "p") == [0.7, 0.0]


def test_cross_validation_marks_the_best(patients):
    rows = models.cross_validate(fit_features(patients), patients, penalties=(0.01, 10.0)).collect()
    assert max(rows, key=lambda r: r["avg_accuracy"])["is_best"] and len(rows) == 2


def test_model_path(patients, comparison, path):
    assert save_model(comparison.models["LogisticRegression"], path, "Best", "r1") == f"{path}/best_model_r1"
