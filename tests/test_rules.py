import pytest
from helpers import column, events, scored
from pyspark.sql import functions as F

from riskloom.functions import bands, rules
from riskloom.operators import profile
from riskloom.operators.models import score
from riskloom.schema import normalize_nulls

NAN = float("nan")


def scores(spark, *changes):
    return column(events(spark, *changes).select(rules.risk_score().alias("s")), "s")


def test_maximum_is_computed_from_the_table():
    assert rules.max_score() == 18


def test_sample_row_scores_ten(spark):
    row = profile.with_risk(events(spark, {})).first()
    assert (row["risk_score"], row["risk_level"]) == (10, "high")


@pytest.mark.parametrize(
    ("name", "values", "points"),
    [
        ("bmi", [22.9, 23.0, 24.9, 25.0, 29.9, 30.0, None], [0, 1, 1, 2, 2, 3, 0]),
        ("blood_glucose_level", [99.9, 100.0, 139.9, 140.0, 179.9, 180.0, None], [0, 1, 1, 3, 3, 4, 0]),
        ("HbA1c_level", [5.6, 5.7, 6.4, 6.5, None], [0, 2, 2, 4, 0]),
        ("age", [44.9, 45.0, 64.9, 65.0, None], [0, 1, 1, 2, 0]),
        ("hypertension", [0, 1, None], [0, 2, 0]),
        ("heart_disease", [0, 1, None], [0, 2, 0]),
        ("smoking_history", ["never", "current", "former", "ever", None], [0, 1, 1, 0, 0]),
    ],
)
def test_points_at_every_cut(spark, name, values, points):
    zero = {"bmi": 20.0, "blood_glucose_level": 90.0, "HbA1c_level": 5.0, "age": 20.0}
    assert scores(spark, *[{**zero, name: v} for v in values]) == points


def test_nan_scores_nothing_after_normalising(spark):
    frame = normalize_nulls(events(spark, {"bmi": NAN, "blood_glucose_level": NAN, "HbA1c_level": NAN, "age": NAN}))
    assert column(frame.select(rules.risk_score().alias("s")), "s") == [0]


def test_level_cuts(spark):
    frame = spark.createDataFrame([(n,) for n in (0, 2, 3, 5, 6, 9, 10, 18)], "s int")
    levels = column(frame.select(rules.risk_level(F.col("s")).alias("l")), "l")
    assert levels == ["very_low"] * 2 + ["low"] * 2 + ["moderate"] * 2 + ["high"] * 2


@pytest.mark.parametrize(
    ("change", "expected"),
    [
        ({}, 0),
        ({"blood_glucose_level": 140.1}, 1),
        ({"blood_glucose_level": 140.1, "HbA1c_level": 6.5}, 0),
        ({"blood_glucose_level": 125.1, "HbA1c_level": 6.1, "bmi": 30.1}, 1),
        ({"blood_glucose_level": 125.0, "HbA1c_level": 6.1, "bmi": 30.1}, 0),
        ({"blood_glucose_level": 125.1, "HbA1c_level": 6.0, "bmi": 30.1}, 0),
        ({"blood_glucose_level": 125.1, "HbA1c_level": 6.1, "bmi": 30.0}, 0),
        ({"age": 65.0}, 0),
        ({"age": 65.1}, 1),
        ({"age": 70.0, "blood_glucose_level": None, "HbA1c_level": None, "bmi": None}, 1),
        ({"age": None, "blood_glucose_level": None}, 0),
    ],
)
def test_rule_classifier(spark, change, expected):
    assert column(score(events(spark, change)), "predicted_diabetes") == [expected]


def test_age_bands_are_right_closed(spark):
    ages = [0.0, 0.1, 30.0, 30.1, 70.0, 70.1, 100.0, 100.5, None]
    frame = spark.createDataFrame([(a,) for a in ages], "age double")
    found = column(frame.select(bands.age_band(F.col("age")).alias("b")), "b")
    assert found == [None, "<30", "<30", "30-40", "60-70", "70+", "70+", None, None]


def test_factor_points_add_up_to_the_score(spark):
    frame = events(spark, {}, {"bmi": None, "smoking_history": "former"}, {"age": 80.0}).withColumn(
        "id", F.monotonically_increasing_id()
    )
    points = profile.factor_points(frame, ["id"])
    total = {r["id"]: r["s"] for r in points.groupBy("id").agg(F.sum("points").alias("s")).collect()}
    assert total == {r["id"]: r["risk_score"] for r in profile.with_risk(frame).collect()}
    assert points.where("band = 'unknown'").select("factor").first()["factor"] == "bmi"


def test_flow_counts_every_row_once_per_factor(spark):
    frame = profile.with_risk(scored(spark, {}, {"bmi": None}, {"age": 80.0}, {}))
    per_factor = profile.decision_flow(frame).groupBy("factor").agg(F.sum("n").alias("n"))
    assert {r["n"] for r in per_factor.collect()} == {4}
    assert per_factor.count() == len(rules.RISK_FACTORS)
