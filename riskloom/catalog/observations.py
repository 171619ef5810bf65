"""The tables as clinical observations: one fixed view over `events`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators.metrics import with_match
from riskloom.operators.models import score
from riskloom.operators.profile import with_risk
from riskloom.schema import to_scored_rows

# Valid in Spark SQL and in the checking engine alike.
OBSERVATION_COLUMNS = (
    "event_id AS obs_id",
    "ts AS processing_time",
    "user_id AS patient_id",
    "CASE WHEN event_id % 50 = 0 THEN 'Other' WHEN user_id % 5 < 3 THEN 'Female' ELSE 'Male' END AS gender",
    "CAST((user_id * 7 + event_id * 3) % 81 AS DOUBLE) AS age",
    "CASE WHEN (user_id * 7 + event_id) % 13 = 0 THEN 1 ELSE 0 END AS hypertension",
    "CASE WHEN (user_id * 11 + event_id) % 25 = 0 THEN 1 ELSE 0 END AS heart_disease",
    """CASE event_type WHEN 'view' THEN 'never' WHEN 'click' THEN 'current'
       WHEN 'signup' THEN 'former' WHEN 'purchase' THEN 'No Info' ELSE NULL END AS smoking_history""",
    """CASE WHEN event_id % 17 = 0 THEN NULL
       ELSE CAST(15 + (event_id * 13 + user_id) % 30 AS DOUBLE) + value / 100.0 END AS bmi""",
    "CAST(35 + (event_id * 19 + user_id * 5) % 56 AS DOUBLE) / 10.0 AS hba1c_level",
    "CAST(80 + (event_id * 37 + user_id * 3) % 100 AS DOUBLE) + value AS blood_glucose_level",
    """CASE WHEN (event_id * 19 + user_id * 5) % 56 >= 28
        AND (event_id * 37 + user_id * 3) % 100 >= 40 THEN 1 ELSE 0 END AS diabetes""",
)

# Checking SQL: observations, and the scored ones written out independently of the rule tables.
OBS = f"WITH obs AS (SELECT {', '.join(OBSERVATION_COLUMNS)} FROM events)"
SCORED = (
    OBS
    + """, points AS (
  SELECT *,
    diabetes AS actual_diabetes,
    CASE WHEN blood_glucose_level > 140 AND hba1c_level > 6.5 THEN 1
         WHEN blood_glucose_level > 125 AND hba1c_level > 6.0 AND bmi > 30 THEN 1
         WHEN age > 65 THEN 1 ELSE 0 END AS predicted_diabetes,
    (CASE WHEN bmi >= 30 THEN 3 WHEN bmi >= 25 THEN 2 WHEN bmi >= 23 THEN 1 ELSE 0 END
     + CASE WHEN blood_glucose_level >= 180 THEN 4 WHEN blood_glucose_level >= 140 THEN 3
            WHEN blood_glucose_level >= 100 THEN 1 ELSE 0 END
     + CASE WHEN hba1c_level >= 6.5 THEN 4 WHEN hba1c_level >= 5.7 THEN 2 ELSE 0 END
     + CASE WHEN age >= 65 THEN 2 WHEN age >= 45 THEN 1 ELSE 0 END
     + CASE WHEN hypertension = 1 THEN 2 ELSE 0 END
     + CASE WHEN heart_disease = 1 THEN 2 ELSE 0 END
     + CASE WHEN smoking_history IN ('current', 'former') THEN 1 ELSE 0 END) AS risk_score
  FROM obs
), scored AS (
  SELECT *,
    COALESCE(actual_diabetes = predicted_diabetes, FALSE) AS prediction_match,
    CASE WHEN risk_score >= 10 THEN 'high' WHEN risk_score >= 6 THEN 'moderate'
         WHEN risk_score >= 3 THEN 'low' ELSE 'very_low' END AS risk_level,
    CASE WHEN age > 0 AND age <= 30 THEN '<30' WHEN age > 30 AND age <= 40 THEN '30-40'
         WHEN age > 40 AND age <= 50 THEN '40-50' WHEN age > 50 AND age <= 60 THEN '50-60'
         WHEN age > 60 AND age <= 70 THEN '60-70' WHEN age > 70 AND age <= 100 THEN '70+' END AS age_band
  FROM points
)"""
)
LEVELS_SQL = "(VALUES ('high', 0), ('moderate', 1), ('low', 2), ('very_low', 3)) AS lv(risk_level, severity)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observed(events: DataFrame) -> DataFrame:
    """The observation view over any batch or stream of events."""
    return events.selectExpr(*OBSERVATION_COLUMNS)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observed(table(spark, sf_dir, "events"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule-scored rows in the scored layout, with their id and patient."""
    return to_scored_rows(score(observations(spark, sf_dir)), keep=("obs_id", "patient_id"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows with match flag, risk score and level."""
    return with_risk(with_match(predictions(spark, sf_dir)))
