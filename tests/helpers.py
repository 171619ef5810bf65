"""Hand-made rows."""

from riskloom.schema import EVENT_SCHEMA, SCORED_COLUMNS

SCORED_SCHEMA = (
    "gender string, age double, hypertension int, heart_disease int, smoking_history string, bmi double, "
    "HbA1c_level double, blood_glucose_level double, actual_diabetes int, predicted_diabetes int, "
    "processing_time timestamp"
)
BLANK = {
    "gender": "Female",
    "age": 51.0,
    "hypertension": 0,
    "heart_disease": 0,
    "smoking_history": "ever",
    "bmi": 26.4,
    "HbA1c_level": 7.1,
    "blood_glucose_level": 140.0,
    "diabetes": 0,
    "timestamp": 1_650_000_060,
}


def events(spark, *changes):
    rows = [tuple({**BLANK, **c}[f.name] for f in EVENT_SCHEMA) for c in changes]
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def scored(spark, *changes):
    base = {**BLANK, "actual_diabetes": 0, "predicted_diabetes": 0, "processing_time": None}
    rows = [tuple({**base, **c}[name] for name in SCORED_COLUMNS) for c in changes]
    return spark.createDataFrame(rows, SCORED_SCHEMA)


def column(df, name):
    return [r[name] for r in df.collect()]
