"""Column names, types and defaults shared by every job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.nulls import nan_to_null

# The message layout and the feature order are part of the data contract.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("gender", T.StringType()),
        T.StructField("age", T.DoubleType()),
        T.StructField("hypertension", T.IntegerType()),
        T.StructField("heart_disease", T.IntegerType()),
        T.StructField("smoking_history", T.StringType()),
        T.StructField("bmi", T.DoubleType()),
        T.StructField("HbA1c_level", T.DoubleType()),
        T.StructField("blood_glucose_level", T.DoubleType()),
        T.StructField("diabetes", T.IntegerType()),
        T.StructField("timestamp", T.LongType()),
    ]
)
CATEGORICAL = ("gender", "smoking_history")
CONTINUOUS = ("age", "bmi", "HbA1c_level", "blood_glucose_level")
NUMERIC_FEATURES = (
    "age",
    "hypertension",
    "heart_disease",
    "bmi",
    "HbA1c_level",
    "blood_glucose_level",
)
FEATURES = (*NUMERIC_FEATURES, "gender_indexed", "smoking_history_indexed")
LABEL = "diabetes"
SCORED_COLUMNS = (
    "gender",
    "age",
    "hypertension",
    "heart_disease",
    "smoking_history",
    "bmi",
    "HbA1c_level",
    "blood_glucose_level",
    "actual_diabetes",
    "predicted_diabetes",
    "processing_time",
)
REQUIRED_DEFAULTS = {
    "gender": "Female",
    "age": 0.0,
    "hypertension": 0,
    "heart_disease": 0,
    "smoking_history": "never",
    "bmi": 0.0,
    "HbA1c_level": 0.0,
    "blood_glucose_level": 0.0,
    "diabetes": 0,
}


def normalize_nulls(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every float column, so later steps only meet NULL."""
    floats = {f.name: nan_to_null(F.col(f.name)) for f in df.schema if _is_float(f.dataType)}
    return df.withColumns(floats) if floats else df


def _is_float(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.FloatType, T.DoubleType))


def to_scored_rows(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The scored layout: inputs, label renamed to `actual_diabetes`, prediction, time."""
    columns = [
        F.col(LABEL).alias("actual_diabetes") if name == "actual_diabetes" else F.col(name)
        for name in SCORED_COLUMNS
    ]
    return df.select(*keep, *columns)
