"""Batch preparation: CSV to a cleaned table, feature table and CSV copy."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.features import fit_features
from riskloom.operators.prep import ensure_columns, impute, iqr_clip, missing_counts
from riskloom.schema import (
    CATEGORICAL,
    CONTINUOUS,
    EVENT_SCHEMA,
    FEATURES,
    LABEL,
    NUMERIC_FEATURES,
    REQUIRED_DEFAULTS,
    normalize_nulls,
)
from riskloom.session import run_dir
from riskloom.sinks.files import save_model, verify_output, write_csv, write_parquet
from riskloom.sources.files import read_csv

RAW_SCHEMA = T.StructType([f for f in EVENT_SCHEMA if f.name != "timestamp"])


@dataclass(frozen=True)
class Prepared:
    rows: int
    missing: DataFrame
    cleaned_path: str
    features_path: str
    csv_path: str
    feature_model_path: str


def clean(raw: DataFrame, exact: bool = False) -> DataFrame:
    """Impute every column, then clip the continuous ones."""
    numeric = [c for c in NUMERIC_FEATURES if c in raw.columns]
    filled = impute(raw, CATEGORICAL, numeric)
    return iqr_clip(filled, CONTINUOUS, exact=exact)


def prepare(
    spark: SparkSession,
    csv_path: str,
    out: str,
    schema: T.StructType | None = RAW_SCHEMA,
    exact: bool = False,
) -> Prepared:
    """Run the preparation and write cleaned, features, csv and the feature model under `out`.

    The text is parsed once into a columnar staging table; every statistic after that reads
    only its own columns.
    """
    staging = run_dir(spark, "staging")
    write_parquet(normalize_nulls(read_csv(spark, csv_path, schema)), staging)
    raw = spark.read.parquet(staging)
    if LABEL.lower() not in [c.lower() for c in raw.columns]:
        raise ValueError(f"{csv_path} has no column {LABEL}, and labels are never made up")
    raw = ensure_columns(raw, REQUIRED_DEFAULTS)

    write_parquet(clean(raw, exact), f"{out}/cleaned")
    cleaned = spark.read.parquet(f"{out}/cleaned")
    model = fit_features(cleaned, handle_invalid="error")
    featured = model.transform(cleaned)
    write_parquet(featured.select("features", F.col(LABEL)), f"{out}/features")
    write_csv(featured.select(*FEATURES, LABEL), f"{out}/csv")
    rows = verify_output(spark, f"{out}/features", expected=raw.count())
    return Prepared(
        rows=rows,
        missing=missing_counts(raw),
        cleaned_path=f"{out}/cleaned",
        features_path=f"{out}/features",
        csv_path=f"{out}/csv",
        feature_model_path=save_model(model, out, "features"),
    )
