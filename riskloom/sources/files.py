"""File sources for batches and streams, and saved models."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.nulls import integral
from riskloom.streaming.counts import latest_counts, message_totals

log = logging.getLogger(__name__)

ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with header. With a schema, its columns that the header names, whatever their order in the file.

    Values are cast one by one: whole numbers may be written as `1.0`, and what does not fit is NULL. A column
    that the header lacks is left out. Inferring a schema reads the data twice.
    """
    reader = spark.read.option("header", True)
    if not schema:
        return reader.option("inferSchema", True).csv(path)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = reader.csv(path)
    named = {c.lower(): c for c in text.columns}
    return text.select(*[_typed(named[f.name.lower()], f) for f in wanted if f.name.lower() in named])


def _typed(name: str, field: T.StructField) -> Column:
    value = F.col(f"`{name}`")
    if isinstance(field.dataType, T.IntegerType):
        return integral(value.try_cast("double")).alias(field.name)
    return value.try_cast(field.dataType).alias(field.name)


def read_csv_or(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """The first of several CSV folders or files that exists, with all its part files."""
    for path in paths:
        try:
            return read_csv(spark, path, schema)
        except AnalysisException as error:
            if error.getCondition() not in ABSENT:
                raise
            log.warning("no CSV at %s", path)
    raise FileNotFoundError(f"none of {list(paths)} exists")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files: int = 1000,
    file_format: str = "parquet",
) -> DataFrame:
    """A folder (or glob) replayed as a stream, `max_files` files per micro-batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    return reader.format(file_format).load(path)


def read_counter(spark: SparkSession, root: str) -> DataFrame:
    """Message counter (total, per_min) from the counts a stream has written; zeros before that."""
    try:
        minutes = latest_counts(spark, root, ["window_start"])
    except AnalysisException as error:
        if error.getCondition() not in ABSENT:
            raise
        return spark.sql("SELECT 0L AS total, 0L AS per_min")
    return message_totals(minutes)


def load_model(path: str) -> PipelineModel | None:
    """The saved model, or None (with a warning) when it cannot be loaded."""
    try:
        return PipelineModel.load(path)
    except Exception as error:  # missing path, other class, damaged files
        log.warning("no usable model at %s: %s", path, error)
        return None
