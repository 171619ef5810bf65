"""A store of mergeable summaries: every micro-batch adds its cells, readers add the cells up.

A cell is one combination of the categories below, with the number of rows and, per measure, its sum and its number of values.
Cells merge by addition, so any summary over some of the categories comes from them without the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.functions.bands import age_band
from riskloom.functions.nulls import nan_to_null
from riskloom.operators import metrics, profile
from riskloom.sinks.files import write_batch_parquet
from riskloom.streaming.scoring import start_scoring

CELLS = ("gender", "age_group", "risk_level", "hour", "actual_diabetes", "predicted_diabetes", "prediction_match")
MEASURES = ("age", "bmi", "HbA1c_level", "blood_glucose_level", "risk_score")


def cells(scored: DataFrame, by: Sequence[str] = CELLS, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Scored rows as cells: (*by, n, <measure>_sum, <measure>_n)."""
    rows = profile.with_risk(metrics.with_match(scored))
    rows = rows.withColumns({"hour": F.hour("processing_time"), "age_group": age_band(F.col("age"))})
    sums = [F.sum(nan_to_null(F.col(m).cast("double"))).alias(f"{m}_sum") for m in measures]
    counts = [F.count(nan_to_null(F.col(m).cast("double"))).alias(f"{m}_n") for m in measures]
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *sums, *counts)


def merged(found: DataFrame, by: Sequence[str] = CELLS, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Cells of the same categories added up."""
    parts = ["n", *[f"{m}_sum" for m in measures], *[f"{m}_n" for m in measures]]
    return found.groupBy(*by).agg(*[F.sum(p).alias(p) for p in parts])


def start_summaries(
    events: DataFrame, root: str, checkpoint: str, model=None, every: str | None = "3 seconds"
) -> StreamingQuery:
    """Score a stream and keep its summaries fresh: the cells of each micro-batch under root/batch_id=N."""

    def sink(scored: DataFrame, batch_id: int) -> None:
        write_batch_parquet(cells(scored), batch_id, root)

    return start_scoring(events, sink, checkpoint, model, every=every)


def read_cells(spark: SparkSession, root: str) -> DataFrame:
    """All batches' cells, merged."""
    return merged(spark.read.option("basePath", root).parquet(root))


def compact_cells(spark: SparkSession, root: str, target: str) -> None:
    """The cells of all batches but the last in one folder under a new root; the last keeps its own, as it may be replayed."""
    found = spark.read.option("basePath", root).parquet(root)
    last = found.agg(F.max("batch_id")).first()[0]
    earlier = found.where(F.col("batch_id") < last)
    if not earlier.isEmpty():
        write_batch_parquet(merged(earlier), last - 1, target)
    write_batch_parquet(found.where(F.col("batch_id") == last).drop("batch_id"), last, target)


def summary(found: DataFrame, by: Sequence[str], measures: Sequence[str] = MEASURES) -> DataFrame:
    """(*by, n, correct, share, avg_<measure>) from cells; share is the part of all rows in percent."""
    rows = found.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("prediction_match"), F.col("n"))), F.lit(0)).alias("correct"),
        *[F.try_divide(F.sum(f"{m}_sum"), F.sum(f"{m}_n")).alias(f"avg_{m}") for m in measures],
    )
    return rows.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()) * 100.0)


#: The dashboard's grouped summaries by name.
SUMMARIES = {
    "risk_levels": ("risk_level",),
    "age_groups": ("age_group",),
    "gender_risk": ("gender", "risk_level"),
    "hourly": ("hour",),
    "confusion": ("actual_diabetes", "predicted_diabetes"),
}


def refreshed(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every grouped summary as of the batches written so far, lazily."""
    found = read_cells(spark, root)
    return {name: summary(found, by) for name, by in SUMMARIES.items()}
