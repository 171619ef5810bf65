"""Agreement between a predicted and an actual 0/1 column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.bands import HBA1C_BANDS, band_of
from riskloom.functions.nulls import count_if, ratio, same

ACTUAL = "actual_diabetes"
PREDICTED = "predicted_diabetes"


def with_match(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction_match", same(F.col(ACTUAL), F.col(PREDICTED)))


def correct_only(df: DataFrame) -> DataFrame:
    return df.where(F.col(ACTUAL) == F.col(PREDICTED))


def batch_accuracy(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """n, correct and accuracy in one pass."""
    return (
        df.groupBy(*by)
        .agg(
            F.count("*").alias("n"),
            count_if(same(F.col(ACTUAL), F.col(PREDICTED))).alias("correct"),
        )
        .withColumn("accuracy", ratio(F.col("correct"), F.col("n")))
    )


def _confusion(df: DataFrame, by: Sequence[str]) -> DataFrame:
    actual, predicted = F.col(ACTUAL), F.col(PREDICTED)
    return df.groupBy(*by).agg(
        F.count("*").alias("n"),
        count_if((predicted == 1) & (actual == 1)).alias("tp"),
        count_if((predicted == 0) & (actual == 0)).alias("tn"),
        count_if((predicted == 1) & (actual == 0)).alias("fp"),
        count_if((predicted == 0) & (actual == 1)).alias("fn"),
    )


def confusion(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """tp, tn, fp, fn; rows with a NULL side are in none of them."""
    return _confusion(df, by).drop("n")


def classification_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Percentages except `f1`, which is in 0..1. Accuracy divides by all rows; 0/0 is 0."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    hundred = F.lit(100.0)
    precision, recall = F.col("precision_pct"), F.col("recall_pct")
    return (
        _confusion(df, by)
        .withColumns(
            {
                "accuracy_pct": ratio(tp + tn, F.col("n")) * hundred,
                "precision_pct": ratio(tp, tp + fp) * hundred,
                "recall_pct": ratio(tp, tp + fn) * hundred,
                "specificity_pct": ratio(tn, tn + fp) * hundred,
            }
        )
        .withColumn("f1", ratio(2 * precision * recall, precision + recall) / hundred)
        .select(*by, "n", "accuracy_pct", "precision_pct", "recall_pct", "f1", "specificity_pct")
    )


def weighted_metrics(df: DataFrame, label: str = ACTUAL, prediction: str = PREDICTED) -> DataFrame:
    """accuracy and class-weighted precision, recall and F1 from one count per (label, prediction).

    After the first aggregation only a row per pair of classes is left.
    """
    pairs = (
        df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
        .groupBy(F.col(label).cast("double").alias("y"), F.col(prediction).cast("double").alias("p"))
        .agg(F.count("*").alias("n"))
    )
    sides = F.array(
        F.struct(F.col("y").alias("cls"), F.col("n").alias("actual"), F.lit(0).alias("predicted")),
        F.struct(F.col("p").alias("cls"), F.lit(0).alias("actual"), F.col("n").alias("predicted")),
    )
    hit = F.when((F.col("y") == F.col("p")) & (F.col("side.actual") > 0), F.col("n")).otherwise(0)
    per_class = (
        pairs.withColumn("side", F.explode(sides))
        .groupBy("side.cls")
        .agg(
            F.sum("side.actual").alias("actual"),
            F.sum("side.predicted").alias("predicted"),
            F.sum(hit).alias("hit"),
        )
        .withColumns(
            {
                "precision": ratio(F.col("hit"), F.col("predicted")),
                "recall": ratio(F.col("hit"), F.col("actual")),
            }
        )
        .withColumn(
            "class_f1",
            ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
        )
    )
    total = F.sum("actual")
    return per_class.agg(
        ratio(F.sum("hit"), total).alias("accuracy"),
        ratio(F.sum(F.col("precision") * F.col("actual")), total).alias("weighted_precision"),
        ratio(F.sum(F.col("recall") * F.col("actual")), total).alias("weighted_recall"),
        ratio(F.sum(F.col("class_f1") * F.col("actual")), total).alias("f1"),
    )


def headline(df: DataFrame) -> DataFrame:
    """n, positive, positive_pct, correct."""
    return (
        df.agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum(F.col(PREDICTED).cast("long")), F.lit(0).cast("long")).alias("positive"),
            count_if(same(F.col(ACTUAL), F.col(PREDICTED))).alias("correct"),
        )
        .withColumn("positive_pct", ratio(F.col("positive"), F.col("n")) * 100.0)
        .select("n", "positive", "positive_pct", "correct")
    )


def accuracy_by_hba1c_band(df: DataFrame) -> DataFrame:
    """Accuracy and recall per HbA1c band; the borderline band is the hard one."""
    banded = df.withColumn("band", band_of(F.col("HbA1c_level"), HBA1C_BANDS, otherwise="unknown"))
    return classification_metrics(banded, ["band"]).select("band", "n", "accuracy_pct", "recall_pct")
