"""Classifiers, their evaluation and model-or-rules scoring."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from riskloom.functions.rules import rule_prediction
from riskloom.operators.metrics import PREDICTED, weighted_metrics
from riskloom.schema import LABEL

PARTITIONS = 64  # of the rows that classifiers are fitted on
METRICS = ("accuracy", "auc", "precision", "recall", "f1")


def forest(label: str = LABEL, **params) -> RandomForestClassifier:
    # 100 trees, depth 10, seed 42.
    settings = {"numTrees": 100, "maxDepth": 10, "seed": 42, **params}
    return RandomForestClassifier(labelCol=label, featuresCol="features", **settings)


def logistic(label: str = LABEL, **params) -> LogisticRegression:
    # 20 iterations, L2 penalty 0.1.
    settings = {"maxIter": 20, "regParam": 0.1, **params}
    return LogisticRegression(labelCol=label, featuresCol="features", **settings)


def spread(df: DataFrame) -> DataFrame:
    """At least one partition per core: rows of few files would keep the other cores idle.

    For scoring micro-batches only, which gives each row the same result wherever it lies.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """The rows cached while they are read over and over."""
    rows = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def dealt(df: DataFrame, key: str, partitions: int = PARTITIONS) -> DataFrame:
    """Rows in a fixed number of partitions by a hash of their unique key, in its order.

    A forest draws each tree's rows partition by partition, so where a row lies decides which trees learn from it.
    Dealt like this, the same rows give the same forest whatever files and cores there are.
    """
    return df.repartition(partitions, F.xxhash64(key)).sortWithinPartitions(key)


def training_rows(
    train: DataFrame, features: PipelineModel, label: str = LABEL, key: str | None = None, partitions: int = PARTITIONS
) -> DataFrame:
    """Only the columns that fitting reads, dealt by `key` if there is one."""
    rows = train if key is None else dealt(train.select(key, *_inputs(features), label), key, partitions)
    return rows.select(*_inputs(features), label)


def fit_classifier(features: PipelineModel, classifier, rows: DataFrame) -> PipelineModel:
    """Feature stages plus classifier as one model that loads and scores on its own.

    When scoring, a missing number goes through as NaN; a fit refuses it.
    """
    *indexers, assembler = features.stages
    lenient = assembler.copy().setHandleInvalid("keep")
    return Pipeline(stages=[*indexers, lenient, classifier]).fit(rows)


def _inputs(features: PipelineModel) -> list[str]:
    """Raw columns the feature stages read."""
    made = {s.getOutputCol() for s in features.stages}
    read = [c for s in features.stages for c in (s.getInputCols() if s.isSet("inputCols") else [s.getInputCol()])]
    return [c for c in dict.fromkeys(read) if c not in made]


def area_under_roc(df: DataFrame, score: str, label: str = LABEL) -> float:
    """Chance that a positive row scores above a negative one, a tie counting half."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=score, numBins=0).evaluate(df)


def evaluate(predictions: DataFrame, model: str, label: str = LABEL) -> DataFrame:
    """One row: model, accuracy, auc, weighted precision and recall, f1.

    The four class metrics come from one count per (label, prediction).
    """
    slim = predictions.select(label, "prediction", "rawPrediction").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        auc = area_under_roc(slim, "rawPrediction", label)
        row = weighted_metrics(slim, label, "prediction").first()
    finally:
        slim.unpersist()
    values = (model, row["accuracy"], auc, row["weighted_precision"], row["weighted_recall"], row["f1"])
    return predictions.sparkSession.createDataFrame(
        [values], "model string, " + ", ".join(f"{m} double" for m in METRICS)
    )


def model_comparison(metrics: Sequence[DataFrame], by: str = "accuracy", digits: int = 4) -> DataFrame:
    """All metric rows with `is_best`; the first model wins a tie."""
    ranked = [m.withColumn("rank", F.lit(i)) for i, m in enumerate(metrics)]
    table = ranked[0]
    for more in ranked[1:]:
        table = table.unionByName(more)
    order = Window.orderBy(F.col(by).desc(), F.col("rank"))
    rounded = [F.round(m, digits).alias(m) for m in METRICS]
    return table.withColumn("is_best", F.row_number().over(order) == 1).select("model", *rounded, "is_best")


def best_model(comparison: DataFrame) -> str:
    return comparison.where("is_best").first()["model"]


def positive_probability(probability: Column | str = "probability") -> Column:
    """Second entry of the probability vector, 0 when there is none."""
    return F.coalesce(F.get(vector_to_array(probability), F.lit(1)), F.lit(0.0))


def scored_holdout(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    """(label, prediction, <label>_probability) rows of the chosen model."""
    return predictions.select(label, "prediction", positive_probability().alias(f"{label}_probability"))


def with_prediction_name(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("prediction", PREDICTED)


def score(df: DataFrame, model: Transformer | None = None) -> DataFrame:
    """Predictions of the fitted model, or of the rules when there is no model."""
    if model is None:
        return df.withColumn(PREDICTED, rule_prediction())
    predicted = with_prediction_name(model.transform(df))
    return predicted.withColumn(PREDICTED, F.col(PREDICTED).cast("int"))


def cross_validate(
    features: PipelineModel,
    train: DataFrame,
    label: str = LABEL,
    penalties: Sequence[float] = (0.01, 0.1),
    folds: int = 3,
    fold_column: str | None = None,
) -> DataFrame:
    """(reg_param, avg_accuracy, is_best) of a logistic regression over a grid of penalties."""
    classifier = logistic(label)
    grid = ParamGridBuilder().addGrid(classifier.regParam, list(penalties)).build()
    validator = CrossValidator(
        estimator=classifier,
        estimatorParamMaps=grid,
        evaluator=MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy"),
        numFolds=folds,
        seed=42,
        parallelism=2,
        foldCol=fold_column or "",
    )
    kept = ["features", label] + ([fold_column] if fold_column else [])
    with cached(features.transform(train).select(kept)) as prepared:
        averages = validator.fit(prepared).avgMetrics
    best = max(range(len(averages)), key=averages.__getitem__)
    rows = [(float(p), float(a), i == best) for i, (p, a) in enumerate(zip(penalties, averages, strict=True))]
    return train.sparkSession.createDataFrame(rows, "reg_param double, avg_accuracy double, is_best boolean")
