"""Model comparison: split, fit, evaluate, keep the best."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.features import hash_split
from riskloom.operators.models import (
    PARTITIONS,
    best_model,
    cached,
    evaluate,
    fit_classifier,
    forest,
    logistic,
    model_comparison,
    scored_holdout,
    training_rows,
)
from riskloom.schema import LABEL
from riskloom.sinks.files import run_id, save_model, write_csv

CLASSIFIERS = {"RandomForest": forest, "LogisticRegression": logistic}


@dataclass(frozen=True)
class Comparison:
    models: dict[str, PipelineModel]
    table: DataFrame
    best: str
    holdout: DataFrame

    def best_predictions(self, label: str = LABEL) -> DataFrame:
        return scored_holdout(self.models[self.best].transform(self.holdout), label)


def fit_and_evaluate(
    name: str,
    train: DataFrame,
    holdout: DataFrame,
    features: PipelineModel,
    label: str = LABEL,
    classifiers=CLASSIFIERS,
) -> tuple[PipelineModel, DataFrame]:
    """One classifier fitted on `training_rows`, and its metric row on the holdout."""
    model = fit_classifier(features, classifiers[name](label), train)
    return model, evaluate(model.transform(holdout), name, label)


def compare_models(
    data: DataFrame,
    features: PipelineModel,
    key: str,
    classifiers=CLASSIFIERS,
    label: str = LABEL,
    train_percent: int = 80,
    seed: int = 42,
    partitions: int = PARTITIONS,
) -> Comparison:
    """Fit every classifier on the same hash split of `key` and compare them on the holdout.

    Rows without a label can be neither learned from nor compared with. The models depend on the rows, the seed and
    `partitions` alone.
    """
    labelled = data.where(F.col(label).isNotNull())
    train, holdout = hash_split(labelled, key, train_percent, seed)
    with cached(training_rows(train, features, label, key, partitions)) as rows:
        fitted = {n: fit_and_evaluate(n, rows, holdout, features, label, classifiers) for n in classifiers}
    table = model_comparison([metrics for _, metrics in fitted.values()])
    models = {name: model for name, (model, _) in fitted.items()}
    return Comparison(models, table, best_model(table), holdout)


def save_comparison(comparison: Comparison, models_root: str, csv_path: str, label: str = LABEL) -> dict[str, str]:
    """Save every model under one run id, and the best model's holdout scores as CSV."""
    run = run_id()
    write_csv(comparison.best_predictions(label), csv_path)
    return {name: save_model(model, models_root, name, run) for name, model in comparison.models.items()}
