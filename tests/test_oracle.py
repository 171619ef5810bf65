"""Every query with checking SQL, compared value by value on the test tables."""

import oracle
import pytest

import __spark_entry__ as entry_module

QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_checks_belong_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert [r["risk_level"] for r in rows] == ["high", "moderate", "low", "very_low"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, sf_dir, name):
    assert oracle.difference(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_model_queries(spark, sf_dir):
    table = QUERIES["model_comparison"](spark, sf_dir).collect()
    assert [r["model"] for r in table] and sum(r["is_best"] for r in table) == 1
    assert all(0.5 < r[m] <= 1 for r in table for m in ("accuracy", "auc", "precision", "recall", "f1"))
    forest = QUERIES["forest_metrics"](spark, sf_dir).first()
    assert forest["accuracy"] == next(r["accuracy"] for r in table if r["model"] == forest["model"])
    assert QUERIES["logistic_metrics"](spark, sf_dir).count() == 1
    best = QUERIES["best_predictions"](spark, sf_dir)
    assert best.columns == ["diabetes", "prediction", "diabetes_probability"]
    assert best.where("diabetes_probability NOT BETWEEN 0 AND 1").count() == 0
    streamed = QUERIES["score_stream_model"](spark, sf_dir)
    assert streamed.count() == spark.read.parquet(f"{sf_dir}/events.parquet").count()
    grid = QUERIES["cv_best"](spark, sf_dir).collect()
    assert max(grid, key=lambda r: r["avg_accuracy"])["is_best"]
