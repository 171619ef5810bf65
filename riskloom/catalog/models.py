"""Classifiers, fitted on the hash split of the observations, and the ranking of the risk score."""

from __future__ import annotations

from functools import lru_cache, partial

from pyspark.sql import functions as F

from riskloom.catalog.mechanisms import arriving
from riskloom.catalog.observations import OBS, SCORED, observations, observed, table
from riskloom.catalog.streams import _score
from riskloom.operators import models as ops
from riskloom.operators.dims import local_table
from riskloom.operators.features import fit_features, hash_split
from riskloom.operators.profile import with_risk
from riskloom.plans.preparation import clean
from riskloom.plans.training import CLASSIFIERS, fit_and_evaluate
from riskloom.session import run_dir
from riskloom.sinks.files import save_model, write_batch_parquet
from riskloom.sources.files import load_model
from riskloom.streaming.scoring import start_scoring

STUMP = ("age", "hba1c_level", "hypertension", "heart_disease")


def _state(spark, sf_dir) -> tuple:
    """What tells whether the files are still those a classifier was fitted on."""
    rows = table(spark, sf_dir, "events").select(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_size").alias("size"))
    return tuple(rows.agg(F.count("*"), F.max("time"), F.sum("size")).first())


def _split(spark, sf_dir):
    return _split_of(spark, sf_dir, _state(spark, sf_dir))


def _fitted(spark, sf_dir, name):
    return _fitted_of(spark, sf_dir, name, _state(spark, sf_dir))


@lru_cache(maxsize=4)
def _split_of(spark, sf_dir, state):
    train, holdout = hash_split(clean(observations(spark, sf_dir)), "obs_id")
    return train, holdout, fit_features(train)


@lru_cache(maxsize=8)
def _fitted_of(spark, sf_dir, name, state):
    """A classifier and its metrics, fitted once per session and state of the files."""
    train, holdout, features = _split_of(spark, sf_dir, state)
    with ops.cached(ops.training_rows(train, features, key="obs_id")) as rows:
        return fit_and_evaluate(name, rows, holdout, features)


def forest_metrics(spark, sf_dir):
    return ops.model_comparison([_fitted(spark, sf_dir, "RandomForest")[1]]).drop("is_best")


def logistic_metrics(spark, sf_dir):
    return ops.model_comparison([_fitted(spark, sf_dir, "LogisticRegression")[1]]).drop("is_best")


def model_comparison(spark, sf_dir):
    return ops.model_comparison([_fitted(spark, sf_dir, name)[1] for name in CLASSIFIERS])


def best_predictions(spark, sf_dir):
    model, _ = _fitted(spark, sf_dir, ops.best_model(model_comparison(spark, sf_dir)))
    _, holdout, _ = _split(spark, sf_dir)
    return ops.scored_holdout(model.transform(holdout))


def score_stream_model(spark, sf_dir):
    forest, _ = _fitted(spark, sf_dir, "RandomForest")
    path = save_model(forest, run_dir(spark, "models"), "RandomForest")
    return _score(spark, sf_dir, model=load_model(path))


def cv_best(spark, sf_dir):
    train, _, features = _split(spark, sf_dir)
    folded = train.withColumn("fold", F.pmod(F.xxhash64("obs_id"), F.lit(3)).cast("int"))
    return ops.cross_validate(features, folded, fold_column="fold")


def risk_score_auc(spark, sf_dir):
    """How well the additive score alone ranks the observations."""
    rows = with_risk(observations(spark, sf_dir)).select("diabetes", F.col("risk_score").cast("double"))
    auc = round(ops.area_under_roc(rows, "risk_score"), 6)
    return local_table(spark, "auc double", [(auc,)])


def _plain(spark, sf_dir):
    """The split of training over columns with few values, on which the classifiers have an exact answer."""
    raised = "CASE WHEN hba1c_level >= 7 THEN 1 ELSE 0 END AS raised"
    rows = observations(spark, sf_dir).selectExpr("obs_id", "diabetes", *STUMP, raised)
    return hash_split(rows, "obs_id")


def _exact(label):
    """A tree of one split over every value, and a regression without penalty."""
    return {
        "stump": (STUMP, ops.forest(label, numTrees=1, maxDepth=1, maxBins=128, bootstrap=False, featureSubsetStrategy="all")),
        "rates": (("raised",), ops.logistic(label, regParam=0.0, maxIter=200, tol=1e-12)),
    }


def _exact_models(spark, sf_dir, names=("stump", "rates")):
    train, holdout = _plain(spark, sf_dir)
    models, exact = {}, _exact("diabetes")
    for name in names:
        columns, classifier = exact[name]
        features = fit_features(train, (), columns)
        with ops.cached(ops.training_rows(train, features, key="obs_id")) as rows:
            models[name] = ops.fit_classifier(features, classifier, rows)
    return models, holdout


def _told(model, holdout):
    found = model.transform(holdout).select("obs_id", "prediction", ops.positive_probability().alias("p"))
    return found.select("obs_id", "prediction", F.round("p", 4).alias("probability"))


def stump_predictions(spark, sf_dir):
    models, holdout = _exact_models(spark, sf_dir, ["stump"])
    return _told(models["stump"], holdout)


def rate_predictions(spark, sf_dir):
    models, holdout = _exact_models(spark, sf_dir, ["rates"])
    return _told(models["rates"], holdout)


def exact_comparison(spark, sf_dir):
    models, holdout = _exact_models(spark, sf_dir)
    return ops.model_comparison([ops.evaluate(model.transform(holdout), name) for name, model in models.items()])


def exact_best_predictions(spark, sf_dir):
    """The best model of the comparison, saved, loaded and used on the holdout."""
    models, holdout = _exact_models(spark, sf_dir)
    table = ops.model_comparison([ops.evaluate(model.transform(holdout), name) for name, model in models.items()])
    best = ops.best_model(table)
    model = load_model(save_model(models[best], run_dir(spark, "models"), best))
    found = ops.scored_holdout(model.transform(holdout))
    return found.groupBy("diabetes", "prediction", F.round("diabetes_probability", 4).alias("probability")).agg(F.count("*").alias("n"))


def stream_stump_predictions(spark, sf_dir):
    """Four micro-batches scored by a saved and loaded tree of one split, with their logged accuracy."""
    models, _ = _exact_models(spark, sf_dir, ["stump"])
    model = load_model(save_model(models["stump"], run_dir(spark, "models"), "stump"))
    out, log, checkpoint = (run_dir(spark, place) for place in ("scored", "accuracy", "checkpoint"))
    events = observed(arriving(spark, sf_dir, True))
    sink = partial(write_batch_parquet, root=out)
    start_scoring(events, sink, checkpoint, model, ("obs_id",), log).awaitTermination()
    logged = spark.read.option("basePath", log).parquet(log).select("batch_id", "n", "correct")
    found = spark.read.option("basePath", out).parquet(out)
    found = found.groupBy("batch_id", F.col("predicted_diabetes").alias("predicted")).agg(F.count("*").alias("rows"), F.sum("obs_id").alias("ids"))
    return found.join(logged, "batch_id").withColumn("batch_id", F.col("batch_id").cast("long"))


def fold_accuracy(spark, sf_dir):
    train, _ = _plain(spark, sf_dir)
    folded = train.withColumn("fold", (F.col("obs_id") % 3).cast("int"))
    found = ops.cross_validate(fit_features(train, (), ("raised",)), folded, penalties=(0.0,), fold_column="fold")
    return found.select("reg_param", F.round("avg_accuracy", 6).alias("avg_accuracy"), "is_best")


QUERIES = {
    f.__name__: f
    for f in (
        forest_metrics,
        logistic_metrics,
        model_comparison,
        best_predictions,
        score_stream_model,
        cv_best,
        risk_score_auc,
        stump_predictions,
        rate_predictions,
        exact_comparison,
        exact_best_predictions,
        stream_stump_predictions,
        fold_accuracy,
    )
}

# The best single split by Gini impurity, the positive rate of each side and of each value of `raised`.
_EXACT = f"""{OBS}, split AS (
  SELECT *, hba1c_level >= 7 AS raised, ('0x' || substr(md5(obs_id || '|42'), 1, 8))::UBIGINT % 100 < 80 AS training FROM obs
), train AS (SELECT * FROM split WHERE training
), long AS (
  {" UNION ALL ".join(f"SELECT '{c}' AS f, CAST({c} AS DOUBLE) AS v, diabetes AS y FROM train" for c in STUMP)}
), per AS (SELECT f, v, COUNT(*) AS n, SUM(y) AS p FROM long GROUP BY 1, 2
), cut AS (
  SELECT f, (v + lead(v) OVER w) / 2 AS cut, CAST(SUM(n) OVER w AS DOUBLE) AS n1, CAST(SUM(p) OVER w AS DOUBLE) AS p1,
    CAST(SUM(n) OVER (PARTITION BY f) AS DOUBLE) AS n, CAST(SUM(p) OVER (PARTITION BY f) AS DOUBLE) AS p
  FROM per WINDOW w AS (PARTITION BY f ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), best AS (
  SELECT f, cut, p1 / n1 AS low, (p - p1) / (n - n1) AS high FROM cut WHERE cut IS NOT NULL
  ORDER BY p1 * (1 - p1 / n1) + (p - p1) * (1 - (p - p1) / (n - n1)) LIMIT 1
), rate AS (SELECT raised, AVG(diabetes) AS rate FROM train GROUP BY 1
), told AS (
  SELECT 'stump' AS model, obs_id, diabetes, CASE WHEN CASE f {" ".join(f"WHEN '{c}' THEN {c}" for c in STUMP)} END <= cut
    THEN low ELSE high END AS probability FROM split, best WHERE NOT training
  UNION ALL
  SELECT 'rates', obs_id, diabetes, rate FROM split JOIN rate USING (raised) WHERE NOT training
), predicted AS (SELECT *, CAST(probability > 0.5 AS DOUBLE) AS prediction FROM told
), accuracy AS (SELECT model, AVG(CAST(prediction = diabetes AS INT)) AS accuracy FROM predicted GROUP BY 1
), cells AS (
  SELECT model, label, COUNT(*) FILTER (diabetes = label) AS support, COUNT(*) FILTER (prediction = label) AS said,
    COUNT(*) FILTER (prediction = label AND diabetes = label) AS hit, COUNT(*) AS n
  FROM predicted, (VALUES (0), (1)) AS l(label) GROUP BY 1, 2
), class AS (
  SELECT model, support / n AS share, CASE WHEN said > 0 THEN hit / said ELSE 0 END AS precision, hit / support AS recall FROM cells
), weighted AS (
  SELECT model, SUM(share * precision) AS precision, SUM(share * recall) AS recall,
    SUM(share * CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END) AS f1
  FROM class GROUP BY 1
), scores AS (
  SELECT model, probability, CAST(SUM(diabetes) AS DOUBLE) AS p, CAST(SUM(1 - diabetes) AS DOUBLE) AS q FROM told GROUP BY 1, 2
), below AS (
  SELECT *, COALESCE(SUM(q) OVER (PARTITION BY model ORDER BY probability
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM scores
), auc AS (SELECT model, SUM(p * (below + q / 2)) / (SUM(p) * SUM(q)) AS auc FROM below GROUP BY 1
), chosen AS (SELECT model FROM accuracy ORDER BY accuracy DESC, model DESC LIMIT 1)"""

ORACLES = {
    "risk_score_auc": f"""{SCORED}, s AS (
  SELECT risk_score, CAST(SUM(diabetes) AS DOUBLE) AS p, CAST(SUM(1 - diabetes) AS DOUBLE) AS q FROM scored GROUP BY 1
), c AS (
  SELECT p, q, COALESCE(SUM(q) OVER (ORDER BY risk_score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
SELECT ROUND(SUM(p * (below + q / 2)) / (SUM(p) * SUM(q)), 6) AS auc FROM c""",
    "stump_predictions": f"""{_EXACT}
SELECT obs_id, prediction, ROUND(probability, 4) AS probability FROM predicted WHERE model = 'stump'""",
    "rate_predictions": f"""{_EXACT}
SELECT obs_id, prediction, ROUND(probability, 4) AS probability FROM predicted WHERE model = 'rates'""",
    "exact_comparison": f"""{_EXACT}
SELECT model, ROUND(accuracy, 4) AS accuracy, ROUND(auc, 4) AS auc, ROUND(precision, 4) AS precision, ROUND(recall, 4) AS recall,
  ROUND(f1, 4) AS f1, model IN (SELECT model FROM chosen) AS is_best
FROM accuracy JOIN auc USING (model) JOIN weighted USING (model)""",
    "exact_best_predictions": f"""{_EXACT}
SELECT diabetes, prediction, ROUND(probability, 4) AS probability, COUNT(*) AS n
FROM predicted JOIN chosen USING (model) GROUP BY 1, 2, 3""",
    "stream_stump_predictions": f"""{_EXACT}, total AS (SELECT max(obs_id) + 1 AS total FROM obs), arrived AS (
  SELECT obs_id, diabetes, least(3, (4 * obs_id) // total + CASE WHEN obs_id % 10 = 0 THEN 1 ELSE 0 END) AS batch_id,
    CAST(CASE WHEN CASE f {" ".join(f"WHEN '{c}' THEN {c}" for c in STUMP)} END <= cut THEN low ELSE high END > 0.5 AS INT) AS predicted
  FROM obs, best, total
), logged AS (SELECT batch_id, COUNT(*) AS n, COUNT(*) FILTER (predicted = diabetes) AS correct FROM arrived GROUP BY 1)
SELECT batch_id, predicted, COUNT(*) AS rows, CAST(SUM(obs_id) AS BIGINT) AS ids, n, correct
FROM arrived JOIN logged USING (batch_id) GROUP BY ALL""",
    "fold_accuracy": f"""{OBS}, train AS (
  SELECT obs_id % 3 AS fold, hba1c_level >= 7 AS raised, diabetes FROM obs
  WHERE ('0x' || substr(md5(obs_id || '|42'), 1, 8))::UBIGINT % 100 < 80
), other AS (
  SELECT f.fold, raised, AVG(diabetes) > 0.5 AS said FROM train t JOIN (VALUES (0), (1), (2)) AS f(fold) ON t.fold <> f.fold GROUP BY 1, 2
), each AS (
  SELECT t.fold, AVG(CAST(CAST(said AS INT) = diabetes AS INT)) AS accuracy
  FROM train t JOIN other o ON t.fold = o.fold AND t.raised = o.raised GROUP BY 1
)
SELECT CAST(0 AS DOUBLE) AS reg_param, ROUND(AVG(accuracy), 6) AS avg_accuracy, TRUE AS is_best FROM each""",
}
