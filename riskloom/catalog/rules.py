"""Rule classifier, risk score and agreement metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.observations import LEVELS_SQL, OBS, SCORED, observations, predictions, scored, table
from riskloom.operators import metrics, profile
from riskloom.schema import SCORED_COLUMNS


def risk_level_distribution(spark, sf_dir):
    return profile.level_distribution(profile.with_risk(observations(spark, sf_dir)))


def risk_score(spark, sf_dir):
    return profile.with_risk(observations(spark, sf_dir)).select("obs_id", "risk_score", "risk_level")


def rule_prediction(spark, sf_dir):
    return predictions(spark, sf_dir).drop("patient_id").withColumnRenamed("HbA1c_level", "hba1c_level")


def prediction_match(spark, sf_dir):
    return metrics.with_match(predictions(spark, sf_dir)).select("obs_id", "prediction_match")


def factor_points(spark, sf_dir):
    return profile.factor_points(observations(spark, sf_dir), ["obs_id"])


def confusion_matrix(spark, sf_dir):
    return metrics.confusion(predictions(spark, sf_dir))


def classification_metrics(spark, sf_dir):
    found = metrics.classification_metrics(predictions(spark, sf_dir), ["gender"]).drop("n")
    return found.select("gender", *[F.round(c, 6).alias(c) for c in found.columns if c != "gender"])


def weighted_metrics(spark, sf_dir):
    found = metrics.weighted_metrics(predictions(spark, sf_dir))
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


def batch_accuracy(spark, sf_dir):
    days = predictions(spark, sf_dir).withColumn("day", F.date_format("processing_time", "yyyy-MM-dd"))
    return metrics.batch_accuracy(days, ["day"]).withColumn("accuracy", F.round("accuracy", 6))


def correct_predictions(spark, sf_dir):
    return metrics.correct_only(predictions(spark, sf_dir)).select("obs_id", "predicted_diabetes")


def headline(spark, sf_dir):
    return metrics.headline(predictions(spark, sf_dir)).withColumn("positive_pct", F.round("positive_pct", 6))


def risk_headline(spark, sf_dir):
    found = profile.risk_headline(scored(spark, sf_dir))
    return found.withColumn("avg_risk_score", F.round("avg_risk_score", 6))


def accuracy_by_hba1c_band(spark, sf_dir):
    found = metrics.accuracy_by_hba1c_band(predictions(spark, sf_dir))
    return found.select("band", "n", *[F.round(c, 6).alias(c) for c in ("accuracy_pct", "recall_pct")])


def label_metrics(spark, sf_dir):
    """Class-weighted metrics between two native binary columns."""
    found = metrics.weighted_metrics(table(spark, sf_dir, "labels"), "quality", "toxic")
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


QUERIES = {
    f.__name__: f
    for f in (
        risk_level_distribution,
        risk_score,
        rule_prediction,
        prediction_match,
        factor_points,
        confusion_matrix,
        classification_metrics,
        weighted_metrics,
        label_metrics,
        batch_accuracy,
        correct_predictions,
        headline,
        risk_headline,
        accuracy_by_hba1c_band,
    )
}

_CONFUSION = """
  CAST(SUM(CASE WHEN predicted_diabetes = 1 AND actual_diabetes = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
  CAST(SUM(CASE WHEN predicted_diabetes = 0 AND actual_diabetes = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
  CAST(SUM(CASE WHEN predicted_diabetes = 1 AND actual_diabetes = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(SUM(CASE WHEN predicted_diabetes = 0 AND actual_diabetes = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn
"""


def _safe(part: str, whole: str) -> str:
    return f"COALESCE(CAST({part} AS DOUBLE) / NULLIF({whole}, 0), 0)"


_FACTORS = (
    ("bmi", "bmi", ((">= 30", "30+", 3), (">= 25", "25-30", 2), (">= 23", "23-25", 1)), "<23"),
    ("glucose", "blood_glucose_level", ((">= 180", "180+", 4), (">= 140", "140-180", 3), (">= 100", "100-140", 1)), "<100"),
    ("hba1c", "hba1c_level", ((">= 6.5", "6.5+", 4), (">= 5.7", "5.7-6.5", 2)), "<5.7"),
    ("age", "age", ((">= 65", "65+", 2), (">= 45", "45-65", 1)), "<45"),
    ("hypertension", "hypertension", (("= 1", "yes", 2),), "no"),
    ("heart_disease", "heart_disease", (("= 1", "yes", 2),), "no"),
    ("smoking", "smoking_history", (("IN ('current', 'former')", "yes", 1),), "no"),
)


def factor_union(keys: str, source: str) -> str:
    """One SELECT per factor, each testing its bands from the top."""
    parts = []
    for name, column, bands, lowest in _FACTORS:
        labels = " ".join(f"WHEN {column} {test} THEN '{label}'" for test, label, _ in bands)
        points = " ".join(f"WHEN {column} {test} THEN {n}" for test, _, n in bands)
        parts.append(
            f"SELECT {keys}, '{name}' AS factor, CASE WHEN {column} IS NULL THEN 'unknown' {labels} "
            f"ELSE '{lowest}' END AS band, CASE {points} ELSE 0 END AS points FROM {source}"
        )
    return " UNION ALL ".join(parts)


_WEIGHTED = f"""k AS (
  SELECT CAST(tp + fn AS DOUBLE) AS n, {_safe('tp', 'tp + fp')} AS p, {_safe('tp', 'tp + fn')} AS r, tp AS hit FROM c
  UNION ALL
  SELECT CAST(tn + fp AS DOUBLE), {_safe('tn', 'tn + fn')}, {_safe('tn', 'tn + fp')}, tn FROM c)
SELECT ROUND(SUM(hit) / SUM(n), 6) AS accuracy, ROUND(SUM(p * n) / SUM(n), 6) AS weighted_precision,
  ROUND(SUM(r * n) / SUM(n), 6) AS weighted_recall,
  ROUND(SUM({_safe('2 * p * r', 'p + r')} * n) / SUM(n), 6) AS f1 FROM k"""


ORACLES = {
    "risk_level_distribution": f"""{SCORED}
SELECT lv.risk_level, lv.severity, CAST(COALESCE(c.n, 0) AS BIGINT) AS n,
  round_even(COALESCE(c.n, 0) * CAST(100 AS DOUBLE) / (SELECT COUNT(*) FROM scored), 1) AS pct
FROM {LEVELS_SQL}
LEFT JOIN (SELECT risk_level, COUNT(*) AS n FROM scored GROUP BY risk_level) c USING (risk_level)""",
    "risk_score": f"{SCORED} SELECT obs_id, risk_score, risk_level FROM scored",
    "rule_prediction": f"{SCORED} SELECT obs_id, {', '.join(c.lower() for c in SCORED_COLUMNS)} FROM scored",
    "prediction_match": f"{SCORED} SELECT obs_id, prediction_match FROM scored",
    "factor_points": f"{OBS} {factor_union('obs_id', 'obs')}",
    "confusion_matrix": f"{SCORED} SELECT {_CONFUSION} FROM scored",
    "classification_metrics": f"""{SCORED}, c AS (
  SELECT gender, COUNT(*) AS n, {_CONFUSION} FROM scored GROUP BY gender
), m AS (
  SELECT gender, CAST(tp + tn AS DOUBLE) / n AS a, {_safe('tp', 'tp + fp')} AS p,
    {_safe('tp', 'tp + fn')} AS r, {_safe('tn', 'tn + fp')} AS s FROM c)
SELECT gender, ROUND(a * 100, 6) AS accuracy_pct, ROUND(p * 100, 6) AS precision_pct,
  ROUND(r * 100, 6) AS recall_pct, ROUND({_safe('2 * p * r', 'p + r')}, 6) AS f1,
  ROUND(s * 100, 6) AS specificity_pct FROM m""",
    "weighted_metrics": f"{SCORED}, c AS (SELECT {_CONFUSION} FROM scored), {_WEIGHTED}",
    "label_metrics": f"""WITH scored AS (SELECT quality AS actual_diabetes, toxic AS predicted_diabetes FROM labels),
c AS (SELECT {_CONFUSION} FROM scored), {_WEIGHTED}""",
    "batch_accuracy": f"""{SCORED}
SELECT strftime(processing_time, '%Y-%m-%d') AS day, COUNT(*) AS n,
  CAST(SUM(CASE WHEN prediction_match THEN 1 ELSE 0 END) AS BIGINT) AS correct,
  ROUND(AVG(CASE WHEN prediction_match THEN CAST(1 AS DOUBLE) ELSE 0 END), 6) AS accuracy
FROM scored GROUP BY 1""",
    "correct_predictions": f"{SCORED} SELECT obs_id, predicted_diabetes FROM scored WHERE prediction_match",
    "headline": f"""{SCORED}
SELECT COUNT(*) AS n, CAST(SUM(predicted_diabetes) AS BIGINT) AS positive,
  ROUND(SUM(predicted_diabetes) * CAST(100 AS DOUBLE) / COUNT(*), 6) AS positive_pct,
  CAST(SUM(CASE WHEN prediction_match THEN 1 ELSE 0 END) AS BIGINT) AS correct FROM scored""",
    "risk_headline": f"""{SCORED}
SELECT COUNT(*) FILTER (WHERE risk_level = 'high') AS high_n,
  ROUND(AVG(risk_score), 6) AS avg_risk_score FROM scored""",
    "accuracy_by_hba1c_band": f"""{SCORED}
SELECT CASE WHEN hba1c_level IS NULL THEN 'unknown' WHEN hba1c_level < 5.7 THEN 'normal'
            WHEN hba1c_level < 6.5 THEN 'borderline' ELSE 'high' END AS band, COUNT(*) AS n,
  ROUND(CAST(100 AS DOUBLE) * COUNT(*) FILTER (WHERE prediction_match) / COUNT(*), 6) AS accuracy_pct,
  ROUND(COALESCE(CAST(100 AS DOUBLE) * COUNT(*) FILTER (WHERE predicted_diabetes = 1 AND actual_diabetes = 1)
    / NULLIF(COUNT(*) FILTER (WHERE actual_diabetes = 1), 0), 0), 6) AS recall_pct
FROM scored GROUP BY 1""",
}
