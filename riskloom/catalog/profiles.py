"""Summaries of the scored table: rows, groups, time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from riskloom.catalog.observations import LEVELS_SQL, SCORED, predictions, scored
from riskloom.functions.rules import LEVEL_NAMES, max_score
from riskloom.operators import dims, profile
from riskloom.operators.metrics import with_match
from riskloom.schema import SCORED_COLUMNS
from riskloom.sources.jdbc import read_predictions

SESSION_START = dt.datetime(2024, 1, 15, 12, 0, 0, 500_000)


def session_predictions(spark, sf_dir):
    rows = read_predictions(predictions(spark, sf_dir), SESSION_START, ("obs_id",))
    return rows.drop("obs_id").withColumnRenamed("HbA1c_level", "hba1c_level")


def recent_predictions(spark, sf_dir):
    rows = with_match(predictions(spark, sf_dir))
    columns = (
        "gender", "age", "blood_glucose_level", "HbA1c_level", "bmi",
        "actual_diabetes", "predicted_diabetes", "prediction_match",
    )
    shown = profile.displayed(profile.recent(rows, ["processing_time", "obs_id"], 100, columns))
    return shown.withColumnRenamed("HbA1c_level", "hba1c_level")


def age_band_by_prediction(spark, sf_dir):
    return profile.band_counts(predictions(spark, sf_dir)).withColumn("pct", F.round("pct", 6))


def age_decade_mode(spark, sf_dir):
    return profile.age_decade_mode(predictions(spark, sf_dir))


def hourly_summary(spark, sf_dir):
    return profile.hourly(predictions(spark, sf_dir))


def correlation_matrix(spark, sf_dir):
    columns = ("age", "bmi", "blood_glucose_level", "hba1c_level", "risk_score", "predicted_diabetes")
    return profile.correlation_matrix(scored(spark, sf_dir), columns)


def gender_risk_share(spark, sf_dir):
    shares = profile.crosstab_share(scored(spark, sf_dir), "gender", "risk_level")
    return shares.withColumn("pct", F.round("pct", 6))


def age_risk_share(spark, sf_dir):
    rows = scored(spark, sf_dir).withColumn("age_band", profile.age_band(F.col("age")))
    return profile.crosstab_share(rows, "age_band", "risk_level").withColumn("pct", F.round("pct", 6))


def order_status_share(spark, sf_dir):
    """The same cross-tabulation on a native pair of columns."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    shares = profile.crosstab_share(orders, "o_orderpriority", "o_orderstatus")
    return shares.withColumn("pct", F.round("pct", 6))


def stacked_positions(spark, sf_dir):
    found = profile.stacked_positions(scored(spark, sf_dir), "gender", "risk_level")
    return found.select("gender", "risk_level", *[F.round(c, 6).alias(c) for c in ("pct", "label_y")])


def _scores(spark):
    """Every score that the rules can give."""
    return dims.local_table(spark, "risk_score int", [(s,) for s in range(max_score() + 1)])


def _score_counts(spark, sf_dir):
    rows = scored(spark, sf_dir).select(F.col("risk_score").cast("int"))
    return rows.groupBy("risk_score").agg(F.count("*").alias("n"))


def missing_levels(spark, sf_dir):
    return dims.add_absent(_score_counts(spark, sf_dir), _scores(spark), "risk_score", {"n": 0})


def unseen_levels(spark, sf_dir):
    return dims.absent(_score_counts(spark, sf_dir), _scores(spark), "risk_score")


def level_order(spark, sf_dir):
    counts = scored(spark, sf_dir).groupBy("risk_level").agg(F.count("*").alias("n"))
    return dims.with_order(counts, dims.members(spark, "risk_level", LEVEL_NAMES, "severity"), "risk_level")


def risk_radar(spark, sf_dir):
    continuous = ("bmi", "blood_glucose_level", "hba1c_level", "age")
    return profile.risk_radar(scored(spark, sf_dir), continuous).withColumn("value", F.round("value", 6))


def high_risk_profile(spark, sf_dir):
    return profile.high_risk_profile(scored(spark, sf_dir))


def most_at_risk(spark, sf_dir):
    return profile.most_at_risk(scored(spark, sf_dir))


def correct_bmi_class(spark, sf_dir):
    return profile.correct_bmi_class(predictions(spark, sf_dir)).withColumn("avg_bmi", F.round("avg_bmi", 6))


def record_growth(spark, sf_dir):
    found = profile.record_growth(predictions(spark, sf_dir))
    return found.withColumns({"day": F.date_format("day", "yyyy-MM-dd"), "growth_pct": F.round("growth_pct", 6)})


def session_span(spark, sf_dir):
    return profile.session_span(predictions(spark, sf_dir), "patient_id")


QUERIES = {
    f.__name__: f
    for f in (
        session_predictions,
        recent_predictions,
        age_band_by_prediction,
        age_decade_mode,
        hourly_summary,
        correlation_matrix,
        gender_risk_share,
        age_risk_share,
        order_status_share,
        stacked_positions,
        missing_levels,
        unseen_levels,
        level_order,
        risk_radar,
        high_risk_profile,
        most_at_risk,
        correct_bmi_class,
        record_growth,
        session_span,
    )
}


def _share_sql(row: str, column: str = "risk_level", source: str = "scored") -> str:
    return f"""SELECT r.{row}, c.{column}, COUNT(s.{column}) AS n,
  COUNT(s.{column}) * CAST(100 AS DOUBLE) / SUM(COUNT(s.{column})) OVER (PARTITION BY r.{row}) AS pct
FROM (SELECT DISTINCT {row} FROM {source} WHERE {row} IS NOT NULL) r
CROSS JOIN (SELECT DISTINCT {column} FROM {source}) c
LEFT JOIN {source} s ON s.{row} = r.{row} AND s.{column} = c.{column} GROUP BY 1, 2"""


_PAIRS = ("age", "bmi", "blood_glucose_level", "hba1c_level", "risk_score", "predicted_diabetes")
_ALL_SCORES = "(SELECT CAST(unnest(range(0, 19)) AS INTEGER) AS risk_score) r"
_RADAR = ("bmi", "blood_glucose_level", "hba1c_level", "age")

ORACLES = {
    "session_predictions": f"""{SCORED}
SELECT {', '.join(c.lower() for c in SCORED_COLUMNS)} FROM scored
WHERE processing_time > TIMESTAMP '2024-01-15 12:00:00' ORDER BY processing_time, obs_id""",
    "recent_predictions": f"""{SCORED}
SELECT gender, round_even(age, 0) AS age, round_even(blood_glucose_level, 1) AS blood_glucose_level,
  round_even(hba1c_level, 1) AS hba1c_level, round_even(bmi, 1) AS bmi, actual_diabetes, predicted_diabetes,
  prediction_match FROM scored ORDER BY processing_time DESC, obs_id DESC LIMIT 100""",
    "age_band_by_prediction": f"""{SCORED}, cells AS (
  SELECT b.age_band, p.predicted
  FROM (VALUES ('<30'), ('30-40'), ('40-50'), ('50-60'), ('60-70'), ('70+')) AS b(age_band)
  CROSS JOIN (SELECT DISTINCT predicted_diabetes AS predicted FROM scored) p
), c AS (
  SELECT cells.age_band, cells.predicted, COUNT(s.obs_id) AS n FROM cells
  LEFT JOIN scored s ON s.age_band = cells.age_band AND s.predicted_diabetes = cells.predicted GROUP BY 1, 2)
SELECT age_band, predicted, n, ROUND(COALESCE(n * CAST(100 AS DOUBLE)
  / NULLIF(SUM(n) OVER (PARTITION BY age_band), 0), 0), 6) AS pct FROM c""",
    "age_decade_mode": f"""{SCORED}
SELECT CAST(FLOOR(age / 10) * 10 AS INTEGER) AS decade FROM scored GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1""",
    "hourly_summary": f"""{SCORED}, h AS (
  SELECT strftime(processing_time, '%H:00') AS hour_bin, COUNT(predicted_diabetes) AS total,
    CAST(SUM(predicted_diabetes) AS BIGINT) AS positive, COUNT(*) FILTER (WHERE prediction_match) AS correct
  FROM scored GROUP BY 1)
SELECT *, round_even(CAST(positive AS DOUBLE) / total * 100, 1) AS positive_rate,
  round_even(CAST(correct AS DOUBLE) / total * 100, 1) AS accuracy FROM h""",
    "correlation_matrix": f"{SCORED} "
    + " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, round_even(corr({x}, {y}), 2) AS r FROM scored"
        for x in _PAIRS
        for y in _PAIRS
    ),
    "gender_risk_share": f"{SCORED} SELECT gender, risk_level, n, ROUND(pct, 6) AS pct FROM ({_share_sql('gender')})",
    "age_risk_share": f"{SCORED} SELECT age_band, risk_level, n, ROUND(pct, 6) AS pct FROM ({_share_sql('age_band')})",
    "order_status_share": f"""SELECT o_orderpriority, o_orderstatus, n, ROUND(pct, 6) AS pct
FROM ({_share_sql('o_orderpriority', 'o_orderstatus', 'orders')})""",
    "stacked_positions": f"""{SCORED}, p AS ({_share_sql('gender')}), y AS (
  SELECT gender, risk_level, pct, COALESCE(SUM(pct) OVER (PARTITION BY gender ORDER BY risk_level
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + pct / 2 AS label_y FROM p)
SELECT gender, risk_level, ROUND(pct, 6) AS pct, ROUND(label_y, 6) AS label_y FROM y WHERE pct >= 5""",
    "missing_levels": f"""{SCORED}
SELECT r.risk_score, COUNT(s.risk_score) AS n FROM {_ALL_SCORES} LEFT JOIN scored s USING (risk_score) GROUP BY 1""",
    "unseen_levels": f"""{SCORED}
SELECT risk_score FROM {_ALL_SCORES} WHERE risk_score NOT IN (SELECT risk_score FROM scored)""",
    "level_order": f"""{SCORED}
SELECT s.risk_level, COUNT(*) AS n, lv.severity FROM scored s JOIN {LEVELS_SQL} ON s.risk_level = lv.risk_level
GROUP BY 1, 3""",
    "risk_radar": f"{SCORED} "
    + " UNION ALL ".join(
        [
            f"""SELECT lv.risk_level, '{c}' AS metric, ROUND(COALESCE((AVG({c}) - (SELECT MIN({c}) FROM scored))
  / NULLIF((SELECT MAX({c}) - MIN({c}) FROM scored), 0), 0), 6) AS value
FROM {LEVELS_SQL} LEFT JOIN scored s USING (risk_level) GROUP BY 1"""
            for c in _RADAR
        ]
        + [
            f"""SELECT lv.risk_level, '{c}' AS metric, ROUND(COALESCE(AVG({c}), 0), 6) AS value
FROM {LEVELS_SQL} LEFT JOIN scored s USING (risk_level) GROUP BY 1"""
            for c in ("hypertension", "heart_disease")
        ]
    ),
    "high_risk_profile": f"""{SCORED}
SELECT COUNT(*) AS n, round_even(COUNT(*) * CAST(100 AS DOUBLE) / (SELECT COUNT(*) FROM scored), 1) AS pct,
  COALESCE(round_even(AVG(blood_glucose_level), 1), 0) AS avg_glucose,
  COALESCE(round_even(AVG(hba1c_level), 1), 0) AS avg_hba1c, COALESCE(round_even(AVG(bmi), 1), 0) AS avg_bmi,
  COALESCE(round_even(AVG(hypertension) * 100, 1), 0) AS hypertension_pct FROM scored WHERE risk_level = 'high'""",
    "most_at_risk": f"""{SCORED}, c AS (
  SELECT 'gender' AS dimension, gender AS value, COUNT(*) AS n FROM scored
  WHERE risk_level = 'high' AND gender IS NOT NULL GROUP BY 2
  UNION ALL
  SELECT 'age_band', age_band, COUNT(*) FROM scored WHERE risk_level = 'high' AND age_band IS NOT NULL GROUP BY 2)
SELECT dimension, value, n FROM c QUALIFY row_number() OVER (PARTITION BY dimension ORDER BY n DESC, value) = 1""",
    "correct_bmi_class": f"""{SCORED}, m AS (SELECT AVG(bmi) AS a FROM scored WHERE prediction_match)
SELECT ROUND(a, 6) AS avg_bmi, CASE WHEN a < 25 THEN 'normal' ELSE 'high' END AS bmi_class FROM m""",
    "record_growth": f"""{SCORED}, d AS (
  SELECT strftime(processing_time, '%Y-%m-%d') AS day, COUNT(*) AS added FROM scored GROUP BY 1
), t AS (SELECT day, CAST(SUM(added) OVER (ORDER BY day) AS BIGINT) AS n, added FROM d)
SELECT day, n, n - added AS prev_n, added AS growth,
  ROUND(COALESCE(added * CAST(100 AS DOUBLE) / NULLIF(n - added, 0), 0), 6) AS growth_pct FROM t""",
    "session_span": f"""{SCORED}, s AS (
  SELECT patient_id, date_sub('second', MIN(processing_time), MAX(processing_time)) AS span FROM scored GROUP BY 1)
SELECT patient_id, span // 3600 AS hours, (span % 3600) // 60 AS minutes, span % 60 AS seconds FROM s""",
}
