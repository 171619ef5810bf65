"""Data behind charts: histograms, boxes, points and the decision diagram."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.observations import SCORED, predictions, scored, table
from riskloom.catalog.rules import factor_union
from riskloom.operators import decision, profile

BINS = 30


def bmi_histogram(spark, sf_dir):
    found = profile.histogram(predictions(spark, sf_dir), "bmi", BINS, "predicted_diabetes")
    return found.select("predicted_diabetes", "bin", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"), "n")


def score_histogram(spark, sf_dir):
    return profile.score_histogram(scored(spark, sf_dir))


def _rounded_box(found, by):
    return found.select(by, *[F.round(c, 6).alias(c) for c in found.columns if c != by])


def bmi_box_stats(spark, sf_dir):
    rows = predictions(spark, sf_dir)
    return _rounded_box(profile.box_stats(rows, "bmi", "predicted_diabetes"), "predicted_diabetes")


def score_box_stats(spark, sf_dir):
    return _rounded_box(profile.box_stats(scored(spark, sf_dir), "risk_score", "risk_level"), "risk_level")


def bmi_bands(spark, sf_dir):
    return profile.bmi_bands(predictions(spark, sf_dir))


def risk_points(spark, sf_dir):
    points = profile.risk_points(scored(spark, sf_dir), ["obs_id"])
    return points.withColumnRenamed("HbA1c_level", "hba1c_level")


def high_risk_zone(spark, sf_dir):
    return profile.above_line(predictions(spark, sf_dir)).select("obs_id")


def decision_edges(spark, sf_dir):
    edges = decision.weighted_edges(scored(spark, sf_dir))
    return decision.edges_with_nodes(edges, decision.nodes(edges))


def decision_flow(spark, sf_dir):
    return profile.decision_flow(scored(spark, sf_dir))


def price_histogram(spark, sf_dir):
    found = profile.histogram(table(spark, sf_dir, "orders"), "o_totalprice", BINS, "o_orderstatus")
    return found.select("o_orderstatus", "bin", F.round("lo", 4).alias("lo"), F.round("hi", 4).alias("hi"), "n")


def price_box_stats(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return _rounded_box(profile.box_stats(orders, "o_totalprice", "o_orderstatus"), "o_orderstatus")


QUERIES = {
    f.__name__: f
    for f in (
        bmi_histogram,
        score_histogram,
        bmi_box_stats,
        score_box_stats,
        bmi_bands,
        risk_points,
        high_risk_zone,
        decision_edges,
        decision_flow,
        price_histogram,
        price_box_stats,
    )
}


def _box_sql(column: str, by: str, source: str = "scored") -> str:
    return f"""{SCORED}, v AS (SELECT {by}, CAST({column} AS DOUBLE) AS v FROM {source} WHERE {column} IS NOT NULL),
q AS (SELECT {by}, MIN(v) AS lo, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2,
  quantile_cont(v, 0.75) AS q3, MAX(v) AS hi FROM v GROUP BY 1)
SELECT {by}, ROUND(ANY_VALUE(lo), 6) AS "min", ROUND(ANY_VALUE(q1), 6) AS q1, ROUND(ANY_VALUE(q2), 6) AS median,
  ROUND(ANY_VALUE(q3), 6) AS q3, ROUND(ANY_VALUE(hi), 6) AS "max",
  ROUND(MIN(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1)), 6) AS lower_fence,
  ROUND(MAX(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1)), 6) AS upper_fence
FROM v JOIN q USING ({by}) GROUP BY 1"""


def _histogram_sql(column: str, by: str, source: str, digits: int) -> str:
    return f"""{SCORED}, r AS (SELECT MIN({column}) AS lo, (MAX({column}) - MIN({column})) / {BINS} AS w FROM {source}),
b AS (SELECT {by}, CAST(LEAST(FLOOR(({column} - lo) / w), {BINS - 1}) AS INTEGER) AS bin, lo, w
  FROM {source}, r WHERE {column} IS NOT NULL)
SELECT {by}, bin, ROUND(ANY_VALUE(lo + bin * w), {digits}) AS lo,
  ROUND(ANY_VALUE(lo + (bin + 1) * w), {digits}) AS hi, COUNT(*) AS n FROM b GROUP BY 1, 2"""



ORACLES = {
    "bmi_histogram": _histogram_sql("bmi", "predicted_diabetes", "scored", 6),
    "price_histogram": _histogram_sql("o_totalprice", "o_orderstatus", "orders", 4),
    "price_box_stats": _box_sql("o_totalprice", "o_orderstatus", "orders"),
    "score_histogram": f"""{SCORED}
SELECT risk_level, risk_score AS bin, risk_score AS lo, risk_score + 1 AS hi, COUNT(*) AS n FROM scored GROUP BY 1, 2""",
    "bmi_box_stats": _box_sql("bmi", "predicted_diabetes"),
    "score_box_stats": _box_sql("risk_score", "risk_level"),
    "bmi_bands": f"""{SCORED}
SELECT CASE WHEN bmi < 18.5 THEN 'underweight' WHEN bmi < 25 THEN 'normal' WHEN bmi < 30 THEN 'overweight'
  ELSE 'obese' END AS band, COUNT(*) AS n FROM scored WHERE bmi IS NOT NULL GROUP BY 1""",
    "risk_points": f"""{SCORED}
SELECT obs_id, blood_glucose_level, hba1c_level, bmi, risk_score, risk_level, age, gender FROM scored""",
    "high_risk_zone": f"""{SCORED}
SELECT obs_id FROM scored WHERE hba1c_level > 5 + 0.03 * (blood_glucose_level - 100)""",
    "decision_edges": f"""{SCORED}, long AS ({factor_union('obs_id, risk_level', 'scored')}),
ends AS (
  SELECT 'patient' AS sf, 'all' AS sb, factor AS tf, band AS tb FROM long
  UNION ALL SELECT factor, band, 'level', risk_level FROM long
), flow AS (SELECT sf, sb, tf, tb, COUNT(*) AS n FROM ends GROUP BY ALL),
nodes AS (
  SELECT tf AS f, tb AS b, COUNT(*) AS n FROM ends GROUP BY ALL
  UNION ALL SELECT sf, sb, COUNT(*) FROM ends WHERE sf = 'patient' GROUP BY ALL
)
SELECT sf AS source_factor, sb AS source_band, tf AS target_factor, tb AS target_band, flow.n AS n,
  s.n AS source_n, t.n AS target_n
FROM flow JOIN nodes s ON s.f = sf AND s.b = sb JOIN nodes t ON t.f = tf AND t.b = tb""",
    "decision_flow": f"""{SCORED}
SELECT factor, band, risk_level, COUNT(*) AS n FROM ({factor_union('risk_level', 'scored')}) GROUP BY 1, 2, 3""",
}
