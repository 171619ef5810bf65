"""Extensions: scaling, trend, alerts, geography."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.observations import OBS, SCORED, observations, predictions, scored, table
from riskloom.operators import prep, trends

SCALED = ("age", "bmi", "hba1c_level", "blood_glucose_level")


def zscore(spark, sf_dir):
    found = prep.zscore(observations(spark, sf_dir), SCALED)
    return found.select("obs_id", *[F.round(c, 6).alias(c) for c in SCALED])


def min_max(spark, sf_dir):
    found = prep.min_max(observations(spark, sf_dir), SCALED)
    return found.select("obs_id", *[F.round(c, 6).alias(c) for c in SCALED])


def _day(df):
    return df.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def daily_trend(spark, sf_dir):
    found = trends.daily_trend(table(spark, sf_dir, "events"), "ts")
    return _day(found).withColumn("moving_avg", F.round("moving_avg", 6))


def rate_alerts(spark, sf_dir):
    found = _day(trends.rate_alerts(predictions(spark, sf_dir), k=1.5))
    return found.select(
        "day", *[F.round(c, 6).alias(c) for c in ("rate", "trailing_mean", "trailing_sd")], "alert"
    )


def geo_rollup(spark, sf_dir):
    places = [table(spark, sf_dir, name) for name in ("customer", "nation", "region")]
    return trends.geo_rollup(scored(spark, sf_dir), *places).withColumn("high_pct", F.round("high_pct", 6))


QUERIES = {f.__name__: f for f in (zscore, min_max, daily_trend, rate_alerts, geo_rollup)}

ORACLES = {
    "zscore": f"{OBS} SELECT obs_id, "
    + ", ".join(f"ROUND(({c} - AVG({c}) OVER ()) / STDDEV_SAMP({c}) OVER (), 6) AS {c}" for c in SCALED)
    + " FROM obs",
    "min_max": f"{OBS} SELECT obs_id, "
    + ", ".join(f"ROUND(({c} - MIN({c}) OVER ()) / (MAX({c}) OVER () - MIN({c}) OVER ()), 6) AS {c}" for c in SCALED)
    + " FROM obs",
    "daily_trend": """WITH d AS (SELECT strftime(ts, '%Y-%m-%d') AS day, COUNT(*) AS n FROM events GROUP BY 1)
SELECT day, n, ROUND(AVG(n) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS moving_avg FROM d""",
    "rate_alerts": f"""{SCORED}, d AS (
  SELECT strftime(processing_time, '%Y-%m-%d') AS day, AVG(predicted_diabetes) AS rate FROM scored GROUP BY 1
), t AS (
  SELECT day, rate, AVG(rate) OVER w AS m, STDDEV_POP(rate) OVER w AS s FROM d
  WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT day, ROUND(rate, 6) AS rate, ROUND(m, 6) AS trailing_mean, ROUND(s, 6) AS trailing_sd,
  COALESCE(ABS(rate - m) > 1.5 * s, FALSE) AS alert FROM t""",
    "geo_rollup": f"""{SCORED}
SELECT COALESCE(r_name, 'unknown') AS region, COALESCE(n_name, 'unknown') AS nation, COUNT(*) AS n, COUNT(*) FILTER (WHERE risk_level = 'high') AS high_n,
  ROUND(COUNT(*) FILTER (WHERE risk_level = 'high') * CAST(100 AS DOUBLE) / COUNT(*), 6) AS high_pct
FROM scored LEFT JOIN customer ON patient_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (COALESCE(r_name, 'unknown'), COALESCE(n_name, 'unknown'))""",
}
