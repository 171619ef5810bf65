"""All summaries of the scored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.bands import age_band
from riskloom.operators import metrics, profile
from riskloom.operators.decision import weighted_edges
from riskloom.schema import normalize_nulls

CORRELATED = ("age", "bmi", "blood_glucose_level", "HbA1c_level", "risk_score", "predicted_diabetes")


def enriched(scored: DataFrame) -> DataFrame:
    """Scored rows with match flag, risk score and level, hour and age group."""
    rows = profile.with_risk(metrics.with_match(normalize_nulls(scored)))
    return rows.withColumns({"hour": F.hour("processing_time"), "age_group": age_band(F.col("age"))})


def summaries(rows: DataFrame, exact: bool = False) -> dict[str, DataFrame]:
    """Lazy summaries by name, over `enriched` rows. Each reads only the columns it needs."""
    return {
        "metrics": metrics.classification_metrics(rows),
        "confusion": metrics.confusion(rows),
        "headline": metrics.headline(rows),
        "risk_headline": profile.risk_headline(rows),
        "risk_levels": profile.level_distribution(rows),
        "age_bands": profile.band_counts(rows),
        "bmi_bands": profile.bmi_bands(rows),
        "bmi_histogram": profile.histogram(rows, "bmi", 30, "predicted_diabetes"),
        "bmi_box": profile.box_stats(rows, "bmi", "predicted_diabetes", exact),
        "score_histogram": profile.score_histogram(rows),
        "score_box": profile.box_stats(rows, "risk_score", "risk_level", exact),
        "correlations": profile.correlation_matrix(rows, CORRELATED),
        "hourly": profile.hourly(rows),
        "radar": profile.risk_radar(rows),
        "gender_risk": profile.crosstab_share(rows, "gender", "risk_level"),
        "age_risk": profile.crosstab_share(rows, "age_group", "risk_level"),
        "high_risk": profile.high_risk_profile(rows),
        "most_at_risk": profile.most_at_risk(rows),
        "age_decade": profile.age_decade_mode(rows),
        "correct_bmi": profile.correct_bmi_class(rows),
        "borderline": metrics.accuracy_by_hba1c_band(rows),
        "decision": weighted_edges(rows),
        "growth": profile.record_growth(rows),
    }
