import datetime as dt
import random

import pytest
from helpers import column, scored
from pyspark.sql import functions as F

from riskloom.functions.rules import LEVEL_NAMES
from riskloom.operators import dims, profile
from riskloom.operators.decision import edges_with_nodes, nodes, weighted_edges
from riskloom.plans.analytics import enriched, summaries


def at(*parts):
    return dt.datetime(2024, 1, *parts)


@pytest.fixture
def mixed(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        rows.append(
            {
                "gender": rng.choice(["Female", "Male", "Other", None]),
                "age": rng.choice([0.0, 30.0, 45.0, 66.0, 100.5, None]),
                "bmi": rng.choice([18.0, 24.0, 31.5, None]),
                "HbA1c_level": rng.choice([5.0, 6.0, 7.5, None]),
                "blood_glucose_level": rng.choice([90.0, 130.0, 200.0, None]),
                "hypertension": rng.choice([0, 1, None]),
                "actual_diabetes": rng.choice([0, 1, None]),
                "predicted_diabetes": rng.choice([0, 1, None]),
                "processing_time": at(1 + i % 5, i % 24),
            }
        )
    return enriched(scored(spark, *rows)).cache()


def test_every_summary_runs(mixed):
    for name, frame in summaries(mixed, exact=True).items():
        assert frame.columns and frame.collect() is not None, name


def test_every_summary_runs_on_an_empty_table(mixed):
    for name, frame in summaries(mixed.limit(0), exact=True).items():
        rows = frame.collect()
        if name in ("metrics", "confusion", "headline", "high_risk"):
            assert all(v == 0 for v in rows[0]), name
        if name == "risk_levels":
            assert [tuple(r) for r in rows] == [(l, i, 0, 0.0) for i, l in enumerate(LEVEL_NAMES)]
        if name == "most_at_risk":
            assert {(r["dimension"], r["value"], r["n"]) for r in rows} == {
                ("gender", "unknown", 0),
                ("age_band", "unknown", 0),
            }


def test_shares_add_up(mixed):
    for frame, by in (
        (profile.crosstab_share(mixed, "gender", "risk_level"), "gender"),
        (profile.band_counts(mixed), "age_band"),
    ):
        sums = frame.groupBy(by).agg(F.sum("pct").alias("s"), F.sum("n").alias("n")).collect()
        assert all(r["s"] == pytest.approx(100 if r["n"] else 0) for r in sums)


def test_unseen_bands_and_classes_get_zero_rows(spark):
    frame = scored(spark, {"age": 25.0, "predicted_diabetes": 1}, {"age": 0.0, "predicted_diabetes": 0})
    found = {(r["age_band"], r["predicted"]): r["n"] for r in profile.band_counts(frame).collect()}
    assert len(found) == 12 and found["<30", 1] == 1 and found["<30", 0] == 0 and sum(found.values()) == 1


def test_unseen_levels_are_left_out_of_the_crosstab(spark):
    frame = spark.createDataFrame([("F", "high"), ("F", "high"), ("M", "low")], "g string, l string")
    rows = {(r["g"], r["l"]): r["pct"] for r in profile.crosstab_share(frame, "g", "l").collect()}
    assert rows == {("F", "high"): 100.0, ("F", "low"): 0.0, ("M", "high"): 0.0, ("M", "low"): 100.0}


def test_crosstab_keeps_unlisted_and_missing_values(spark):
    frame = spark.createDataFrame([("F", "x"), ("F", None), ("F", None), ("M", "x"), (None, "y")], "g string, l string")
    rows = {(r["g"], r["l"]): (r["n"], round(r["pct"], 3)) for r in profile.crosstab_share(frame, "g", "l").collect()}
    assert rows == {("F", "x"): (1, 33.333), ("F", None): (2, 66.667), ("M", "x"): (1, 100.0), ("M", None): (0, 0.0)}
    assert profile.crosstab_share(frame.limit(0), "g", "l").count() == 0


def test_stacked_label_sits_in_the_middle(spark):
    frame = spark.createDataFrame([("F", "high")] * 2 + [("F", "low")] * 6 + [("F", "moderate")] * 2, "g string, l string")
    rows = profile.stacked_positions(frame, "g", "l").collect()
    assert {r["l"]: (r["pct"], r["label_y"]) for r in rows} == {
        "high": (20.0, 10.0),
        "low": (60.0, 50.0),
        "moderate": (20.0, 90.0),
    }


def test_histogram_counts_every_value_once(spark):
    frame = spark.createDataFrame([(v, v is None) for v in (0.0, 1.0, 9.99, 10.0, None)], "v double, by boolean")
    rows = {r["bin"]: r["n"] for r in profile.histogram(frame, "v", 10, "by").collect()}
    assert rows == {0: 1, 1: 1, 9: 2}
    constant = spark.createDataFrame([(5.0, 1), (5.0, 1)], "v double, by int")
    assert profile.histogram(constant, "v", 10, "by").first()["n"] == 2


def test_box_fences_are_data_points(spark):
    frame = spark.createDataFrame([(float(v), "a") for v in (1, 2, 3, 4, 5, 100)] + [(None, "b")], "v double, g string")
    row = profile.box_stats(frame, "v", "g").first()
    assert (row["min"], row["q1"], row["median"], row["q3"], row["max"]) == (1.0, 2.25, 3.5, 4.75, 100.0)
    assert (row["lower_fence"], row["upper_fence"]) == (1.0, 5.0)
    rough = profile.box_stats(frame, "v", "g", exact=False).first()
    assert rough["median"] == 3.0


def test_correlation_guards_constant_columns_and_skips_nulls_pairwise(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.5, 5.0), (None, 1.0, 5.0)]
    frame = spark.createDataFrame(rows, "a double, b double, c double")
    found = {(r["x"], r["y"]): r["r"] for r in profile.correlation_matrix(frame, ["a", "b", "c"], 4).collect()}
    assert len(found) == 9
    assert found["a", "a"] == 1.0 and found["a", "b"] == found["b", "a"] == pytest.approx(0.9979, abs=1e-4)
    assert found["a", "c"] is None and found["c", "c"] is None


def test_rounding_is_half_even(spark):
    frame = scored(spark, {"bmi": 0.25, "age": 2.5}, {"bmi": 0.35, "age": 3.5})
    shown = profile.displayed(frame)
    assert column(shown, "bmi") == [0.2, 0.4] and column(shown, "age") == [2.0, 4.0]


def test_session_filter_is_exclusive_in_whole_seconds(spark):
    times = [at(1, 12, 0, 0), at(1, 12, 0, 0, 300_000), at(1, 12, 0, 1)]
    frame = scored(spark, *[{"processing_time": t} for t in times])
    kept = profile.since(frame, at(1, 12, 0, 0, 900_000))
    assert kept.count() == 2


def test_radar_of_a_missing_level_is_zero(spark):
    frame = profile.with_risk(scored(spark, {"bmi": 20.0}, {"bmi": 40.0}))
    values = {(r["risk_level"], r["metric"]): r["value"] for r in profile.risk_radar(frame).collect()}
    assert len(values) == 24
    assert values["very_low", "bmi"] == 0.0 and values["high", "bmi"] == 1.0
    assert values["high", "age"] == 0.0  # no range


def test_modes_break_ties_downwards(spark):
    frame = scored(spark, *[{"age": a, "gender": g} for a, g in ((59.9, "M"), (50.0, "F"), (39.0, "F"), (30.0, "M"))])
    assert column(profile.age_decade_mode(frame), "decade") == [30]
    risky = profile.with_risk(frame).withColumn("risk_level", F.lit("high"))
    top = {r["dimension"]: (r["value"], r["n"]) for r in profile.most_at_risk(risky).collect()}
    assert top["gender"] == ("F", 2)


def test_bmi_class(spark):
    frame = scored(spark, {"bmi": 20.0}, {"bmi": 40.0, "actual_diabetes": 1})
    assert column(profile.correct_bmi_class(frame), "bmi_class") == ["normal"]
    assert column(profile.correct_bmi_class(frame.where("bmi > 30")), "bmi_class") == ["high"]


def test_span_keeps_days(spark):
    frame = scored(spark, {"processing_time": at(1, 0, 0, 5)}, {"processing_time": at(3, 1, 2, 8)})
    row = profile.session_span(frame, "gender").first()
    assert (row["hours"], row["minutes"], row["seconds"]) == (49, 2, 3)


def test_growth_against_nothing_is_zero_percent(spark):
    frame = scored(spark, *[{"processing_time": t} for t in (at(1), at(1), at(2))])
    rows = [tuple(r)[1:] for r in profile.record_growth(frame).orderBy("day").collect()]
    assert rows == [(2, 0, 2, 0.0), (3, 2, 1, 50.0)]


def test_line_and_points(spark):
    frame = profile.with_risk(scored(spark, {"blood_glucose_level": 100.0, "HbA1c_level": 5.0}, {"HbA1c_level": 6.3}))
    assert profile.above_line(frame).count() == 1
    assert profile.risk_points(frame, []).count() == 2
    assert profile.risk_points(frame, [], fraction=0.0).count() == 0


def test_levels_added_by_union_and_looked_up(spark):
    counts = spark.createDataFrame([("low", 3)], "risk_level string, n long")
    dim = dims.members(spark, "risk_level", LEVEL_NAMES, "severity")
    full = dims.add_absent(counts, dim, "risk_level", {"n": 0})
    ordered = dims.with_order(full, dim, "risk_level").orderBy("severity")
    assert [(r["risk_level"], r["n"]) for r in ordered.collect()] == [
        ("high", 0),
        ("moderate", 0),
        ("low", 3),
        ("very_low", 0),
    ]


def test_diagram(spark):
    frame = profile.with_risk(scored(spark, {}, {"bmi": 22.0}, {"bmi": None}))
    edges = weighted_edges(frame)
    flow = {tuple(r)[:4]: r["n"] for r in edges.collect()}
    halves = [sum(n for k, n in flow.items() if (k[0] == "patient") == first) for first in (True, False)]
    assert halves == [21, 21] and flow["patient", "all", "bmi", "<23"] == 1
    joined = edges_with_nodes(edges, nodes(edges)).collect()
    assert len(joined) == len(flow) and {r["source_n"] for r in joined if r["source_factor"] == "patient"} == {21}
