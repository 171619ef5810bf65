import random

import pytest
from helpers import column, events
from pyspark.sql import functions as F

from riskloom.operators import features, prep, ranges
from riskloom.schema import REQUIRED_DEFAULTS, normalize_nulls

NAN = float("nan")


def test_missing_counts_nan_and_null_but_not_text(spark):
    frame = spark.createDataFrame([("Male", 1.0, 1), (None, NAN, None), ("x", None, 2)], "g string, v double, i int")
    assert {r["column"]: r["missing"] for r in prep.missing_counts(frame).collect()} == {"g": 1, "v": 2, "i": 1}


def test_missing_counts_of_an_empty_table(spark):
    frame = spark.createDataFrame([], "g string, v double")
    assert column(prep.missing_counts(frame), "missing") == [0, 0]


def test_mode_ignores_null_and_takes_the_smallest_of_ties(spark):
    frame = spark.createDataFrame([(None,), (None,), (None,), ("b",), ("a",), ("b",), ("a",)], "g string")
    assert column(prep.impute(frame, ["g"]), "g") == ["a", "a", "a", "b", "a", "b", "a"]


def test_mean_fills_numbers_and_ignores_nan(spark):
    frame = spark.createDataFrame([(1.0, 1, 5), (3.0, None, 5), (NAN, 2, 5), (None, 3, 5)], "v double, i int, full int")
    filled = prep.impute(frame, numeric=["v", "i", "full"])
    assert column(filled, "v") == [1.0, 3.0, 2.0, 2.0]
    assert column(filled, "i") == [1.0, 2.0, 2.0, 3.0]
    assert dict(filled.dtypes)["full"] == "double"


def test_column_without_values_stays(spark):
    frame = spark.createDataFrame([(None, None)], "g string, v double")
    assert prep.impute(frame, ["g"], ["v"]).first() == (None, None)


def test_clip_keeps_null_and_drops_nan(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0, NAN, None]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    clipped = column(prep.iqr_clip(frame, ["v"], exact=True), "v")
    assert clipped[:4] == [1.0, 2.0, 3.0, 4.0] and clipped[4] == 7.0 and clipped[5:] == [None, None]


def test_clip_with_fixed_bounds_is_idempotent(spark):
    frame = spark.range(50).select(F.col("id").cast("double").alias("v"))
    once = frame.withColumn("v", prep.clip(F.col("v"), 5.0, 40.0))
    assert column(once.withColumn("v", prep.clip(F.col("v"), 5.0, 40.0)), "v") == column(once, "v")


def test_approximate_bounds_are_close(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    exact = prep.iqr_bounds(frame, ["l_extendedprice"], exact=True).first()
    rough = prep.iqr_bounds(frame, ["l_extendedprice"], relative_error=0.01).first()
    assert rough["q1"] == pytest.approx(exact["q1"], rel=0.1)
    assert rough["q3"] == pytest.approx(exact["q3"], rel=0.1)


def brute(values, share):
    values = sorted(values)
    position = share * (len(values) - 1)
    low = int(position)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (position - low)


@pytest.mark.parametrize("rows_per_bucket", [10, 10**6])
def test_exact_quantiles_by_group_with_a_hot_value(spark, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(ranges, "ROWS_PER_BUCKET", rows_per_bucket)
    rng = random.Random(1)
    rows = []
    for i in range(3000):
        group = rng.choice(["a", "b", None])
        value = 7.0 if i % 3 == 0 else round(rng.gauss(0, 50), 1)
        rows.append((group, value if i % 11 else None, float("nan") if i % 13 == 0 else float(i)))
    frame = spark.createDataFrame(rows, "g string, v double, w double")
    shares = (0.0, 0.25, 0.5, 0.9, 1.0)
    found = {(r["g"], r["column"], r["share"]): r["value"] for r in ranges.exact_quantiles(frame, ["v", "w"], shares, ["g"]).collect()}
    assert len(found) == 3 * 2 * len(shares)
    for (g, c, share), value in found.items():
        mine = [r["vw".index(c) + 1] for r in rows if r[0] == g]
        mine = [v for v in mine if v is not None and v == v]
        assert value == pytest.approx(brute(mine, share), abs=1e-9)


def test_exact_quantiles_when_ranks_are_not_small(spark, monkeypatch):
    monkeypatch.setattr(ranges, "ROWS_PER_BUCKET", 10)
    frame = spark.range(1001).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))
    found = {r["g"]: r["value"] for r in ranges.exact_quantiles(frame, ["v"], [0.5], ["g"]).collect()}
    assert found == {0: 500.0, 1: 500.0}


@pytest.mark.parametrize("rows_per_bucket", [10, 10**6])
def test_row_numbers_follow_the_key(spark, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(ranges, "ROWS_PER_BUCKET", rows_per_bucket)
    keys = random.Random(2).sample(range(10**6), 2000)
    frame = spark.createDataFrame([(k,) for k in keys], "k long").repartition(7)
    numbered = {r["k"]: r["position"] for r in ranges.number_rows(frame, "k").collect()}
    assert [numbered[k] for k in sorted(keys)] == list(range(2000))


def test_row_numbers_refuse_a_key_with_nulls(spark):
    with pytest.raises(ValueError, match="NULLs"):
        ranges.number_rows(spark.createDataFrame([(1,), (None,)], "k long"), "k")


def test_attach_by_position_pads_a_short_right_side(spark):
    left = spark.createDataFrame([(10, "x"), (20, "y"), (30, "z")], "k long, v string")
    right = spark.createDataFrame([(2, "b"), (1, "a")], "k long, gender string")
    rows = prep.attach_by_position(left, right, ["gender"], "k", "k").orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(10, "x", "a"), (20, "y", "b"), (30, "z", None)]


def test_attach_only_where_absent_or_empty(spark):
    left = spark.createDataFrame([(1, "own", None), (2, None, None)], "k long, a string, b string")
    right = spark.createDataFrame([(1, "ra", "rb"), (2, "ra", "rb")], "k long, a string, b string")
    rows = prep.attach_by_position(left, right, ["a", "b"], "k", "k").orderBy("k")
    assert column(rows, "a") == ["own", None]
    assert column(rows, "b") == ["rb", "rb"]


def test_ensure_columns_adds_only_absent_ones(spark):
    row = prep.ensure_columns(spark.createDataFrame([(3.5,)], "hba1c_level double"), REQUIRED_DEFAULTS).first()
    assert row["hba1c_level"] == 3.5 and row["gender"] == "Female" and row["smoking_history"] == "never"
    assert row["diabetes"] == 0 and len(row) == len(REQUIRED_DEFAULTS)


def test_index_orders_by_frequency_then_text(spark):
    values = ["b", "b", "a", "a", "c", None]
    frame = spark.createDataFrame([(v,) for v in values], "g string")
    model = features.fit_indexer(frame, ["g"])
    assert column(model.transform(frame), "g_indexed") == [1.0, 1.0, 0.0, 0.0, 2.0, 3.0]
    assert column(model.transform(spark.createDataFrame([("new",)], "g string")), "g_indexed") == [3.0]


def test_columns_with_unlike_numbers_of_categories(spark):
    frame = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z"), ("a", None)], "g string, h string")
    model = features.fit_indexer(frame, ["g", "h"])
    assert column(model.transform(frame), "g_indexed") == [0.0, 0.0, 1.0, 0.0]
    assert column(model.transform(frame), "h_indexed") == [0.0, 1.0, 2.0, 3.0]


def test_index_refuses_columns_that_are_no_categories(spark):
    with pytest.raises(ValueError, match="categories"):
        features.fit_indexer(spark.range(20).select(F.col("id").cast("string").alias("g")), ["g"], max_categories=10)


def test_vector_keeps_null_as_nan_or_refuses_it(spark):
    frame = events(spark, {"bmi": None}, {})
    slots = features.feature_slots(features.fit_features(frame).transform(frame), ["gender"])
    assert slots.count() == 16 and slots.where("value IS NULL").count() == 1
    strict = features.fit_features(frame, handle_invalid="error")
    with pytest.raises(Exception, match="null while assembling"):
        strict.transform(frame).collect()


def test_split_does_not_depend_on_partitioning(spark):
    frame = spark.range(2000)
    a = features.hash_split(frame, "id")
    b = features.hash_split(frame.repartition(13), "id")
    assert sorted(column(a[0], "id")) == sorted(column(b[0], "id"))
    assert a[0].count() + a[1].count() == 2000
    assert 0.75 < a[0].count() / 2000 < 0.85


def test_scaling_a_constant_column_gives_zero(spark):
    frame = spark.createDataFrame([(1.0, 1.0), (1.0, 3.0), (None, None)], "c double, v double")
    assert column(prep.zscore(frame, ["c", "v"]), "c") == [0.0, 0.0, None]
    assert column(prep.min_max(frame, ["c", "v"]), "v") == [0.0, 1.0, None]


def test_normalize_nulls(spark):
    frame = normalize_nulls(spark.createDataFrame([(NAN, "NaN"), (1.0, "x")], "v double, s string"))
    assert column(frame, "v") == [None, 1.0] and column(frame, "s") == ["NaN", "x"]
