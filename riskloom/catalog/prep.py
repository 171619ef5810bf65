"""Batch preparation."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.catalog.observations import OBS, observations, table
from riskloom.operators import features, prep
from riskloom.schema import CATEGORICAL, CONTINUOUS, REQUIRED_DEFAULTS
from riskloom.session import run_dir
from riskloom.sinks.files import write_csv, write_parquet
from riskloom.sources.files import read_csv

NATIVE = {
    "lineitem": ("l_extendedprice", "l_quantity"),
    "orders": ("o_totalprice",),
    "events": ("value",),
}


def table_size(spark, sf_dir):
    return prep.table_size(table(spark, sf_dir, "lineitem"))


def missing_counts(spark, sf_dir):
    return prep.missing_counts(observations(spark, sf_dir))


def impute_mode(spark, sf_dir):
    return prep.impute(observations(spark, sf_dir), categorical=["smoking_history"]).select("obs_id", "smoking_history")


def impute_mean(spark, sf_dir):
    filled = prep.impute(observations(spark, sf_dir), numeric=["bmi"])
    return filled.select("obs_id", F.round("bmi", 6).alias("bmi"))


def iqr_bounds(spark, sf_dir):
    """Columns of three tables, side by side in one table with NULL where a row has no such column."""
    columns = [c for group in NATIVE.values() for c in group]
    parts = [table(spark, sf_dir, name).select(*group) for name, group in NATIVE.items()]
    together = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), parts)
    found = prep.iqr_bounds(together, columns, exact=True)
    return found.select("column", *[F.round(c, 6).alias(c) for c in ("q1", "q3", "lower", "upper")])


def iqr_clip(spark, sf_dir):
    clipped = prep.iqr_clip(observations(spark, sf_dir), CONTINUOUS, exact=True)
    return clipped.select("obs_id", *[F.round(c, 6).alias(c.lower()) for c in CONTINUOUS])


def price_clip(spark, sf_dir):
    clipped = prep.iqr_clip(table(spark, sf_dir, "lineitem"), ["l_extendedprice"], k=0.5, exact=True)
    return clipped.select("l_orderkey", "l_linenumber", F.round("l_extendedprice", 6).alias("price"))


def string_index(spark, sf_dir):
    rows = observations(spark, sf_dir)
    indexed = features.fit_indexer(rows).transform(rows)
    return indexed.select("obs_id", *[f"{c}_indexed" for c in CATEGORICAL])


def segment_index(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    indexed = features.fit_indexer(rows, ["c_mktsegment"]).transform(rows)
    return indexed.select("c_custkey", "c_mktsegment_indexed")


def feature_vector(spark, sf_dir):
    rows = observations(spark, sf_dir)
    return features.feature_slots(features.fit_features(rows).transform(rows), ["obs_id"])


def split_counts(spark, sf_dir):
    """Sizes of the split that training uses."""
    train, test = features.hash_split(observations(spark, sf_dir), "obs_id")
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.groupBy("part").agg(F.count("*").alias("n"), F.sum("diabetes").alias("positives"))


def ensure_columns(spark, sf_dir):
    full = prep.ensure_columns(table(spark, sf_dir, "events"), REQUIRED_DEFAULTS)
    return full.select("event_id", "gender", "smoking_history", "hypertension")


def attach_by_position(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id")
    orders = table(spark, sf_dir, "orders")
    return prep.attach_by_position(events, orders, ["o_orderpriority"], "event_id", "o_orderkey")


def parquet_roundtrip(spark, sf_dir):
    path = run_dir(spark, "parquet")
    rows = observations(spark, sf_dir)
    write_parquet(rows, path, partition_by=["gender"])
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


def csv_roundtrip(spark, sf_dir):
    path = run_dir(spark, "csv")
    rows = table(spark, sf_dir, "customer")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema)


QUERIES = {
    f.__name__: f
    for f in (
        table_size,
        missing_counts,
        impute_mode,
        impute_mean,
        iqr_bounds,
        iqr_clip,
        price_clip,
        string_index,
        segment_index,
        feature_vector,
        split_counts,
        ensure_columns,
        attach_by_position,
        parquet_roundtrip,
        csv_roundtrip,
    )
}

_COLUMNS = (
    "obs_id",
    "processing_time",
    "patient_id",
    "gender",
    "age",
    "hypertension",
    "heart_disease",
    "smoking_history",
    "bmi",
    "hba1c_level",
    "blood_glucose_level",
    "diabetes",
)
_CLIPPED = tuple(c.lower() for c in CONTINUOUS)


def _bounds(name: str, column: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\", quantile_cont({column}, 0.25) AS q1, "
        f"quantile_cont({column}, 0.75) AS q3 FROM {name}"
    )


def _clip(column: str) -> str:
    return (
        f"ROUND(CASE WHEN {column} < b.{column}_lo THEN b.{column}_lo "
        f"WHEN {column} > b.{column}_hi THEN b.{column}_hi ELSE {column} END, 6) AS {column}"
    )


def _codes(column: str, source: str = "obs") -> str:
    return (
        f"{column}_codes AS (SELECT {column} AS v, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, {column}) - 1 "
        f"AS DOUBLE) AS code FROM {source} WHERE {column} IS NOT NULL GROUP BY {column})"
    )


def _code_of(column: str) -> str:
    return f"COALESCE((SELECT code FROM {column}_codes k WHERE k.v = t.{column}), (SELECT COUNT(*) FROM {column}_codes))"


_SLOTS = ("age", "hypertension", "heart_disease", "bmi", "hba1c_level", "blood_glucose_level")

ORACLES = {
    "table_size": """SELECT COUNT(*) AS n_rows, CAST((SELECT COUNT(*) FROM (DESCRIBE lineitem)) AS INTEGER) AS n_cols
FROM lineitem""",
    "missing_counts": f"{OBS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS missing FROM obs" for c in _COLUMNS
    ),
    "impute_mode": f"""{OBS}, m AS (
  SELECT smoking_history AS v FROM obs WHERE smoking_history IS NOT NULL
  GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)
SELECT obs_id, COALESCE(smoking_history, (SELECT v FROM m)) AS smoking_history FROM obs""",
    "impute_mean": f"""{OBS}
SELECT obs_id, ROUND(COALESCE(bmi, (SELECT AVG(bmi) FROM obs)), 6) AS bmi FROM obs""",
    "iqr_bounds": "WITH q AS ("
    + " UNION ALL ".join(_bounds(name, c) for name, group in NATIVE.items() for c in group)
    + """) SELECT "column", ROUND(q1, 6) AS q1, ROUND(q3, 6) AS q3, ROUND(q1 - 1.5 * (q3 - q1), 6) AS lower,
  ROUND(q3 + 1.5 * (q3 - q1), 6) AS upper FROM q""",
    "iqr_clip": f"""{OBS}, q AS (SELECT {", ".join(
        f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3" for c in _CLIPPED
    )} FROM obs), b AS (SELECT {", ".join(
        f"{c}_q1 - 1.5 * ({c}_q3 - {c}_q1) AS {c}_lo, {c}_q3 + 1.5 * ({c}_q3 - {c}_q1) AS {c}_hi" for c in _CLIPPED
    )} FROM q)
SELECT obs_id, {", ".join(_clip(c) for c in _CLIPPED)} FROM obs, b""",
    "price_clip": """WITH q AS (
  SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)
SELECT l_orderkey, l_linenumber,
  ROUND(LEAST(GREATEST(l_extendedprice, q1 - 0.5 * (q3 - q1)), q3 + 0.5 * (q3 - q1)), 6) AS price FROM lineitem, q""",
    "string_index": f"""{OBS}, {_codes("gender")}, {_codes("smoking_history")}
SELECT obs_id, CAST({_code_of("gender")} AS DOUBLE) AS gender_indexed,
  CAST({_code_of("smoking_history")} AS DOUBLE) AS smoking_history_indexed FROM obs t""",
    "segment_index": f"""WITH {_codes("c_mktsegment", "customer")}
SELECT c_custkey, CAST({_code_of("c_mktsegment")} AS DOUBLE) AS c_mktsegment_indexed FROM customer t""",
    "feature_vector": f"""{OBS}, {_codes("gender")}, {_codes("smoking_history")} """
    + " UNION ALL ".join(
        [f"SELECT obs_id, {i} AS slot, CAST({c} AS DOUBLE) AS value FROM obs" for i, c in enumerate(_SLOTS)]
        + [
            f"SELECT obs_id, {i} AS slot, CAST({_code_of(c)} AS DOUBLE) AS value FROM obs t"
            for i, c in ((6, "gender"), (7, "smoking_history"))
        ]
    ),
    "split_counts": f"""{OBS}
SELECT CASE WHEN ('0x' || substr(md5(obs_id || '|42'), 1, 8))::UBIGINT % 100 < 80 THEN 'train' ELSE 'test' END AS part,
  COUNT(*) AS n, CAST(SUM(diabetes) AS BIGINT) AS positives FROM obs GROUP BY 1""",
    "ensure_columns": """SELECT event_id, 'Female' AS gender, 'never' AS smoking_history, 0 AS hypertension FROM events""",
    "attach_by_position": """WITH l AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS p FROM events),
r AS (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderkey) AS p FROM orders)
SELECT event_id, o_orderpriority FROM l LEFT JOIN r USING (p)""",
    "parquet_roundtrip": f"{OBS} SELECT * FROM obs",
    "csv_roundtrip": "SELECT * FROM customer",
}
