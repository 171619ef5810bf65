"""Category indexes, feature vectors and a stable split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.nulls import nan_to_null
from riskloom.schema import CATEGORICAL, NUMERIC_FEATURES

MAX_CATEGORIES = 100_000


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n), all columns counted in one pass with map-side combining."""
    long = df.select([F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    return long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))


def fit_indexer(
    df: DataFrame, columns: Sequence[str] = CATEGORICAL, max_categories: int = MAX_CATEGORIES
) -> PipelineModel:
    """Frequency-descending codes, ties by text; NULL and unseen values get one extra code.

    Columns with more than `max_categories` values together are no categories, and are refused.
    """
    counts = category_counts(df, columns).limit(max_categories + 1).collect()
    if len(counts) > max_categories:
        raise ValueError(f"more than {max_categories} categories in {list(columns)}")
    counts.sort(key=lambda r: (-r["n"], r["value"]))
    indexers = [
        StringIndexerModel.from_labels(
            [r["value"] for r in counts if r["column"] == c], c, f"{c}_indexed", handleInvalid="keep"
        )
        for c in columns
    ]
    return PipelineModel(indexers)


def assembler(
    columns: Sequence[str], out: str = "features", handle_invalid: str = "keep"
) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid=handle_invalid)


def fit_features(
    df: DataFrame,
    categorical: Sequence[str] = CATEGORICAL,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    handle_invalid: str = "keep",
) -> PipelineModel:
    """Indexer and assembler, fitted once and used by training and scoring alike."""
    columns = [*numeric, *[f"{c}_indexed" for c in categorical]]
    indexers = fit_indexer(df, categorical).stages if categorical else []
    return PipelineModel([*indexers, assembler(columns, handle_invalid=handle_invalid)])


def feature_slots(df: DataFrame, keys: Sequence[str], vector: str = "features") -> DataFrame:
    """Long form of a vector column: (*keys, slot, value), NaN as NULL."""
    exploded = df.select(*keys, F.posexplode(vector_to_array(vector)).alias("slot", "value"))
    return exploded.withColumn("value", nan_to_null(F.col("value")))


def hash_split(
    df: DataFrame, key: str, train_percent: int = 80, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and holdout rows by a hash of the key, the same however the rows are partitioned.

    The slot is the first 32 bits of the MD5 of `key|seed` modulo 100, which other engines compute alike.
    """
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    slot = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100
    return df.where(slot < train_percent), df.where(slot >= train_percent)
