"""Order-dependent work without a single sorting task: numbering and exact quantiles.

For quantiles a value is put into one of many range buckets of about equal size. Bucket sizes are counted
with map-side combining, their running total gives each bucket its offset, and only then are
values ordered, bucket by bucket.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.positions import number_in_order

ROWS_PER_BUCKET = 1_000_000
MIN_BUCKETS, MAX_BUCKETS = 64, 20_000
SAMPLES_PER_BUCKET = 200


def bucket_count(rows: int) -> int:
    return min(MAX_BUCKETS, max(MIN_BUCKETS, -(-rows // ROWS_PER_BUCKET)))


def in_buckets(df: DataFrame, column: str, rows: int, out: str) -> DataFrame:
    """Add the number of the range bucket that a double column falls into.

    The borders come from a sketch of a sample. They decide how even the buckets are, never
    the result, and are fixed before any row is placed, so recomputed tasks agree.
    """
    buckets = bucket_count(rows)
    sample = df.sample(fraction=min(1.0, buckets * SAMPLES_PER_BUCKET / max(rows, 1)), seed=42)
    shares = [i / buckets for i in range(1, buckets)]
    inner = sorted(set(sample.select(column).approxQuantile(column, shares, 1.0 / (4 * buckets))))
    if not inner:
        return df.withColumn(out, F.lit(0))
    splits = [float("-inf"), *inner, float("inf")]
    placed = Bucketizer(splits=splits, inputCol=column, outputCol=out).transform(df)
    return placed.withColumn(out, F.col(out).cast("int"))


def number_rows(df: DataFrame, key: str, out: str = "position") -> DataFrame:
    """Consecutive 0-based numbers in the order of `key`, a unique number or time column."""
    rows, with_key = df.agg(F.count("*"), F.count(key)).first()
    if rows != with_key:
        raise ValueError(f"{key} has NULLs, so it does not order the rows")
    return number_in_order(df, [F.asc(key)], out)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated quantiles: (*by, column, share, value), NULL and NaN left out.

    Only the buckets holding a wanted rank are ordered, with equal values already counted
    together, so neither a large group nor a frequent value ends up whole in one task.
    """
    group = [*by, "column"]
    values = (
        df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot(list(by), list(columns), "column", "value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
    )
    rows = df.count() * len(columns)
    hits = _hits(values, group, shares, rows)
    weight = _position() - F.floor(_position())
    return (
        hits.groupBy(*group, "share", "total")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"))
        .select(*group, "share", (F.col("low") + (F.col("high") - F.col("low")) * weight).alias("value"))
    )


def _hits(values: DataFrame, group: Sequence[str], shares: Sequence[float], rows: int) -> DataFrame:
    """Values at the wanted ranks, found bucket by bucket."""
    keys = [*group, "bucket"]
    bucketed = in_buckets(values, "value", rows, "bucket")
    whole = Window.partitionBy(*group)
    sizes = bucketed.groupBy(*keys).agg(F.count("*").alias("size"))
    spans = (
        sizes.withColumn("total", F.sum("size").over(whole))
        .withColumn("last", F.sum("size").over(whole.orderBy("bucket")))
        .withColumn("first", F.col("last") - F.col("size"))
    )
    ranks = _at_ranks(spans, shares).select(*keys, F.col("first").alias("offset"), "total", "share", "rank")
    wanted = ranks.select(*keys, "offset").distinct()
    within = Window.partitionBy(*keys).orderBy("value")
    counted = (
        bucketed.alias("l")
        .join(wanted.alias("r"), _matching(keys))
        .select("l.*", "r.offset")
        .groupBy(*keys, "offset", "value")
        .agg(F.count("*").alias("copies"))
        .withColumn("last", F.col("offset") + F.sum("copies").over(within))
        .withColumn("first", F.col("last") - F.col("copies"))
    )
    in_reach = (F.col("r.rank") >= F.col("l.first")) & (F.col("r.rank") < F.col("l.last"))
    return counted.alias("l").join(ranks.alias("r"), _matching(keys) & in_reach).select("r.*", "l.value")


def _position():
    """Where a share falls between the 0-based ranks."""
    return F.col("share") * (F.col("total") - 1)


def _at_ranks(spans: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Spans of ranks [first, last) that hold one of the two ranks around a share's position."""
    around = F.array_distinct(F.array(F.floor(_position()), F.ceil(_position())))
    return (
        spans.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
        .withColumn("rank", F.explode(around))
        .where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
    )


def _matching(keys: Sequence[str]):
    """Join condition l.key <=> r.key for every key."""
    return reduce(operator.and_, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
