"""JDBC append that a retry does not repeat, and a primary sink with a fallback."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.sources.jdbc import jdbc_available

log = logging.getLogger(__name__)


def write_jdbc(df: DataFrame, options: dict[str, str], table: str, mode: str = "append") -> None:
    df.write.format("jdbc").options(**options).option("dbtable", table).mode(mode).save()


def not_yet_written(df: DataFrame, batch_id: int, written: DataFrame | None, key: str) -> DataFrame:
    """Rows of a micro-batch that an earlier, interrupted attempt has not stored. Without a table it has stored none."""
    tagged = df.withColumn("batch_id", F.lit(batch_id).cast("long"))
    if written is None:
        return tagged
    earlier = written.where(F.col("batch_id") == batch_id).select(key)
    return tagged.join(earlier, key, "left_anti")


def append_batch(df: DataFrame, batch_id: int, options: dict[str, str], table: str, key: str) -> None:
    """Append a micro-batch once, even when Spark replays it. The first one makes the table."""
    written = existing_table(df.sparkSession, options, table)
    write_jdbc(not_yet_written(df, batch_id, written, key), options, table)


def existing_table(spark: SparkSession, options: dict[str, str], table: str) -> DataFrame | None:
    """The table, or None if the database answers but does not have it."""
    try:
        return spark.read.format("jdbc").options(**options).option("dbtable", table).load()
    except Exception as error:  # drivers have no common error for a table that is not there
        if not jdbc_available(spark, options):
            raise
        log.warning("no table %s yet: %s", table, error)
        return None


def write_with_fallback(
    df: DataFrame,
    primary: Callable[[DataFrame], str | None],
    fallback: Callable[[DataFrame], str | None],
) -> str:
    """Use the fallback sink when the primary one fails; tells which one was used."""
    try:
        primary(df)
        return "primary"
    except Exception as error:  # whatever the primary sink raises
        log.warning("primary sink failed, using the fallback: %s", error)
        fallback(df)
        return "fallback"
