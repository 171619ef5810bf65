"""JDBC tables. The driver jar comes from the cluster."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.profile import since
from riskloom.schema import SCORED_COLUMNS

log = logging.getLogger(__name__)


def jdbc_options(url: str, user: str, password: str, driver: str, **options: str) -> dict[str, str]:
    return {"url": url, "user": user, "password": password, "driver": driver, **options}


def probe_options(options: dict[str, str]) -> dict[str, str]:
    """Read one constant instead of a table; a limit would not reach the database."""
    kept = {k: v for k, v in options.items() if k != "dbtable"}
    return {**kept, "query": kept.get("query", "SELECT 1 AS ok")}


def jdbc_available(spark: SparkSession, options: dict[str, str]) -> bool:
    try:
        return bool(spark.read.format("jdbc").options(**probe_options(options)).load().take(1))
    except Exception as error:  # unreachable, refused, no driver
        log.warning("database not available: %s", error)
        return False


def read_table(
    spark: SparkSession,
    options: dict[str, str],
    table: str,
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int = 16,
) -> DataFrame:
    """A table, read by several tasks when a number or time column and its range are given."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_column:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=lower, upperBound=upper, numPartitions=partitions
        )
    return reader.load()


def read_predictions(table: DataFrame, session_start: dt.datetime, keep: tuple[str, ...] = ()) -> DataFrame:
    """Scored rows after the session start, oldest first; filter and columns reach the source."""
    rows = since(table, session_start).select(*keep, *SCORED_COLUMNS)
    return rows.orderBy(F.col("processing_time"), *keep)
