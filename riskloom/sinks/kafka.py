"""Rows as JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.schema import normalize_nulls


def to_messages(df: DataFrame, key: str, stamp: Column | None = None) -> DataFrame:
    """(key, value): every row as a JSON object with its missing values as null and a timestamp."""
    rows = normalize_nulls(df)
    seconds = F.unix_timestamp() if stamp is None else stamp
    body = F.struct(*[F.col(c) for c in rows.columns if c != key], seconds.alias("timestamp"))
    return rows.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
    )


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
