"""Kafka topics. Needs the public spark-sql-kafka-0-10 connector on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_options(servers: str, topic: str, **options: str) -> dict[str, str]:
    """Start at the newest messages and carry on when the broker has dropped some."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        **options,
    }


def batch_options(servers: str, topic: str, **options: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
        **options,
    }


def read_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    return spark.readStream.format("kafka").options(**stream_options(servers, topic, **options)).load()


def read_kafka_batch(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """All messages now in the topic."""
    return spark.read.format("kafka").options(**batch_options(servers, topic, **options)).load()


def messages_per_partition(messages: DataFrame) -> DataFrame:
    return messages.groupBy("partition").agg(F.count("*").alias("n"))
