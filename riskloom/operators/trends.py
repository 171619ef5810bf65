"""Daily trend, rate alerts and the spread over nations and regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.nulls import ratio
from riskloom.operators.metrics import PREDICTED

UNKNOWN = "unknown"


def daily_trend(df: DataFrame, column: str = "processing_time", days: int = 7) -> DataFrame:
    """(day, n, moving_avg) with the mean of the last `days` rows, one row per day."""
    daily = df.groupBy(F.to_date(column).alias("day")).agg(F.count("*").alias("n"))
    return daily.withColumn("moving_avg", F.avg("n").over(Window.orderBy("day").rowsBetween(1 - days, 0)))


def rate_alerts(df: DataFrame, column: str = "processing_time", days: int = 7, k: float = 2.0) -> DataFrame:
    """(day, rate, trailing_mean, trailing_sd, alert): positive rate beyond mean +- k deviations."""
    daily = df.groupBy(F.to_date(column).alias("day")).agg(F.avg(PREDICTED).alias("rate"))
    trailing = Window.orderBy("day").rowsBetween(-days, -1)
    distance = F.abs(F.col("rate") - F.col("trailing_mean"))
    return daily.withColumns(
        {
            "trailing_mean": F.avg("rate").over(trailing),
            "trailing_sd": F.stddev_pop("rate").over(trailing),
        }
    ).withColumn("alert", F.coalesce(distance > k * F.col("trailing_sd"), F.lit(False)))


def geo_rollup(scored: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Observations, high-risk ones and their share by region and nation, with subtotals.

    Patients without a customer, nation or region count as of an unknown one, so the total is that of all observations.
    Observations are reduced to one row per patient before the join with the patients' homes,
    and to one row per nation before the names and subtotals come in.
    """
    per_patient = scored.groupBy("patient_id").agg(
        F.count("*").alias("n"), F.sum((F.col("risk_level") == "high").cast("long")).alias("high_n")
    )
    per_nation = (
        per_patient.join(customer, F.col("patient_id") == F.col("c_custkey"), "left")
        .groupBy("c_nationkey")
        .agg(F.sum("n").alias("n"), F.sum("high_n").alias("high_n"))
    )
    return (
        per_nation.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("n", "high_n", *[F.coalesce(c, F.lit(UNKNOWN)).alias(c) for c in ("r_name", "n_name")])
        .rollup(F.col("r_name").alias("region"), F.col("n_name").alias("nation"))
        .agg(F.sum("n").alias("n"), F.sum("high_n").alias("high_n"))
        .withColumn("high_pct", ratio(F.col("high_n"), F.col("n")) * 100.0)
    )
