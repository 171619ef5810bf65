"""Category codes as a table: for columns with any number of values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.positions import number_in_order

HOT = 10_000  # most frequent values, which are joined by broadcast


def code_table(df: DataFrame, column: str) -> DataFrame:
    """(value, n, code): values by falling frequency, ties by text, numbered from 0. NULL has no code.

    Counting combines on the map side; numbering orders distinct values only.
    """
    counts = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n")).where("value IS NOT NULL")
    return number_in_order(counts, [F.desc("n"), F.asc("value")], "code")


def encode(df: DataFrame, column: str, codes: DataFrame, out: str, hot: int = HOT) -> DataFrame:
    """Rows with the code of their value as a double; NULL and unseen values get the number of values.

    The `hot` most frequent values, with whatever share of the rows, are looked up in place; only the rows of
    others are shuffled, and none of their values is frequent beyond 1 / hot of all rows.
    """
    extra = codes.agg(F.count("*")).first()[0]
    value = F.col(column).cast("string")
    frequent = codes.where(F.col("code") < hot).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    looked_up = df.join(F.broadcast(frequent), value == F.col("_value"), "left").drop("_value")  # at most `hot` rows
    if extra <= hot:
        return looked_up.withColumn(out, F.coalesce("_code", F.lit(extra)).cast("double")).drop("_code")
    done = F.col("_code").isNotNull() | value.isNull()
    rest = codes.where(F.col("code") >= hot).select(F.col("value").alias("_value"), F.col("code").alias("_rest"))
    found = looked_up.where(~done).join(rest, value == F.col("_value"), "left").withColumn("_code", F.col("_rest"))
    both = looked_up.where(done).unionByName(found.drop("_value", "_rest"))
    return both.withColumn(out, F.coalesce("_code", F.lit(extra)).cast("double")).drop("_code")
