"""Emptying tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clear_table(spark: SparkSession, name: str, truncate: bool = True) -> int:
    """Empty a catalog table and return how many rows it had.

    Without `truncate` the rows are replaced by none in one overwrite, which leaves the table
    as it was when the write fails.
    """
    table = spark.table(name)
    rows = table.count()
    if truncate:
        spark.sql("TRUNCATE TABLE IDENTIFIER(:name)", args={"name": name})
    else:
        spark.createDataFrame([], table.schema).write.insertInto(name, overwrite=True)
    return rows


def clear_jdbc_table(spark: SparkSession, options: dict[str, str], name: str, schema: T.StructType) -> int:
    """The same for a JDBC table: overwrite with no rows, keeping the table itself."""
    query = {**options, "query": f"SELECT count(*) AS n FROM {name}"}
    rows = spark.read.format("jdbc").options(**query).load().select(F.col("n").cast("long")).first()[0]
    empty = spark.createDataFrame([], schema)
    empty.write.format("jdbc").options(**options).option("dbtable", name).option("truncate", True).mode(
        "overwrite"
    ).save()
    return rows
