"""Two-step commits of micro-batches: the rows first, then one line that says where they are.

An attempt writes its rows to the primary sink under a name of its own, or, if that fails, to the fallback. Only then the
manifest gets the batch's line, which names the sink and the attempt. Readers take the rows of attempts that have a line, so
what a broken attempt had already stored is nowhere counted, and a batch is in one place only. A batch that has
its line is not written again when Spark replays it.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.sinks.files import batch_path, write_parquet

log = logging.getLogger(__name__)

LINE = "sink string, attempt string, rows long"
PRIMARY, FALLBACK = "primary", "fallback"


class ManifestSink:
    """A batch sink for `start_scoring`: (df, batch_id).

    `primary` appends a DataFrame whose rows carry batch_id and attempt, to a database or a table. The fallback is Parquet
    under root/fallback.
    """

    def __init__(self, primary: Callable[[DataFrame], object], root: str):
        self.primary, self.root = primary, root

    def __call__(self, df: DataFrame, batch_id: int) -> str:
        spark = df.sparkSession
        known = _line(spark, self.root, batch_id)
        if known:
            return known
        attempt = uuid.uuid4().hex
        tagged = df.withColumns({"batch_id": F.lit(batch_id).cast("long"), "attempt": F.lit(attempt)})
        sink = PRIMARY
        try:
            self.primary(tagged)
        except Exception as error:  # whatever the primary sink raises
            log.warning("primary sink failed for batch %d, using the fallback: %s", batch_id, error)
            sink = FALLBACK
            write_parquet(tagged.drop("batch_id", "attempt"), f"{_fallback(self.root)}/batch_id={batch_id}/attempt={attempt}")
        line = spark.createDataFrame([(sink, attempt, df.count())], LINE)
        write_parquet(line, batch_path(f"{self.root}/manifest", batch_id))
        return sink


def _fallback(root: str) -> str:
    return f"{root}/fallback"


def _line(spark: SparkSession, root: str, batch_id: int) -> str | None:
    found = _read(spark, batch_path(f"{root}/manifest", batch_id), LINE)
    row = found.first() if found is not None else None
    return row["sink"] if row else None


def _read(spark: SparkSession, path: str, schema: str | None = None, base: str | None = None) -> DataFrame | None:
    """What is at a path, None if nothing is."""
    reader = spark.read.option("basePath", base or path)
    try:
        return (reader.schema(schema) if schema else reader).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """(batch_id, sink, attempt, rows): one line per committed batch."""
    found = _read(spark, f"{root}/manifest", f"{LINE}, batch_id long")
    return spark.createDataFrame([], f"batch_id long, {LINE}") if found is None else found.select("batch_id", "sink", "attempt", "rows")


def committed(primary: DataFrame, root: str) -> DataFrame:
    """Every committed row once, with its batch_id and the sink that holds it.

    `primary` is the primary sink's table as it is now, with batch_id and attempt. The lines are few, one per batch, and
    whether they are broadcast is left to their size.
    """
    spark = primary.sparkSession
    lines = manifest(spark, root).select("batch_id", "attempt", "sink")
    columns = [c for c in primary.columns if c not in ("batch_id", "attempt")]
    keys = ["batch_id", "attempt"]
    held = primary.withColumn("batch_id", F.col("batch_id").cast("long")).join(lines.where(F.col("sink") == PRIMARY), keys)
    held = held.select(*columns, "batch_id", "sink")
    spare = _read(spark, _fallback(root))
    if spare is None:
        return held
    spare = spare.withColumns({"batch_id": F.col("batch_id").cast("long"), "attempt": F.col("attempt").cast("string")})
    spare = spare.join(lines.where(F.col("sink") == FALLBACK), keys)
    return held.unionByName(spare.select(*columns, "batch_id", "sink"))
