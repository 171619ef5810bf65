"""Versions of an output behind a log, read as of any of them.

A version's rows are written to a folder of their own, then a log file with the next number is created, which
file systems do for one writer only. The log is the pointer: readers see whole versions or none. Expiry takes old
versions out of the log before their rows are deleted.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.sinks.files import delete_path, write_parquet

TRIES = 20


def _log(root: str) -> str:
    return f"{root}/_log"


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small new file; False if it is there already. It gets its name only when it is whole."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = system.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(context.makeQualified(draft), context.makeQualified(target), none)  # fails where the name is taken
        return True
    except Exception:
        system.delete(draft, False)
        if system.exists(target):
            return False
        raise


def versions(spark: SparkSession, root: str) -> list[dict]:
    """The log, oldest first: version, run, at (seconds), rows, path."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_log(root))
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in system.listStatus(folder)] if system.exists(folder) else []
    names = sorted(n for n in names if n.endswith(".json"))
    if not names:
        return []
    lines = spark.read.text([f"{_log(root)}/{n}" for n in names], wholetext=True).collect()  # one line per version
    return sorted((json.loads(r["value"]) for r in lines), key=lambda v: v["version"])


def commit(df: DataFrame, root: str, run: str) -> int:
    """Write a new version and return its number. Of writers at the same time each gets a number of its own."""
    spark = df.sparkSession
    path = f"{root}/data/{run}-{uuid.uuid4().hex}"
    write_parquet(df, path, mode="errorifexists")
    rows = spark.read.schema(df.schema).parquet(path).agg(F.count("*")).first()[0]
    for _ in range(TRIES):
        known = versions(spark, root)
        number = known[-1]["version"] + 1 if known else 0
        line = {"version": number, "run": run, "at": time.time(), "rows": rows, "path": path, "schema": df.schema.json()}
        if _create(spark, f"{_log(root)}/{number:012d}.json", json.dumps(line)):
            return number
    raise RuntimeError(f"no free version in {TRIES} tries at {root}")


def read_as_of(
    spark: SparkSession, root: str, version: int | None = None, run: str | None = None, at: float | None = None
) -> DataFrame:
    """The newest version, or that with a number, the newest of a run, or the newest at a time."""
    from pyspark.sql.types import StructType

    fitting = [
        v
        for v in versions(spark, root)
        if (version is None or v["version"] == version) and (run is None or v["run"] == run) and (at is None or v["at"] <= at)
    ]
    if not fitting:
        raise FileNotFoundError(f"no such version at {root}")
    found = fitting[-1]
    return spark.read.schema(StructType.fromJson(json.loads(found["schema"]))).parquet(found["path"])


def expire(spark: SparkSession, root: str, keep: int) -> list[int]:
    """Delete all but the newest `keep` versions and return the numbers of those deleted."""
    if keep < 1:
        raise ValueError("the newest version has to stay")
    old = versions(spark, root)[:-keep]
    for v in old:
        delete_path(spark, f"{_log(root)}/{v['version']:012d}.json")
    for v in old:
        delete_path(spark, v["path"])
    return [v["version"] for v in old]
