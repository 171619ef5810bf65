"""Session settings and the shared folder for checkpoints and written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution on and UTC as its time zone."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach; a temporary one only for an unset local session."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    return _local_dir(spark.sparkContext.applicationId)


@lru_cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"riskloom-{application}-")


def counting_session(spark: SparkSession, state_partitions: int = 16) -> SparkSession:
    """A session for streams that count few groups, with few state partitions.

    Partial sums are what is shuffled, so the state grows with the groups, not the messages.
    The number is fixed by the first run of a checkpoint and does not touch other queries.
    """
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        session.conf.set(key, spark.conf.get(key))
    session.conf.set("spark.sql.shuffle.partitions", state_partitions)
    return session


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """What runs meanwhile gets at most so many rows in an Arrow batch: long texts by the default of 10,000 take
    some 100 MB a task outside the heap."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(most if int(before) <= 0 else min(most, int(before))))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)
