"""Token ids of documents in ORC files.

Documents are dealt to files by ranges of doc_id and sorted, so file after file and row after row ids
ascend. ORC stores the ids of a stripe with integer run-length encoding; row groups carry the least and
greatest doc_id and a Bloom filter over them. Readers split files at stripes, and a filter on doc_id
skips files, stripes and row groups without touching their ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.tokens import Encoder
from riskloom.session import run_dir

BATCH = 500
ROW_GROUP = 1000  # documents between two index entries; at least 1000 by the format
OPTIONS = {
    "orc.stripe.size": str(64 << 20),
    "orc.row.index.stride": str(ROW_GROUP),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "compression": "snappy",
}


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, text_hash, ids) in ascending order of doc_id; NULL text is empty, NULL doc_id comes first.

    Rows that share a doc_id stand in order of a hash of their text. Every document ends with id 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        for batch in batches:
            for low in range(0, batch.num_rows, BATCH):
                part = batch.slice(low, BATCH)
                flat, borders = encoder.ids(part.column(2), end=True)
                ids = pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(flat.view(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), ids], ["doc_id", "text_hash", "ids"])

    text = F.col("text").cast("string")
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
        .repartitionByRange("doc_id", "text_hash")
        .sortWithinPartitions("doc_id", "text_hash")
    )
    return ordered.mapInArrow(run, "doc_id long, text_hash long, ids array<int>")


def write_ids(docs: DataFrame, folder: str, path: str) -> None:
    """Write the ids of docs (doc_id, text) as ORC files; `path` is the tokenizer's file."""
    encoded(docs, path).write.options(**OPTIONS).orc(folder)


def read_ids(spark: SparkSession, folder: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """(doc_id, text_hash, ids) of all documents, or of some with the rest skipped by metadata."""
    found = spark.read.schema("doc_id long, text_hash long, ids array<int>").orc(folder)
    return found if doc_ids is None else found.where(F.col("doc_id").isin(list(doc_ids)))


def index(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32.

    `start` counts the ids of all documents before it: those of earlier files, one sum per file, and of
    earlier rows of its file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            borders = np.asarray(lists.offsets)
            data = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<i4"))).cast("B")
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(borders[:-1], borders[1:], strict=True)]
            n = pa.array(np.diff(borders).astype(np.int64))
            columns = [batch.column(0), batch.column(1), batch.column(3), n, pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "file", "n_tokens", "ids_crc32"])

    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    rows = read_ids(spark, folder).select("doc_id", "text_hash", "ids", number.alias("file"))
    place = run_dir(spark, "token-index")  # two uses, but the files are decoded once
    rows.mapInArrow(run, "doc_id long, text_hash long, file long, n_tokens long, ids_crc32 long").write.parquet(place)
    rows = spark.read.parquet(place)
    before = Window.unboundedPreceding
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("tokens"))
    files = files.select(
        "file", F.coalesce(F.sum("tokens").over(Window.orderBy("file").rowsBetween(before, -1)), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("file").orderBy("doc_id", "text_hash").rowsBetween(before, -1)
    return (
        rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(files, "file")
        .select("doc_id", (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
    )
