"""Best-fit packing of token pieces into sequences, online and in bounded space.

A packer has a fixed number of open bins. Bins are kept in lists by free space, and an integer with a
bit per free space tells which lists hold one, so the tightest bin a piece fits into is the lowest set
bit at or above its length. When a new bin is needed and all are open, the fullest one closes.

Pieces are dealt to packers by hash, as many packers as the tokens need, each with its own bins. The
pieces of bins that a packer leaves with much room go to a next round with the packers that they need, until
one packer has had them all or a round saves few of their sequences; so the number of packers costs next to
no sequences, and no packer gets more than its share.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.tokens import Encoder
from riskloom.session import run_dir

CAPACITY = 2048
OPEN_BINS = 4096
TOKENS_PER_PACKER = 8_000_000
FULL_PERCENT = 98  # a bin filled this far stays as it is when its packer ends
SAVED_PERCENT = 2  # a round has to save this share of the sequences it takes apart, or it is the last
ROUNDS = 30  # as many have room in a sequence_id
ROUND = 1 << 30  # sequence numbers of one packer, far more than its tokens fill
PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


def pack(lengths: Iterable[int], capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> Iterator[tuple[int, int]]:
    """(bin, offset) of each length, in the order given. Lengths are 1 to capacity."""
    lists: list[list[int]] = [[] for _ in range(capacity + 1)]
    bits = opened = made = 0
    for length in lengths:
        room = bits >> length
        if room:
            free = length + (room & -room).bit_length() - 1
            number = lists[free].pop()
            if not lists[free]:
                bits &= ~(1 << free)
        else:
            if opened == open_bins:
                fullest = (bits & -bits).bit_length() - 1
                lists[fullest].pop(0)
                if not lists[fullest]:
                    bits &= ~(1 << fullest)
                opened -= 1
            number, free = made, capacity
            made += 1
            opened += 1
        yield number, capacity - free
        if free > length:
            lists[free - length].append(number)
            bits |= 1 << (free - length)
        else:
            opened -= 1


def cuts(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, ...]:
    """(text, piece, start, length) of the pieces of texts of 1 and more; only a first one may be shorter than the capacity."""
    first = (lengths - 1) % capacity + 1
    counts = (lengths - first) // capacity + 1
    text = np.repeat(np.arange(len(lengths)), counts)
    piece = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = np.where(piece > 0, first[text] + (piece - 1) * capacity, 0)
    return text, piece, start, np.where(piece > 0, capacity, first[text])


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of one text."""
    _, _, start, lengths = cuts(np.array([length]), capacity)
    return list(zip(start.tolist(), lengths.tolist(), strict=True))


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of the documents' token ids: doc_id, row, piece, start, length and the checksum of the ids.

    A document's ids are those of its whole text (NULL counts as empty), then id 0. `row` tells rows
    that share a doc_id apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        names = ["doc_id", "row", "piece", "start", "length", "ids_crc32"]
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                flat, borders = encoder.ids(part.column(1), end=True)
                flat = memoryview(flat.astype("<u4")).cast("B")
                text, number, start, length = cuts(np.diff(borders), capacity)
                begin = 4 * (borders[text] + start)
                crc = [zlib.crc32(flat[a:b]) for a, b in zip(begin.tolist(), (begin + 4 * length).tolist(), strict=True)]
                arrays = [part.column(0).take(pa.array(text)), part.column(2).take(pa.array(text)), pa.array(number.astype(np.int32))]
                arrays += [pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names)

    numbered = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    return numbered.mapInArrow(run, PIECES)


def _packer(capacity: int, open_bins: int, turn: int, last: bool):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["mixed", "doc_id", "row", "piece"], kind="stable", na_position="first")
        lengths = group["length"].to_numpy()
        placed = np.array(list(pack(lengths.tolist(), capacity, open_bins)), dtype=np.int64).reshape(-1, 2)
        filled = np.bincount(placed[:, 0], weights=lengths)
        done = np.ones(len(group), bool) if last else filled[placed[:, 0]] * 100 >= FULL_PERCENT * capacity
        group["sequence_id"] = (turn << 58) + key[0] * ROUND + placed[:, 0]
        group["offset"] = placed[:, 1]
        group["done"] = done
        return group.drop(columns=["packer", "mixed"])

    return run


def best_fit(found: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """Pieces (columns as `pieces` gives them) with sequence_id and offset.

    A full piece is a sequence by itself. The others are packed in an order mixed by hash, which is
    the same in every run over the same pieces. An empty table gives no rows.
    """
    spark, place = found.sparkSession, run_dir(found.sparkSession, "packing")
    found.write.parquet(f"{place}/pieces")
    rest = spark.read.parquet(f"{place}/pieces")
    tokens = rest.agg(F.sum("length")).first()[0] or 0
    schema = f"{PIECES}, sequence_id long, offset long, done boolean"
    open_before = None
    for turn in range(ROUNDS):
        packers = max(1, -(-tokens // TOKENS_PER_PACKER))
        last = packers == 1
        mixed = rest.withColumn("mixed", F.xxhash64("doc_id", "row", "piece", F.lit(turn)))
        dealt = mixed.withColumn("packer", F.expr(f"pmod(mixed, {packers})"))
        packed = dealt.groupBy("packer").applyInPandas(_packer(capacity, open_bins, turn, last), schema)
        packed.write.parquet(f"{place}/turn={turn}")
        packed = spark.read.parquet(f"{place}/turn={turn}")
        kept = turn
        if last:
            break
        # Every sequence has one piece at offset 0.
        made = packed.where("offset = 0").agg(F.count("*"), F.count_if(~F.col("done"))).first()
        if open_before is not None and made[0] * 100 > open_before * (100 - SAVED_PERCENT):
            # Nothing to gain from a next round; of this one and the one before, the better stays.
            kept = turn if made[0] <= open_before else turn - 1
            break
        open_before = made[1]
        if not open_before:
            break
        rest = packed.where("NOT done").drop("sequence_id", "offset", "done")
        tokens = rest.agg(F.sum("length")).first()[0]
    every = spark.read.option("basePath", place).parquet(*[f"{place}/turn={t}" for t in range(kept + 1)])
    return every.where(F.col("done") | (F.col("turn") == kept)).drop("done", "turn")


def sequences(found: DataFrame) -> DataFrame:
    """(sequence_id, pieces, length): what each sequence holds, in order, for a writer of sequences."""
    piece = F.struct("offset", "doc_id", "row", "piece", "start", "length")
    return found.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(piece)).alias("pieces"), F.sum("length").alias("length")
    )
