"""Ranked lexical search, term at a time with a limited set of accumulators.

Terms are the longest runs of ASCII letters and digits and of any other characters than ASCII, A-Z as a-z. One pass over
the texts counts every document's terms and how often it holds each term of the queries; from that come the number of
documents and terms and each term's document frequency, over all documents. A document's score for a query sums, over the
query's terms, repeats included, weight * ((10^9 * tf) div (1000 * tf + 12 * m)) with weight = floor(1000 * ln((2N + 2) /
(2df + 1))) and m = 75 + (25 * n * N) div L, in 64-bit integers.

The documents of an Arrow batch are a shard with its own inverted lists. For each query a shard takes the terms
from the rarest on and adds to an accumulator per document. The largest contributions in the lists still to come bound what a
document without an accumulator can reach. Once that is less than the k-th largest partial score, or than the k-th
result of the shards the task has seen, no accumulator is created any more; those there are are carried on exactly. A task
keeps k results per query, Spark merges the tasks' results.

The queries go to the tasks in blocks of about BLOCK_BYTES of text, however many there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import words as W
from riskloom.session import run_dir

NEAREST = 20
BLOCK_BYTES = 4 << 20
ROWS = 1000  # texts cut into terms at once

NO_TERM = np.ones(256, bool)
NO_TERM[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = False
NO_TERM[128:] = False

INDEX = "doc_id long, n long, terms array<int>, counts array<int>"


def term_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all terms of the texts in order, and the borders of each text's."""
    data, bounds = W.utf8(column)
    found = W.words(data, bounds, NO_TERM)
    return found.hash, found.borders(len(bounds) - 1)


def _count(shared):
    """Per document with a term: how many it has, and which of the queries' terms how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                hashes, borders = term_hashes(part.column(1))
                place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                known = vocabulary[place] == hashes
                text = np.repeat(np.arange(part.num_rows), np.diff(borders))
                key, counts = np.unique(text[known] * len(vocabulary) + place[known], return_counts=True)
                text, term = np.divmod(key, len(vocabulary))
                at = pa.array(np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32))
                terms = pa.ListArray.from_arrays(at, pa.array(term.astype(np.int32)))
                counts = pa.ListArray.from_arrays(at, pa.array(counts.astype(np.int32)))
                n = np.diff(borders)
                rows = pa.RecordBatch.from_arrays([part.column(0), pa.array(n), terms, counts], ["doc_id", "n", "terms", "counts"])
                yield rows.filter(pa.array(n > 0))

    return run


def _frequencies(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "df"])

    return run


class Shard:
    """Inverted lists of some documents: per term the documents in order and what the term adds to their score."""

    def __init__(self, n, sizes, terms, counts, weights: np.ndarray, documents: int, length: int):
        m = 75 + (25 * n * documents) // length
        owner = np.repeat(np.arange(len(n)), sizes)
        order = np.argsort(terms, kind="stable")
        terms, owner, counts = terms[order], owner[order], counts[order].astype(np.int64)
        self.adds = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 12 * m[owner]))
        self.owner = owner
        self.term, first = np.unique(terms, return_index=True)
        self.borders = np.append(first, len(terms))
        self.most = np.maximum.reduceat(self.adds, first) if len(first) else np.zeros(0, np.int64)
        self.size = len(n)

    def best(self, query: np.ndarray, repeats: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) that may be among the k best, `query` being terms from the rarest on.

        Every document that scores more than 0, at least `floor` and no less than the k-th is among them.
        """
        place = np.searchsorted(self.term, query)
        here = place < len(self.term)
        here[here] = self.term[place[here]] == query[here]
        place, repeats = place[here], repeats[here]
        bounds = self.most[place] * repeats
        left = np.append(np.cumsum(bounds[::-1])[::-1], 0)  # what this and later terms can add
        scores = np.zeros(self.size, np.int64)
        survivors = None
        for i, (at, times) in enumerate(zip(place, repeats, strict=True)):
            # No partial score exceeds what the terms so far can add.
            if survivors is None and left[i] < max(floor, left[0] - left[i]) and left[i] < max(floor, _kth(scores, k)):
                survivors = np.flatnonzero(scores)
            documents = self.owner[self.borders[at] : self.borders[at + 1]]
            adds = self.adds[self.borders[at] : self.borders[at + 1]] * times
            if survivors is None:
                scores[documents] += adds
            elif len(survivors) * 8 < len(documents):
                found = np.minimum(np.searchsorted(documents, survivors), len(documents) - 1)
                both = documents[found] == survivors
                scores[survivors[both]] += adds[found[both]]
            else:
                live = scores[documents] > 0
                scores[documents[live]] += adds[live]
        documents = np.flatnonzero(scores >= max(floor, _kth(scores, k), 1))
        return documents, scores[documents]


def _kth(scores: np.ndarray, k: int) -> int:
    """The k-th largest, 0 if there are fewer."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def _search(shared, k: int):
    """The k best of a task's documents for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights, documents, length = shared.value
        kept: list[list[tuple]] = [[] for _ in queries]
        for batch in batches:
            sizes = np.diff(np.asarray(batch.column(2).offsets))
            flat = [batch.column(c).flatten().to_numpy() for c in (2, 3)]
            shard = Shard(batch.column(1).to_numpy(), sizes, *flat, weights, documents, length)
            ids = batch.column(0)
            for number, (_, terms, repeats) in enumerate(queries):
                best = kept[number]
                found, scores = shard.best(terms, repeats, k, -best[-1][0] if len(best) == k else 0)
                if len(found):
                    # Ties by doc_id, NULL last.
                    named = zip(scores.tolist(), ids.take(pa.array(found)).to_pylist(), strict=True)
                    kept[number] = sorted([*best, *((-s, d is None, d or 0, d) for s, d in named)], key=lambda r: r[:3])[:k]
        rows = [(number, -s, d) for number, best in enumerate(kept) for s, _, _, d in best]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        types = [pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["number", "score", "doc_id"])

    return run


def search(docs: DataFrame, queries: DataFrame, nearest: int = NEAREST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score) of the `nearest` documents of docs (doc_id, text) for queries (item_id, text).

    Only scores above 0 count; equal scores are ranked by doc_id, NULL last. Each row of queries is a query of its own and
    each row of docs a document of its own, so equal rows stand side by side. NULL and empty texts have no terms; they find
    nothing, are not found and are no document in the counts. Other columns are left out; without documents or queries there are
    no rows.
    """
    spark = docs.sparkSession
    place = run_dir(spark, "ranked-search")
    asked = queries.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    asked.withColumn("query", F.monotonically_increasing_id()).write.parquet(f"{place}/queries")
    asked = spark.read.parquet(f"{place}/queries")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    out = None
    for block in range(blocks):
        some = asked.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).select("item_id", "text")
        found = _searched(docs, some.toArrow(), nearest, f"{place}/index-{block}")  # about block_bytes
        out = found if out is None else out.unionByName(found)
    return out


def _searched(docs: DataFrame, asked: pa.Table, nearest: int, folder: str) -> DataFrame:
    spark = docs.sparkSession
    hashes, borders = term_hashes(asked.column("text"))
    vocabulary = np.unique(hashes)
    shape = "item_id long, rank int, doc_id long, score long"
    if not len(vocabulary):
        return spark.createDataFrame([], shape)
    context = spark.sparkContext
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts.mapInArrow(_count(context.broadcast(vocabulary)), INDEX).write.parquet(folder)
    index = spark.read.schema(INDEX).parquet(folder)
    documents, length = index.agg(F.count("*"), F.sum("n")).first()
    held = index.where("size(terms) > 0")
    df = np.zeros(len(vocabulary), np.int64)
    counted = held.select("terms").mapInArrow(_frequencies(len(df)), "term long, df long")
    for row in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():  # at most the vocabulary of the queries
        df[row["term"]] = row["df"]
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    plan = []
    for row, item in enumerate(asked.column("item_id").to_pylist()):
        own = np.searchsorted(vocabulary, hashes[borders[row] : borders[row + 1]])
        terms, repeats = np.unique(own, return_counts=True)
        order = np.argsort(df[terms], kind="stable")
        plan.append((item, terms[order], repeats[order]))
    shared = context.broadcast((plan, weights, documents, length))
    names = spark.createDataFrame([(number, p[0]) for number, p in enumerate(plan)], "number int, item_id long")
    found = held.mapInArrow(_search(shared, nearest), "number int, score long, doc_id long")
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
    return ranked.join(names, "number").select("item_id", "rank", "doc_id", "score")
