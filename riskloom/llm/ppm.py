"""Language-model scores by prediction by partial matching over bytes.

A text is the sequence of its words (A-Z as a-z) with a blank between, then an end mark; contexts
before its first byte hold end marks. Counts of all strings of ORDER + 1 bytes in the training texts, taken over
the whole corpus, hold the counts of all shorter contexts. A byte is looked for in the longest context seen
in training. If it never followed there, the model escapes to the next shorter context, with
probability D / 2T for T occurrences and D different followers, and the bytes that followed in the longer one are
excluded there; a byte seen n times has the probability (2n - 1) / 2T. After the empty context all bytes left are equally likely.

Counts are shuffled and summed by Spark. They are broadcast in parts of bounded size: a part has all contexts
whose last three bytes hash to it, and a share of the words, and the texts are read once for each
part. A text's score is the sum over the parts, the same however many there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import words as W
from riskloom.session import run_dir

ORDER = 5
SHORT = 2  # contexts up to so many bytes go with every part; there are at most 256 ** 3 strings of them
END = 0xFF  # occurs in no UTF-8 text
PART = 2_000_000  # strings, or words, of one part
GATHERED = 4_000_000
BATCH_BYTES = 1 << 20
SMOOTHING = 0.1


def stream_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One byte array of all texts, each after ORDER end marks and before one, and their starts."""
    lead = bytes([END]) * ORDER
    parts = [lead + b" ".join(t.lower().split()) + lead[:1] for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return np.frombuffer(b"".join(parts), np.uint8), starts


def grams(data: np.ndarray, starts: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The strings of order + 1 bytes that end at each scored byte, as integers, and the byte's text."""
    key = np.zeros(max(len(data) - order, 0), np.uint64)
    for k in range(order + 1):
        key = (key << np.uint64(8)) | data[k : len(data) - order + k]
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[order:]
    place = np.arange(order, len(data)) - starts[text]
    scored = place >= order
    return key[scored], text[scored]


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.concatenate([np.zeros(0, np.uint64), *keys]), np.concatenate([np.zeros(0, np.int64), *counts])
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
    return key[new], np.add.reduceat(n, new) if len(key) else n


def _batches(batch: pa.RecordBatch, column: int) -> Iterator[tuple[slice, list[bytes]]]:
    """Rows of a batch as lists of texts of about BATCH_BYTES together, at least one text each."""
    texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(column)]
    low = size = 0
    for row, text in enumerate(texts):
        size += len(text)
        if size >= BATCH_BYTES or row == len(texts) - 1:
            yield slice(low, row + 1), texts[low : row + 1]
            low, size = row + 1, 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, key, n): strings of bytes (0), words (1) and the number of texts (2)."""
    texts = 0
    found: dict[int, tuple[list, list]] = {0: ([], []), 1: ([], [])}

    def flush() -> Iterator[pa.RecordBatch]:
        for kind, (keys, counts) in found.items():
            key, n = _summed(keys, counts)
            keys.clear(), counts.clear()
            columns = [pa.array(np.full(len(key), kind, np.int32)), pa.array(key.view(np.int64)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["kind", "key", "n"])

    for batch in batches:
        for _, some in _batches(batch, 0):
            texts += len(some)
            data, starts = stream_of(some)
            joined = np.frombuffer(b"".join(some), np.uint8)
            bounds = np.concatenate([[0], np.cumsum([len(t) for t in some])])
            for kind, values in ((0, grams(data, starts)[0]), (1, W.words(joined, bounds).hash)):
                keys, n = np.unique(values, return_counts=True)
                found[kind][0].append(keys)
                found[kind][1].append(n.astype(np.int64))
                if sum(map(len, found[kind][0])) > GATHERED:
                    key, total = _summed(*found[kind])
                    found[kind] = ([key], [total])
                    if len(key) > GATHERED // 2:
                        yield from flush()
    yield from flush()
    last = [pa.array([2], pa.int32()), pa.array([0], pa.int64()), pa.array([texts], pa.int64())]
    yield pa.RecordBatch.from_arrays(last, ["kind", "key", "n"])


class Table:
    """Places of 64-bit keys, found by a hash and a short walk, for many keys at once."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(len(keys)).bit_length() - 1)
        bucket = self._bucket(keys)
        self.order = np.argsort(bucket, kind="stable")
        self.keys = np.concatenate([keys[self.order], np.zeros(1, np.uint64)])
        self.first = np.searchsorted(bucket[self.order], np.arange((1 << self.bits) + 1)).astype(np.int32)

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key in the sorted-by-bucket arrays, -1 if it has none."""
        bucket = self._bucket(keys)
        at, stop = self.first[bucket], self.first[bucket + 1]
        out = np.where((at < stop) & (self.keys[at] == keys), at, -1)
        rest = np.flatnonzero((out < 0) & (at + 1 < stop))
        while len(rest):
            at[rest] += 1
            hit = self.keys[at[rest]] == keys[rest]
            out[rest[hit]] = at[rest[hit]]
            rest = rest[~hit]
            rest = rest[at[rest] + 1 < stop[rest]]
        return out


class Model:
    """The context trie, from counts of strings of `order` + 1 bytes.

    The shortest contexts come from `short`, which every part has whole.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, short: tuple[np.ndarray, np.ndarray], order: int = ORDER):
        self.order = order
        self.levels: list[dict] = []
        for k in range(order + 1):
            source, n = (keys, counts) if k > SHORT else short
            mask = np.uint64((1 << (8 * (k + 1))) - 1)
            pair, n = _summed([source & mask], [n])
            context, first = np.unique(pair >> np.uint64(8), return_index=True)
            level = {"n": n, "total": np.add.reduceat(n, first) if len(n) else n}
            level["kinds"] = np.diff(np.concatenate([first, [len(pair)]]))
            if k:
                # What followed here has followed in the shorter context, too: its count there is excluded.
                below = self.levels[-1]
                at = below["pairs"].find(pair & (mask >> np.uint64(8)))
                over = below["sorted_n"][at]
                level["excluded"] = np.add.reduceat(over, first) if len(n) else n
            level["pairs"], level["contexts"] = Table(pair), Table(context)
            level["sorted_n"] = n[level["pairs"].order]
            for name in ("total", "kinds", *(["excluded"] if k else [])):
                level[name] = level[name][level["contexts"].order]
            del level["n"], level["pairs"].order, level["contexts"].order
            self.levels.append(level)
        top = self.levels[order]
        context = top["contexts"].find(top["pairs"].keys[:-1] >> np.uint64(8))
        self.direct = np.log10((2 * top["sorted_n"] - 1) / (2 * top["total"])[context]).astype(np.float32) if len(keys) else np.zeros(0)

    def scores(self, key: np.ndarray) -> np.ndarray:
        """log10 of the probability of the last byte of each string of order + 1 bytes, given the others."""
        out = np.zeros(len(key))
        at = self.levels[self.order]["pairs"].find(key)
        hit = at >= 0
        out[hit] = self.direct[at[hit]]
        rest = np.flatnonzero(~hit)
        less_n, less_kinds = np.zeros(len(rest), np.int64), np.zeros(len(rest), np.int64)
        for k in range(self.order, -1, -1):
            level = self.levels[k]
            own = key[rest] & np.uint64((1 << (8 * (k + 1))) - 1)
            context = level["contexts"].find(own >> np.uint64(8))
            seen = context >= 0
            pair = level["pairs"].find(own)
            total = np.where(seen, level["total"][context] if len(level["total"]) else 0, 0) - less_n
            kinds = np.where(seen, level["kinds"][context] if len(level["kinds"]) else 0, 0) - less_kinds
            there = pair >= 0
            out[rest[there]] += np.log10((2 * level["sorted_n"][pair[there]] - 1) / (2 * total)[there])
            escapes = seen & ~there & (kinds > 0)
            out[rest[escapes]] += np.log10(kinds[escapes] / (2 * total)[escapes])
            if not k:
                left = 256 - np.where(seen, level["kinds"][context] if len(level["kinds"]) else 0, 0)
                out[rest[~there]] -= np.log10(left[~there])
            elif len(level["excluded"]):
                less_n = np.where(seen, level["excluded"][context], 0)
                less_kinds = np.where(seen, level["kinds"][context], 0)
            else:
                less_n, less_kinds = np.zeros(len(rest), np.int64), np.zeros(len(rest), np.int64)
            rest, less_n, less_kinds = rest[~there], less_n[~there], less_kinds[~there]
        return out


def part_of(contexts: np.ndarray, parts: int) -> np.ndarray:
    """The part of strings, by the last three bytes of their contexts."""
    return (W.mix((contexts >> np.uint64(8)) & np.uint64(0xFFFFFF)) % np.uint64(parts)).astype(np.int64)


def _score(shared, part: int, parts: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = shared.value  # a worker keeps it, and so the model, from task to task
        if "model" not in state:
            keys, counts, short, known, often = state.pop("counts")
            state["model"], state["words"] = Model(keys, counts, short), Table(known)
            state["often"] = often[state["words"].order].astype(np.int32)
            del keys, counts, short, known, often, state["words"].order
        model, table, often, end, unseen = (state[k] for k in ("model", "words", "often", "end", "unseen"))
        for batch in batches:
            for rows, texts in _batches(batch, 2):
                data, starts = stream_of(texts)
                key, text = grams(data, starts)
                if parts > 1:
                    mine = part_of(key, parts) == part
                    key, text = key[mine], text[mine]
                score = np.bincount(text, weights=model.scores(key), minlength=len(texts))
                joined = np.frombuffer(b"".join(texts), np.uint8)
                found = W.words(joined, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
                word, doc = found.hash, found.doc
                if parts > 1:
                    mine = word % np.uint64(parts) == part
                    word, doc = word[mine], doc[mine]
                at = table.find(word)
                c = np.where(at >= 0, often[at] if len(often) else 0, 0)
                tokens = np.bincount(doc, minlength=len(texts))
                seen = np.bincount(doc, weights=c > 0, minlength=len(texts)).astype(np.int64)
                base = np.bincount(doc, weights=np.log10((c + SMOOTHING) / unseen), minlength=len(texts))
                if part == 0:  # the end mark
                    tokens, seen = tokens + 1, seen + int(end > 0)
                    base = base + np.log10((end + SMOOTHING) / unseen)
                columns = [batch.column(0)[rows], batch.column(1)[rows], tokens.astype(np.int64), seen, base, score]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c) for c in columns],
                    ["row", "doc_id", "n_tokens", "n_known", "base_score", "score"],
                )

    return run


def ppm_scores(docs: DataFrame, training: Column) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows for which `training` is true. NULL text is empty and scored as such, rows that share a
    doc_id stay apart, an empty table gives no rows; with no training text all bytes are equally likely.
    """
    spark, place = docs.sparkSession, run_dir(docs.sparkSession, "ppm")
    learned = docs.where(F.coalesce(training, F.lit(False))).select(F.col("text").cast("string").alias("text"))
    counted = learned.mapInArrow(_count, "kind int, key long, n long")
    counted.groupBy("kind", "key").agg(F.sum("n").alias("n")).write.parquet(f"{place}/counts")
    counts = spark.read.parquet(f"{place}/counts")
    facts = {r["kind"]: r for r in counts.groupBy("kind").agg(F.count("*").alias("rows"), F.sum("n").alias("n")).collect()}
    strings, kinds = (facts[k]["rows"] if k in facts else 0 for k in (0, 1))
    texts = facts[2]["n"] if 2 in facts else 0
    tokens = (facts[1]["n"] if 1 in facts else 0) + texts
    unseen = tokens + SMOOTHING * (kinds + (texts > 0) + 1)
    parts = max(1, -(-max(strings, kinds) // PART))

    low = (1 << (8 * (SHORT + 1))) - 1
    short = counts.where("kind = 0").groupBy(F.expr(f"key & {low}").alias("key")).agg(F.sum("n").alias("n")).toArrow()
    short = short["key"].to_numpy().view(np.uint64), short["n"].to_numpy()
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    schema = "row long, doc_id long, n_tokens long, n_known long, base_score double, score double"
    scored = []
    for part in range(parts):
        chosen = counts.where("kind < 2")
        if parts > 1:
            chosen = chosen.mapInArrow(_own_part(part, parts), "kind int, key long, n long")
        table = chosen.toArrow()
        kind, key, n = (table[c].to_numpy() for c in ("kind", "key", "n"))
        del table
        key = key.view(np.uint64)
        sides = (key[kind == 0], n[kind == 0], short, key[kind == 1], n[kind == 1])
        del kind, key, n
        shared = spark.sparkContext.broadcast({"counts": sides, "end": texts, "unseen": unseen})
        del sides
        scored.append(rows.mapInArrow(_score(shared, part, parts), schema))
    whole = scored[0]
    if parts > 1:
        sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
        whole = reduce(DataFrame.unionAll, scored).groupBy("row", "doc_id").agg(*sums)
    return whole.drop("row").withColumn("train_tokens", F.lit(tokens).cast("long"))


def _own_part(part: int, parts: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            word = batch.column(0).to_numpy(zero_copy_only=False) == 1
            own = np.where(word, key % np.uint64(parts) == part, part_of(key, parts) == part)
            yield batch.filter(pa.array(own))

    return run
