"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives, texts of any kind the unlabelled ones; no text counts as harmless. With
class prior p, the risk of a linear score is p * R(positives as 1) + max(0, R(unlabelled as 0) - p *
R(positives as 0)), R being the mean sigmoid loss. The part in the maximum estimates the risk of harmless texts;
where it turns negative, which is a sign of overfitting, the step goes the other way. Several classifiers are
trained in numpy, each in a task of its own on its own bootstrap sample, and a text's score is their mean.

Features are the distinct words of the whole text and the first letters of its longer words, hashed. Fitting uses at
most POSITIVES and about UNLABELLED texts; scoring reads all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import words as W

POSITIVES = 4000
UNLABELLED = 16000
MODELS = 4
FEATURES = 1 << 18
#: A feature is used if it is in this share of the positives at least, and more often there than among unlabelled
#: texts by this factor and by so many standard errors.
SHARE, LIFT, ERRORS = 0.01, 4.0, 4.0
STEM = 5  # bytes of a word's beginning
PART = 1 << 20  # bytes of text that are looked at together
STEPS = 800
RATE = 0.05

NO_LETTER = np.ones(256, bool)
NO_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("0"), ord("9") + 1)]] = False
NO_LETTER[128:] = False


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of the distinct features of each text, in order of text."""
    data, bounds = W.utf8(column)
    found = W.words(data, bounds, NO_LETTER)
    long = found.end - found.start > STEM
    stem = np.zeros(int(long.sum()), np.uint64)
    for k in range(STEM):
        stem = (stem << np.uint64(8)) | W.LOWER[data[found.start[long] + k]]
    hashed = np.concatenate([found.hash, W.mix(stem + np.uint64(1 << 60))])
    text = np.concatenate([found.doc, found.doc[long]])
    key = W.distinct(text.astype(np.int64) * FEATURES + (hashed % np.uint64(FEATURES)).astype(np.int64))
    return np.divmod(key, FEATURES)


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.parts(batches, 1, PART):
        text, feature = features(batch.column(1))
        borders = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(borders), pa.array(feature.astype(np.int32)))
        for model in range(MODELS):
            numbers = pa.array(np.full(batch.num_rows, model, np.int32))
            yield pa.RecordBatch.from_arrays([numbers, batch.column(0), batch.column(2), lists], ["model", "positive", "mixed", "features"])


def _sums(weights: np.ndarray, flat: np.ndarray, borders: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(weights[flat])])
    return total[borders[1:]] - total[borders[:-1]]


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(flat: np.ndarray, borders: np.ndarray, positive: np.ndarray, order: np.ndarray, prior: float, seed: int) -> tuple[np.ndarray, float]:
    """Weights of the features and the bias. Features are only ever evidence for a positive: no weight is negative.

    The features of text i are flat[borders[i]:borders[i + 1]]; `order` has the texts as they are to be seen.
    """
    useful = useful_features(flat, borders, positive)
    column = np.cumsum(useful) - 1  # place of a useful feature among them
    texts = (flat[borders[i] : borders[i + 1]] for i in order)
    rows = [column[text[useful[text]]] for text in texts]
    positive = positive[order]
    weights, bias = np.zeros(FEATURES), float(np.log(prior / (1 - prior)))
    theta = np.zeros(int(useful.sum()) + 1)
    theta[-1] = bias
    mean, square = np.zeros(len(theta)), np.zeros(len(theta))
    rng = np.random.default_rng(seed)
    own, other = np.flatnonzero(positive), np.flatnonzero(~positive)
    if not len(own) or not len(other):
        return weights, -30.0
    # A bootstrap sample of its own makes the classifiers differ.
    picked = np.concatenate([rng.choice(own, len(own)), rng.choice(other, len(other))])
    is_p = positive[picked]
    lengths = np.array([len(rows[i]) for i in picked])
    flat, borders = np.concatenate([rows[i] for i in picked]), np.concatenate([[0], np.cumsum(lengths)])
    share = np.where(is_p, prior / len(own), 1 / len(other))
    for step in range(1, STEPS + 1):
        q = _logistic(_sums(theta, flat, borders) + theta[-1])
        # The sigmoid loss is q as 0 and 1 - q as 1.
        harmless = (np.where(is_p, -share, share) * q).sum()
        rise = share * q * (1 - q)
        as_1, as_0 = np.where(is_p, -rise, 0), np.where(is_p, -rise, rise)
        slope = as_1 + as_0 if harmless >= 0 else -as_0
        gradient = np.bincount(flat, weights=np.repeat(slope, lengths), minlength=len(theta))
        gradient[-1] = slope.sum()
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient * gradient
        theta -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        np.maximum(theta[:-1], 0, out=theta[:-1])
    weights[useful], bias = theta[:-1], theta[-1]
    return weights, float(bias)


def useful_features(flat: np.ndarray, borders: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Which features speak for the positives, by SHARE, LIFT and ERRORS."""
    share, n = [], []
    for kind in (True, False):
        n.append(max(int((positive == kind).sum()), 1))
        counts = np.zeros(FEATURES, np.int64)
        for low in range(0, len(positive), 1000):  # the counts need wide integers, for some texts at a time
            high = min(low + 1000, len(positive))
            some = np.repeat(positive[low:high] == kind, np.diff(borders[low : high + 1]))
            counts += np.bincount(flat[borders[low] : borders[high]][some], minlength=FEATURES)
        share.append(counts / n[-1])
    both = (share[0] * n[0] + share[1] * n[1]) / sum(n)
    error = np.sqrt(np.maximum(both * (1 - both) * (1 / n[0] + 1 / n[1]), 1e-12))
    return (share[0] >= SHARE) & (share[0] >= LIFT * share[1]) & (share[0] - share[1] >= ERRORS * error)


def _train(prior: float):
    def run(sample: pa.Table) -> pa.Table:
        positive = sample["positive"].to_numpy()
        order = np.lexsort((positive, sample["mixed"].to_numpy()))
        model = sample["model"][0].as_py()
        lists = sample["features"].chunks
        flat = np.concatenate([x.flatten().to_numpy() for x in lists])
        borders = np.concatenate([[0], np.cumsum(np.concatenate([x.value_lengths().to_numpy() for x in lists]), dtype=np.int64)])
        del sample, lists
        weights, bias = fit(flat, borders, positive, order, prior, model)
        used = np.flatnonzero(weights)
        columns = [np.full(len(used) + 1, model, np.int32), np.concatenate([[-1], used]).astype(np.int32), np.concatenate([[bias], weights[used]])]
        return pa.table(columns, ["model", "feature", "weight"])

    return run


def _score(shared, keep: list[int], at: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for part in W.parts(batches, at, PART):
            text, feature = features(part.column(at))
            borders = np.searchsorted(text, np.arange(part.num_rows + 1))
            scores = np.zeros(part.num_rows)
            for weights, bias in models:
                scores += _logistic(_sums(weights, feature, borders) + bias) / len(models)
            yield pa.RecordBatch.from_arrays([*[part.column(k) for k in keep], pa.array(scores)], [*[part.schema.names[k] for k in keep], "score"])

    return run


def train(docs: DataFrame, labels: DataFrame, allowed: Column) -> list[tuple[np.ndarray, float]]:
    """Classifiers from docs (doc_id, text) and labels (doc_id, toxic), rows with `allowed` true only.

    `allowed` is an expression of doc_id. A document with any label 1 is a positive; the prior is the share of such among
    labelled documents. Without positives or other labelled documents nothing can be learned; the list is empty.
    """
    spark = docs.sparkSession
    known = (
        labels.where(allowed & F.col("toxic").isNotNull())
        .select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    count, toxic = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < toxic < count:
        return []
    positives = known.where("toxic = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(POSITIVES).select("doc_id")
    ids = [r[0] for r in positives.collect()]  # at most POSITIVES
    listed = spark.createDataFrame([(i,) for i in ids], "doc_id long").withColumn("positive", F.lit(True))
    texts = docs.where(allowed).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    total = texts.count()
    mixed = F.xxhash64(F.lit(5), "doc_id")
    limit = min(1.0, UNLABELLED / max(total, 1)) * (1 << 40)
    unlabelled = texts.where(F.pmod(mixed, F.lit(1 << 40)) < int(limit)).withColumn("positive", F.lit(False))
    confirmed = texts.join(F.broadcast(listed), "doc_id").select("doc_id", "text", "positive")
    # The order in which a classifier sees its texts comes from the texts, so it is the same whatever files they are in.
    sample = confirmed.unionByName(unlabelled).select("positive", "text", F.xxhash64(F.lit(6), "text").alias("mixed"))
    sample = sample.dropDuplicates(["positive", "text"])  # copies are no further evidence
    rows = sample.mapInArrow(_samples, "model int, positive boolean, mixed long, features array<int>")
    fitted = rows.groupBy("model").applyInArrow(_train(toxic / count), "model int, feature int, weight double")
    table = fitted.toPandas()  # at most MODELS * (FEATURES + 1) rows
    models = []
    for _, part in table.groupby("model"):
        weights = np.zeros(FEATURES)
        bias = part["feature"] < 0
        weights[part.loc[~bias, "feature"]] = part.loc[~bias, "weight"]
        models.append((weights, float(part.loc[bias, "weight"].iloc[0])))
    return models


def score(docs: DataFrame, models: list[tuple[np.ndarray, float]], texts: bool = False) -> DataFrame:
    """The columns of docs but `text`, which all are scored by, and `score` (0 to 1). With `texts` also `text`, as it is.

    NULL and empty texts have the score of a text without features. Without models every score is 0.
    """
    columns = [c for c in docs.columns if c != "text"]
    shown = [*columns, "text"] if texts else columns
    if not models:
        return docs.select(*shown, F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(models)
    ordered = docs.select(*columns, F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"`{c}` {ordered.schema[c].dataType.simpleString()}" for c in shown)
    return ordered.mapInArrow(_score(shared, list(range(len(shown))), len(columns)), f"{schema}, score double")
