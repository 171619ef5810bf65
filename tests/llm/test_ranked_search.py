"""Ranked search against scoring every document for every query in plain Python."""

import collections
import math
import random
import re

import numpy as np
import pytest

from riskloom.llm import ranked_search
from riskloom.llm.ranked_search import Shard, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, k):
    counted = [(d, collections.Counter(terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    total, length = len(counted), sum(n for *_, n in counted)
    df = collections.Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, counts, n in counted:
            m = 75 + 25 * n * total // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1_000_000_000 * counts[t] // (1000 * counts[t] + 12 * m))
                for t in terms(text)
                if t in counts
            )
            found.append((-score, doc is None, doc or 0, doc))
        best = sorted(f for f in found if f[0] < 0)[:k]
        out += [(item, rank + 1, f[3], -f[0]) for rank, f in enumerate(best)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)] + ["Été", "ÉTÉ", "straße", "x1", "日本"]
    docs = [(i, rng.choice([" ", "-", "\n", "_"]).join(rng.choices(vocabulary, k=rng.randrange(1, 60)))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, " .,_\x7f"), (303, "w1 " * 200_000), (None, "x1 w2 W2"), (305, docs[0][1]), docs[1], docs[1]]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 30)))) for i in range(25)]
    items += [(25, None), (26, "!"), (27, "unknown words"), (None, "w2 x1"), (0, "w1"), (0, "w1"), (28, "x1 X1 x1 w1")]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_every_document_in_plain_python(spark, texts, block_bytes):
    docs, items = texts
    table = spark.createDataFrame([(*d, 1, "own") for d in docs], "doc_id long, text string, n int, terms string").repartition(3)
    asked = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, query int")
    found = search(table, asked, 7, block_bytes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute(docs, items, 7)


def test_empty_tables(spark, texts):
    docs = spark.createDataFrame(texts[0], "doc_id long, text string")
    items = spark.createDataFrame(texts[1], "item_id long, text string")
    assert search(docs.limit(0), items).count() == 0
    assert search(docs, items.limit(0)).count() == 0
    assert search(docs.where("doc_id BETWEEN 300 AND 302"), items).count() == 0


def test_limited_accumulators_find_the_same():
    """Shards with few rare and many frequent terms, where creation stops early."""
    rng = np.random.default_rng(1)
    stopped = 0
    for _ in range(200):
        size, words = 400, 12
        held = rng.random((size, words)) < np.geomspace(0.03, 0.95, words)
        counts = rng.integers(1, 4, (size, words)) * held
        weights = np.geomspace(5000, rng.choice([3, 400]), words).astype(np.int64)
        n = counts.sum(1) + rng.integers(1, 20, size)
        doc, term = np.nonzero(counts)
        shard = Shard(n, held.sum(1), term, counts[doc, term].astype(np.int32), weights, size, int(n.sum()))
        m = 75 + (25 * n * size) // int(n.sum())
        repeats = rng.integers(1, 3, words)
        whole = (repeats * weights * ((1_000_000_000 * counts) // (1000 * counts + 12 * m[:, None]))).sum(1)
        floor = int(rng.choice([0, np.sort(whole)[-30]]))
        found, scores = shard.best(np.arange(words), repeats, 20, floor)
        kth = max(np.sort(whole)[-20], floor, 1)
        assert found.tolist() == np.flatnonzero(whole >= kth).tolist() and (scores == whole[found]).all()
        bounds = np.array([shard.most[t] * repeats[t] for t in range(words)])
        stopped += bounds[-3:].sum() < kth
    assert stopped > 50  # else the limit was never reached


def test_kth():
    assert ranked_search._kth(np.array([3, 9, 1]), 2) == 3 and ranked_search._kth(np.array([3]), 2) == 0
