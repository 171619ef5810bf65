"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard.

Vectors of similar length, within a factor of RATIO, are dealt to shards by hash. A shard's graph starts with random neighbours. Then, batch by batch and twice over,
a greedy beam search for each vector proposes neighbours; of these, nearest first, one is kept and those
that are nearer to it than to the vector by a factor alpha are dropped, which keeps edges in diverse directions.
Edges are also added backwards and pruned alike. A query searches every shard's graph with a
beam and the shards' results are merged.

Largest inner product becomes smallest distance by one more coordinate, sqrt(M^2 - |x|^2), M being the
shard's largest norm. As norms in a shard are similar, that coordinate does not outweigh the others. Vectors are
divided by M and queries by their own norm for it, which changes no order. Equal vectors are one node that keeps the smallest ids, as many as a result can show.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.vectors import matrix_of, norms, unit, usable, with_class
from riskloom.llm.words import stream
from riskloom.session import run_dir

NEAREST = 20
SHARD = 4096  # nodes a shard should have
DEGREE = 32
BEAM = 64
QUERY_BEAM = 128
ALPHA = 1.2
BATCH = 256
QUERY_BLOCK = 4096
STEP = 4  # nodes a beam expands at once
RATIO = 1.25  # between the norms in a shard


def lifted(matrix: np.ndarray) -> np.ndarray:
    """Vectors of length 1 among which smallest distance to (q, 0) is largest inner product with q."""
    scale, length = norms(matrix)
    scale = scale / scale.max()
    longest = (scale * length).max()
    own = matrix / np.abs(matrix).max() / longest
    square = np.minimum((scale * length / longest) ** 2, 1)
    return np.concatenate([own, np.sqrt(1 - square)[:, None]], 1)


def beam_search(points, links, start: int, queries, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids (-1 for none) and squared distances of the nearest found for each query, nearest first."""
    n, b = len(points), len(queries)
    seen = np.zeros((b, n), bool)
    seen[:, start] = True
    ids = np.full((b, width), -1)
    distance = np.full((b, width), np.inf, np.float32)
    open_ = np.zeros((b, width), bool)
    ids[:, 0], open_[:, 0] = start, True
    distance[:, 0] = ((points[start] - queries) ** 2).sum(1)
    squares, own = (points * points).sum(1), (queries * queries).sum(1)
    active = np.arange(b)
    while len(active):
        here = open_[active]
        # The beam is sorted, so the first open places are the nearest open nodes.
        nth = np.cumsum(here, 1)
        chosen = here & (nth <= STEP)
        row, place = np.nonzero(chosen)
        open_[active[row], place] = False
        near = links[ids[active[row], place]]
        owner = np.repeat(active[row], near.shape[1])
        near = near.ravel()
        fresh = near >= 0
        owner, near = owner[fresh], near[fresh]
        key = owner * n + near
        key = np.unique(key[~seen.ravel()[key]])
        if len(key):
            seen.ravel()[key] = True
            owner, near = np.divmod(key, n)
            d = squares[near] + own[owner] - 2 * np.einsum("ij,ij->i", points[near], queries[owner])
            counts = np.bincount(owner, minlength=b)
            most = counts.max()
            slot = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            more = np.full((b, most), -1)
            far = np.full((b, most), np.inf, np.float32)
            more[owner, slot], far[owner, slot] = near, d
            rows = np.flatnonzero(counts)
            all_ids = np.concatenate([ids[rows], more[rows]], 1)
            all_far = np.concatenate([distance[rows], far[rows]], 1)
            all_open = np.concatenate([open_[rows], more[rows] >= 0], 1)
            order = np.argsort(all_far, 1, kind="stable")[:, :width]
            ids[rows] = np.take_along_axis(all_ids, order, 1)
            distance[rows] = np.take_along_axis(all_far, order, 1)
            open_[rows] = np.take_along_axis(all_open, order, 1)
        active = np.flatnonzero(open_.any(1))
    return ids, distance


def prune(points, nodes, candidates, degree: int, alpha: float) -> np.ndarray:
    """Neighbours of each node, chosen among its candidates (-1 for none) by robust pruning."""
    out = np.full((len(nodes), degree), -1)
    candidates = np.where(candidates == nodes[:, None], -1, candidates)
    ordered = np.sort(candidates, 1)
    ordered[:, 1:][ordered[:, 1:] == ordered[:, :-1]] = -1  # each candidate once
    vectors = points[np.maximum(ordered, 0)]
    far = ((vectors - points[nodes][:, None, :]) ** 2).sum(2)
    far[ordered < 0] = np.inf
    order = np.argsort(far, 1, kind="stable")
    ordered, far = np.take_along_axis(ordered, order, 1), np.take_along_axis(far, order, 1)
    vectors = points[np.maximum(ordered, 0)]
    squares = (vectors * vectors).sum(2)
    between = squares[:, :, None] + squares[:, None, :] - 2 * vectors @ vectors.transpose(0, 2, 1)
    alive = ordered >= 0
    rows = np.arange(len(nodes))
    for k in range(degree):
        first = alive.argmax(1)
        some = alive[rows, first]
        if not some.any():
            break
        out[some, k] = ordered[some, first[some]]
        alive &= ~(alpha * alpha * between[rows, first] <= far)
        alive[rows, first] = False
    return out


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """(links, start): a directed graph with at most `degree` links per node, -1 for none."""
    n = len(points)
    start = int(((points - points.mean(0)) ** 2).sum(1).argmin())
    degree = max(1, min(degree, n - 1))
    links = (stream(11, n * degree) % np.uint64(max(n, 1))).astype(np.int64).reshape(n, degree)
    links[links == np.arange(n)[:, None]] = -1
    for pass_alpha in (1.0, alpha):
        order = np.argsort(stream(13, n), kind="stable")
        for low in range(0, n, BATCH):
            nodes = order[low : low + BATCH]
            found, _ = beam_search(points, links, start, points[nodes], beam)
            links[nodes] = prune(points, nodes, np.concatenate([found, links[nodes]], 1), degree, pass_alpha)
            _add_back(points, links, nodes, degree, pass_alpha)
    return links, start


def _add_back(points, links, nodes, degree: int, alpha: float) -> None:
    source = np.repeat(nodes, degree)
    target = links[nodes].ravel()
    source, target = source[target >= 0], target[target >= 0]
    known = (links[target] == source[:, None]).any(1)
    source, target = source[~known], target[~known]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    at, first, counts = np.unique(target, return_index=True, return_counts=True)
    if not len(at):
        return
    more = np.full((len(at), counts.max()), -1)
    more[np.repeat(np.arange(len(at)), counts), np.arange(len(target)) - np.repeat(first, counts)] = source
    for low in range(0, len(at), BATCH):
        some = slice(low, low + BATCH)
        width = counts[some].max()
        both = np.concatenate([links[at[some]], more[some, :width]], 1)
        full = (both >= 0).sum(1) > degree
        roomy = ~full
        if roomy.any():
            links[at[some][roomy]] = -np.sort(-both[roomy], 1)[:, :degree]
        if full.any():
            links[at[some][full]] = prune(points, at[some][full], both[full], degree, alpha)


def _index(shard: pd.DataFrame) -> pd.DataFrame:
    shard = shard.sort_values("node", kind="stable")
    matrix = matrix_of(shard["vector"])
    links, start = build(lifted(matrix).astype(np.float32))
    shard["links"] = [row[row >= 0].tolist() for row in links]
    shard["number"] = np.arange(len(shard))
    shard["entry"] = shard["number"] == start
    return shard


def _search(nearest: int, beam: int):
    def run(_: tuple, nodes: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        columns = {"query_id": [], "vec_id": [], "score": []}
        if len(nodes) and len(queries):
            nodes = nodes.sort_values("number", kind="stable")
            matrix = matrix_of(nodes["vector"])
            points = lifted(matrix).astype(np.float32)
            links = np.full((len(nodes), max(1, nodes["links"].map(len).max())), -1)
            for row, near in enumerate(nodes["links"]):
                links[row, : len(near)] = near
            start = int(nodes["number"].to_numpy()[nodes["entry"].to_numpy()][0])
            members = [list(m) for m in nodes["members"]]
            for low in range(0, len(queries), BATCH):
                part = queries.iloc[low : low + BATCH]
                wanted = matrix_of(part["vector"])
                lifted_queries = np.concatenate([unit(wanted), np.zeros((len(wanted), 1))], 1).astype(np.float32)
                found, _far = beam_search(points, links, start, lifted_queries, beam)
                for query, vector, row in zip(part["query_id"], wanted, found, strict=True):
                    row = row[row >= 0]
                    scores = (matrix[row] * vector).sum(1)
                    best: dict[int, float] = {}  # of rows that share an id the nearest
                    for s, r in zip(scores, row, strict=True):
                        for m in members[r]:
                            best[m] = max(best.get(m, s), s)
                    best.pop(query, None)
                    for score, member in sorted((-s, m) for m, s in best.items())[:nearest]:
                        columns["query_id"].append(query)
                        columns["vec_id"].append(member)
                        columns["score"].append(-score)
        return pd.DataFrame(columns).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def build_index(vectors: DataFrame, folder: str, nearest: int = NEAREST) -> DataFrame:
    """Write the graphs of vectors (vec_id, embedding) and return them: one row per distinct vector.

    (shard, node, number, vector, members, links, entry). Rows that take no part are left out: NULL vec_id, and
    vectors that are NULL, empty, zero or have NULL or non-finite components. Vectors of different length
    are in different shards. `members` are the `nearest` + 1 smallest ids with that vector.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    ).where(F.col("vec_id").isNotNull() & usable("vector"))
    keyed = with_class(rows, ["vector"]).dropDuplicates(["k1", "k2", "vec_id"])
    # Spark cuts each group to its first rows before the shuffle, so a frequent vector is no large group.
    first = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("vec_id"))
    few = keyed.withColumn("n", first).where(F.col("n") <= nearest + 1)
    nodes = few.groupBy("k1", "k2").agg(
        F.sort_array(F.collect_list("vec_id")).alias("members"), F.any_value("vector").alias("vector")
    )
    # The logarithm of the norm, from the largest component and the others relative to it.
    largest = F.array_max(F.transform("vector", F.abs))
    nodes = nodes.withColumn("largest", largest).withColumn(
        "norm", F.expr("ln(largest) + 0.5 * ln(aggregate(vector, 0D, (s, x) -> s + (x / largest) * (x / largest)))")
    )
    level = F.floor(F.col("norm") / math.log(RATIO)).alias("level")
    nodes = nodes.select(F.col("members")[0].alias("node"), "members", "vector", F.size("vector").alias("d"), level, "k1")
    nodes.write.parquet(f"{folder}/nodes")
    nodes = spark.read.parquet(f"{folder}/nodes")
    shards = nodes.groupBy("d", "level").agg(F.ceil(F.count("*") / SHARD).alias("shards"))
    dealt = nodes.join(shards, ["d", "level"]).withColumn("shard", F.expr("concat(d, '/', level, '/', pmod(k1, shards))"))
    schema = "shard string, node long, members array<long>, vector array<double>, links array<int>, number int, entry boolean"
    dealt = dealt.select("shard", "node", "members", "vector")
    dealt.groupBy("shard").applyInPandas(_index, schema).write.parquet(f"{folder}/graph")
    return spark.read.parquet(f"{folder}/graph")


def search(graph: DataFrame, queries: DataFrame, nearest: int = NEAREST, beam: int = QUERY_BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score) of the nearest found for queries (query_id, vector), in blocks.

    A query's own vec_id is left out; ties go to the smaller vec_id.
    """
    shards = graph.select("shard").distinct().withColumn("d", F.split("shard", "/")[0].cast("int"))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    asked = queries.withColumn("block", F.expr(f"pmod(xxhash64(query_id), {blocks})")).withColumn("d", F.size("vector"))
    asked = asked.join(shards, "d").select("shard", "block", "query_id", "vector")
    # New names, as the queries' shard column comes from the same table.
    nodes = graph.select(F.col("shard").alias("of"), "number", "vector", "members", "links", "entry")
    nodes = nodes.withColumn("turn", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")))
    found = (
        nodes.groupBy("of", "turn")
        .cogroup(asked.groupBy("shard", "block"))
        .applyInPandas(_search(nearest, beam), "query_id long, vec_id long, score double")
    )
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))  # an id may have rows in several shards
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def nearest_rows(vectors: DataFrame, every: int, nearest: int = NEAREST) -> DataFrame:
    """The nearest of each row whose vec_id is divisible by `every`, among all rows of another vec_id.

    Rows that share a vec_id are candidates each, and the nearest of them stands for the id, which a query lists once. Of
    query rows that share a vec_id the one with the least vector, component by component, is asked.
    """
    graph = build_index(vectors, run_dir(vectors.sparkSession, "graph"), nearest)
    queries = vectors.select(
        F.col("vec_id").cast("long").alias("query_id"), F.col("embedding").cast("array<double>").alias("vector")
    ).where(F.col("query_id").isNotNull() & usable("vector") & (F.col("query_id") % every == 0))
    return search(graph, queries.groupBy("query_id").agg(F.min("vector").alias("vector")), nearest)
