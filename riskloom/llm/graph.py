"""Connected components of an edge table, by alternating stars, without collecting anything."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import run_dir

CHUNK = 1 << 20  # edges contracted at once


def components(edges: DataFrame, a: str = "a", b: str = "b", most: int = 60, chunk: int = CHUNK) -> DataFrame:
    """(node, component) for every node that has an edge to another; component = smallest node reached. Nodes are longs.

    Tasks contract their edges, `chunk` at a time: every node points to the smallest node that these reach.
    That shortens chains, and the edges of one chunk are done with. For more, each round points every node
    to the smallest node it sees, first for its larger neighbours, then for its smaller ones. The edges of a
    node are only ever aggregated to their minimum and joined, so a node with very many edges needs no task
    of its own. Rounds are written to the shared folder; few are wanted, since the exchanges of each take
    threads and plans in the driver.
    """
    spark = edges.sparkSession
    place = run_dir(spark, "components")
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    state = None
    for turn in range(most):
        now.mapInArrow(_contracted(chunk), "u long, v long").write.parquet(f"{place}/{turn}")
        now = spark.read.parquet(f"{place}/{turn}")
        before, state = state, tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            break
        if state[0] <= chunk:
            now.coalesce(1).mapInArrow(_contracted(chunk), "u long, v long").write.parquet(f"{place}/last")
            now = spark.read.parquet(f"{place}/last")
            break
        now = _stars(now, turn)
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _contracted(chunk: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of each `chunk` edges, an edge from every node to the smallest one they connect it with."""

    def stars(edges: list[np.ndarray]) -> pa.RecordBatch:
        nodes, root = smallest(*np.concatenate([np.zeros((2, 0), np.int64), *edges], axis=1))
        other = nodes != root
        return pa.RecordBatch.from_arrays([pa.array(nodes[other]), pa.array(root[other])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, room = [], chunk
        for batch in batches:
            edges = np.stack([column.to_numpy(zero_copy_only=False) for column in batch.columns])
            while edges.shape[1] >= room:
                yield stars([*gathered, edges[:, :room]])
                edges, gathered, room = edges[:, room:], [], chunk
            gathered.append(edges)
            room -= edges.shape[1]
        yield stars(gathered)

    return run


def smallest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of edges (a, b), sorted, and the smallest node that each of them reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    return nodes, nodes[root]


def _stars(edges: DataFrame, turn: int) -> DataFrame:
    """One large-star and one small-star step over edges u > v."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    )
    # Nodes keep their link to a smaller minimum, which the larger neighbours now share.
    large = large.unionAll(least.where("m < u").select("u", F.col("m").alias("v"))).distinct()
    minimum = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(minimum, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return small.unionAll(minimum.select("u", F.col("m").alias("v"))).distinct()
