"""Exact metric range join of vectors by pivots.

Unit vectors with cosine c lie sqrt(2 - 2c) apart, so a cosine threshold is a radius r. A vector's home is
the cell of its nearest pivot. It also visits the cell of pivot q if a vector of that cell can be within r: by the
triangle inequality its distances to q and to its own pivot then differ by at most 2r, and it lies
within r of the plane between the two. Cells so join independently: each vector meets all its partners in
its home cell. A task compares a block of a cell's homes with a block of all its vectors, which bounds its memory.

Equal vectors of a label are one class with a weight. A task returns sums per home and a spanning
forest of its links, never pairs. Pivots are a bounded sample; they decide the work, not the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import graph
from riskloom.llm.ngram_join import forest
from riskloom.llm.vectors import matrix_of, unit, usable, with_class
from riskloom.session import run_dir

COSINE = 0.93
CELL = 2048  # classes a cell should have
PIVOTS = 1024  # at most so many in all (expected; the sample's bound)
BLOCK = 2048
SLACK = 1e-9  # for rounding of distances, on the side of comparing more

CELLS = "label string, cell int, home boolean, cid long, weight long, block long, vector array<double>"


def _unit(rows) -> np.ndarray:
    return unit(matrix_of(rows))


def _cells(pivots, radius: float):
    """Home and visited cells of each class."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = {key: _unit(v) for key, v in pivots.value.items()}
        apart = {k: np.sqrt(np.maximum(2 - 2 * p @ p.T, 0)) for k, p in known.items()}
        for frame in frames:
            size = frame["vector"].map(len)
            for (label, dimension), part in frame.groupby(["label", size]):
                own = known.get((label, dimension))
                if own is None:
                    own, gap = np.zeros((1, dimension)), np.zeros((1, 1))
                else:
                    gap = apart[(label, dimension)]
                for low in range(0, len(part), 1024):
                    piece = part.iloc[low : low + 1024]
                    square = np.maximum(2 - 2 * _unit(piece["vector"]) @ own.T, 0)
                    home = square.argmin(1)
                    nearest = square[np.arange(len(piece)), home]
                    near = np.sqrt(square) - np.sqrt(nearest)[:, None] <= 2 * radius + SLACK
                    near &= square - nearest[:, None] <= 2 * radius * gap[home] + SLACK
                    near[np.arange(len(piece)), home] = True
                    row, cell = np.nonzero(near)
                    out = piece.iloc[row][["label", "cid", "weight", "vector"]].copy()
                    out["label"] = [f"{label}/{dimension}"] * len(row)
                    out["cell"] = cell.astype(np.int32)
                    out["home"] = cell == home[row]
                    out["block"] = 0
                    yield out

    return run


def _compare(cosine: float):
    def run(task: pd.DataFrame) -> pd.DataFrame:
        left = task[task["home"] & (task["hblock"] == task["i"])].drop_duplicates("cid")
        right = task[task["ablock"] == task["j"]].drop_duplicates("cid")
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": [], "weight": []}).astype("int64")
        x, y = _unit(left["vector"]), _unit(right["vector"])
        first, second = left["cid"].to_numpy(), right["cid"].to_numpy()
        weight, total, edges = right["weight"].to_numpy(), [], []
        for low in range(0, len(x), 512):
            linked = x[low : low + 512] @ y.T >= cosine
            linked &= first[low : low + 512, None] != second[None, :]
            total.append(linked @ weight)
            a, b = np.nonzero(linked)
            edges.append(forest(first[low + a], second[b]))
        sums = pd.DataFrame({"a": first, "b": first, "weight": np.concatenate(total).astype(np.int64)})
        edges = pd.concat(edges)
        edges = forest(edges["a"].to_numpy(), edges["b"].to_numpy())
        edges["weight"] = 0
        return pd.concat([sums[sums["weight"] > 0], edges]).astype("int64")

    return run


def range_join(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of vectors (vec_id, embedding, label).

    Rows with equal labels link if their cosine is at least `cosine`. n_links counts the other rows linked
    directly, component_id is the smallest vec_id reachable. A vector that is NULL, zero or has NULL or
    non-finite components, or whose label or vec_id is NULL, links with nothing. Only vectors of one
    length are compared. Rows that share a vec_id are different vectors.
    """
    spark, place = vectors.sparkSession, run_dir(vectors.sparkSession, "range")
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = rows.withColumn("part", usable("vector") & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    with_class(rows, ["label", "vector"]).write.parquet(f"{place}/rows")
    rows = spark.read.parquet(f"{place}/rows")
    narrow = rows.drop("vector")
    classes = narrow.where("part").groupBy("k1", "k2").agg(
        F.min("row").alias("cid"), F.min("vec_id").alias("least"), F.count("*").alias("weight")
    )
    classes.write.parquet(f"{place}/classes")
    classes = spark.read.parquet(f"{place}/classes")
    bodies = rows.select(F.col("row").alias("cid"), "label", "vector").join(classes.select("cid", "weight"), "cid")
    bodies.write.parquet(f"{place}/bodies")
    bodies = spark.read.parquet(f"{place}/bodies")

    count = bodies.count()
    share = min(1 / CELL, PIVOTS / max(count, 1))
    picked = bodies.where(F.pmod(F.xxhash64(F.lit(3), "cid"), F.lit(1 << 30)) < int(share * (1 << 30)))
    pivots: dict[tuple[str, int], list] = {}
    for row in picked.select("label", "vector").limit(2 * PIVOTS).toLocalIterator():
        pivots.setdefault((row["label"], len(row["vector"])), []).append(row["vector"])
    radius = float(np.sqrt(2 - 2 * cosine))
    shared = spark.sparkContext.broadcast(pivots)
    cells = bodies.repartition("cid").mapInPandas(_cells(shared, radius), CELLS).drop("block")
    cells.write.parquet(f"{place}/cells")
    cells = spark.read.parquet(f"{place}/cells")
    sizes = cells.groupBy("label", "cell").agg(
        F.ceil(F.count_if("home") / BLOCK).alias("homes"), F.ceil(F.count("*") / BLOCK).alias("alls")
    )
    numbered = (
        cells.join(sizes, ["label", "cell"])
        .where("homes > 0")
        .withColumn("hblock", F.expr("pmod(xxhash64(cid), homes)"))
        .withColumn("ablock", F.expr("pmod(xxhash64(cid), alls)"))
    )
    as_home = numbered.where("home").select("*", F.col("hblock").alias("i"), F.explode(F.expr("sequence(0L, alls - 1)")).alias("j"))
    as_any = numbered.select("*", F.explode(F.expr("sequence(0L, homes - 1)")).alias("i"), F.col("ablock").alias("j"))
    tasks = as_home.unionByName(as_any).select(
        "label", "cell", "i", "j", "home", "hblock", "ablock", "cid", "weight", "vector"
    )
    found = tasks.groupBy("label", "cell", "i", "j").applyInPandas(_compare(cosine), "a long, b long, weight long")
    found.write.parquet(f"{place}/found")
    found = spark.read.parquet(f"{place}/found")

    sums = found.where("a = b").groupBy(F.col("a").alias("cid")).agg(F.sum("weight").alias("others"))
    reached = graph.components(found.where("a <> b"), "a", "b")
    roots = classes.join(reached, F.col("cid") == F.col("node"), "left").select(
        "cid", "k1", "k2", "weight", "least", F.coalesce("component", "cid").alias("root")
    )
    smallest = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    facts = roots.join(smallest, "root").join(sums, "cid", "left").select(
        "k1", "k2", F.lit(True).alias("part"), (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"
    )
    joined = narrow.join(facts, ["k1", "k2", "part"], "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
