"""N-gram Jaccard join by filtering under several global token orders.

Two texts with similarity t or more share a token among the first n - ceil(t * n) + 1 tokens of each,
whatever order the tokens are put in, as long as it is the same for all texts. Three orders are used:

1. by hash, with frequent shingles last. Prefixes longer by k - 1 tokens share at least k tokens
   (`counted_prefix`). A text that has fewer prefix tokens in common with all other texts together has
   no partner and is done with, though it may share a passage or a line with many. This is settled
   from a quarter of all shingles.
2. rarest first, ties by hash. Frequencies are exact counts over the texts that are left.
3. rarest first, ties by descending hash.

What still shares prefix tokens falls into small cells (components of shared tokens under order 2).
Cells are cut into blocks; a task compares two blocks, drops pairs that share no prefix token under
order 2 or order 3, counts the common shingles of the others exactly and returns a spanning forest of
its links, so that a group of copies gives as many rows as it has members. Texts with the same words
are one class from the start and are not compared with each other.

Shingles are 64-bit hashes; that two different ones of a compared pair meet is left to chance (2**-64).
The list of frequent shingles and the filter of remaining texts have documented sizes. Both only
decide how much work is left to later steps, never the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import graph
from riskloom.llm import words as W
from riskloom.session import arrow_rows, run_dir

SIZE = 5
PERCENT = 80
FREQUENT = 1 << 19  # shingles that go last in the first order
GATHERED = 8_000_000  # shingles a task counts at once to find repeated ones
FILTER_BITS = 1 << 25  # bits of the filter that tells which texts are left
BATCH = 1000  # texts of an Arrow batch
PART = 1 << 20  # bytes of text that are looked at together
BLOCK = 256  # texts of one side of a comparing task


def counted_prefix(n: int, percent: int) -> tuple[int, int]:
    """Length of the prefix of a set of n under the first order, and how many of its tokens a partner's prefix has.

    With k more tokens than are surely not common, a prefix holds the first k common tokens. The k of a set grows
    with its size, so of two partners the smaller one's k counts, and a set of n has none smaller than `common`.
    """

    def k(size: int) -> int:
        return max(1, min(1 + size * (100 - percent) // 400, (size * percent + 99) // 100))

    common = (n * percent + 99) // 100
    return min(n, n - common + k(n)), k(common)


class _Sets:
    """The shingle sets of a batch of texts."""

    def __init__(self, batch: pa.RecordBatch, size: int):
        self.ids = batch.column(0)
        data, bounds = W.utf8(batch.column(1))
        self.docs = len(bounds) - 1
        found = W.words(data, bounds)
        self.first, self.second = (x.view(np.int64) for x in W.sequence_ids(found, self.docs))
        self._hashes, self._borders = W.runs(found, self.docs, size)

    def of(self, row: int) -> np.ndarray:
        return W.distinct(self._hashes[self._borders[row] : self._borders[row + 1]])


def _lists(values: list[np.ndarray]) -> pa.Array:
    borders = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.uint64), *values]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(flat, pa.int64()))


def _summary(size: int) -> Callable:
    """Per text its class and set size; per task the shingles that several of its classes have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        gathered: list[np.ndarray] = []
        names = ["doc_id", "cid", "second", "n", "token", "copies"]

        def repeated() -> pa.RecordBatch:
            together = np.concatenate([np.zeros(0, np.uint64), *gathered])
            gathered.clear()
            values, counts = np.unique(together, return_counts=True)
            values, counts = values[counts > 1].view(np.int64), counts[counts > 1]
            none = pa.nulls(len(values), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, none, none, pa.array(values), pa.array(counts)], names)

        for batch in W.parts(batches, 1, PART):
            sets, n = _Sets(batch, size), []
            for row in range(sets.docs):
                shingles = sets.of(row)
                n.append(len(shingles))
                if (cid := int(sets.first[row])) not in seen:
                    seen.add(cid)
                    gathered.append(shingles)
            none = pa.nulls(sets.docs, pa.int64())
            columns = [sets.ids.cast(pa.int64()), pa.array(sets.first), pa.array(sets.second)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64()), none, none], names)
            if sum(map(len, gathered)) > GATHERED:
                yield repeated()
                seen.clear()
        yield repeated()

    return run


def _prefixes(size: int, percent: int, frequent) -> Callable:
    """Per class the prefix of its set under the first order, and how many of its tokens must be shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = frequent.value
        seen: set[int] = set()
        for batch in W.parts(batches, 1, PART):
            sets, cids, needs, prefixes = _Sets(batch, size), [], [], []
            for row in range(sets.docs):
                cid = int(sets.first[row])
                shingles = sets.of(row)
                if cid in seen or not len(shingles):
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(cid)
                wanted, need = counted_prefix(len(shingles), percent)
                at = np.minimum(np.searchsorted(known, shingles), max(len(known) - 1, 0))
                often = known[at] == shingles if len(known) else np.zeros(len(shingles), bool)
                prefix = shingles[~often][:wanted]
                if len(prefix) < wanted:
                    late = shingles[often][np.argsort(rank[at[often]], kind="stable")]
                    prefix = np.concatenate([prefix, late[: wanted - len(prefix)]])
                cids.append(cid)
                needs.append(need)
                prefixes.append(prefix)
            columns = [pa.array(cids, pa.int64()), pa.array(needs, pa.int32()), _lists(prefixes)]
            yield pa.RecordBatch.from_arrays(columns, ["cid", "need", "tokens"])

    return run


def _wanted_sets(size: int, kept) -> Callable:
    """Whole sets of the texts whose class passes the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = kept.value
        for batch in W.parts(batches, 1, PART):
            sets = _Sets(batch, size)
            at = W.mix(sets.first.view(np.uint64)) % np.uint64(len(bits) * 64)
            hit = (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)
            rows = [r for r in np.flatnonzero(hit) if len(sets.of(r))]
            picked = [sets.of(r) for r in rows]
            ids = sets.ids.cast(pa.int64()).take(pa.array(rows, pa.int64()))
            n = pa.array([len(s) for s in picked], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sets.first[rows]), n, _lists(picked)], ["doc_id", "cid", "n", "tokens"]
            )

    return run


def _filter_of(classes: DataFrame):
    """A bit per hashed class, FILTER_BITS in all. A class that is not meant may pass; it does no harm."""
    spark = classes.sparkSession
    bits = np.zeros(FILTER_BITS // 64, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = W.mix(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)) % np.uint64(FILTER_BITS)
            at = W.distinct(at)
            word = (at >> np.uint64(6)).astype(np.int64)
            mask = (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(mask)], ["word", "mask"])

    words = classes.select("cid").mapInArrow(run, "word long, mask long")
    table = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits[table["word"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(bits)


def _frequent(often: DataFrame, path: str):
    """Broadcast of at most FREQUENT tokens, sorted, and their counts: all that have a count or more."""
    spark = often.sparkSession
    often.write.parquet(path)
    often = spark.read.parquet(path)
    level = F.floor(F.log2("copies") * 16)
    steps = often.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect()
    least, total = None, 0
    for step in steps:  # a few hundred at most
        total += step["n"]
        if total > FREQUENT:
            break
        least = step["level"]
    top = often.where(level >= (least if least is not None else 1 << 30)).toArrow()
    known, copies = top["token"].to_numpy().view(np.uint64), top["copies"].to_numpy()
    order = np.argsort(known)
    return spark.sparkContext.broadcast((known[order], copies[order].astype(np.int32)))


def _shared(rows: DataFrame) -> DataFrame:
    """Rows (token, cid, ...) of tokens that several classes have, each class once, with `df`."""
    by_token = Window.partitionBy("token")
    again = F.lag("cid").over(by_token.orderBy("cid")).eqNullSafe(F.col("cid"))
    single = rows.withColumn("_again", again).where("NOT _again").drop("_again")
    return single.withColumn("df", F.count("*").over(by_token)).where("df > 1")


def _compare(percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def incidence(left: list, right: list) -> np.ndarray:
        """Common tokens of every left set with every right set."""
        lengths = [len(x) for x in (*left, *right)]
        tokens = np.concatenate([np.zeros(0, np.int64), *left, *right])
        owner = np.repeat(np.arange(len(lengths)), lengths)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        new = np.concatenate([[True], tokens[1:] != tokens[:-1]]) if len(tokens) else np.zeros(0, bool)
        column = np.cumsum(new) - 1
        often = np.bincount(column, minlength=1)[column] > 1 if len(tokens) else new
        column, owner = column[often], owner[often]
        column = np.cumsum(np.concatenate([[0], (np.diff(column) > 0).astype(np.int64)])) if len(column) else column
        out = np.zeros((len(left), len(right)), np.float32)
        step = 4096
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, step):
            a, b = np.searchsorted(column, [low, low + step])
            grid = np.zeros((len(lengths), step), np.float32)
            grid[owner[a:b], column[a:b] - low] = 1
            out += grid[: len(left)] @ grid[len(left) :].T
        return out

    def run(task: pd.DataFrame) -> pd.DataFrame:
        task = task.drop_duplicates("cid")
        left, right = task[task["block"] == task["i"]], task[task["block"] == task["j"]]
        sizes = left["n"].to_numpy(), right["n"].to_numpy()
        fits = sizes[0][:, None] * 100 >= percent * sizes[1][None, :]
        fits &= sizes[1][None, :] * 100 >= percent * sizes[0][:, None]
        fits &= left["cid"].to_numpy()[:, None] != right["cid"].to_numpy()[None, :]
        for order in ("second", "third"):
            if fits.any():
                fits &= incidence(list(left[order]), list(right[order])) > 0
        rows, columns = np.flatnonzero(fits.any(1)), np.flatnonzero(fits.any(0))
        if not len(rows):
            return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
        common = incidence([left["tokens"].iloc[r] for r in rows], [right["tokens"].iloc[c] for c in columns])
        common = np.rint(common).astype(np.int64)
        union = sizes[0][rows][:, None] + sizes[1][columns][None, :] - common
        linked = (100 * common >= percent * union) & fits[np.ix_(rows, columns)]
        a, b = np.nonzero(linked)
        first, second = left["cid"].to_numpy()[rows][a], right["cid"].to_numpy()[columns][b]
        return forest(first, second)

    return run


def forest(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """Edges (a, b) that connect all that the given edges connect, fewer than there are nodes."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            parent[p] = q
            kept.append((x, y))
    return pd.DataFrame(kept, columns=["a", "b"], dtype="int64")


def ngram_join(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id), one row per row of docs (doc_id, text).

    `class_id` is the same for texts with the same words, `component_id` the smallest doc_id reachable
    by links of at least `percent` per cent Jaccard similarity of the sets of `size` word shingles.
    A NULL text is empty; a text without words has 0 shingles, links with nothing and is its own
    component. Rows with a NULL doc_id get a NULL component_id and link with nothing. Rows that share
    a doc_id are one node. Extra columns are ignored.
    """
    spark, place = docs.sparkSession, run_dir(docs.sparkSession, "ngram")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, cid long, second long, n long, token long, copies long"
    with arrow_rows(spark, BATCH):
        texts.mapInArrow(_summary(size), schema).write.parquet(f"{place}/summary")
    summary = spark.read.parquet(f"{place}/summary")
    members = summary.where("n IS NOT NULL").select("doc_id", "cid", "second", "n")

    often = summary.where("token IS NOT NULL").groupBy("token").agg(F.sum("copies").alias("copies"))
    frequent = _frequent(often, f"{place}/often")

    named = texts.where("doc_id IS NOT NULL")
    prefixes = named.mapInArrow(_prefixes(size, percent, frequent), "cid long, need int, tokens array<long>")
    shared = _shared(prefixes.select(F.explode("tokens").alias("token"), "cid", "need"))
    with arrow_rows(spark, BATCH):
        enough = shared.groupBy("cid").agg(F.count("*").alias("k"), F.min("need").alias("need")).where("k >= need")
        enough.select("cid").write.parquet(f"{place}/left")
    left = spark.read.parquet(f"{place}/left")

    whole = "doc_id long, cid long, n long, tokens array<long>"
    sets = named.mapInArrow(_wanted_sets(size, _filter_of(left)), whole)
    shared = _shared(sets.select(F.explode("tokens").alias("token"), "cid", "n"))
    own = Window.partitionBy("cid")
    room = F.expr(f"n - (n * {percent} + 99) DIV 100 + 1")
    ranked = (
        shared.withColumn("room", room - (F.col("n") - F.count("*").over(own)))
        .withColumn("second", F.row_number().over(own.orderBy("df", "token")) <= F.col("room"))
        .withColumn("third", F.row_number().over(own.orderBy("df", F.desc("token"))) <= F.col("room"))
        .where("second OR third")
    )
    with arrow_rows(spark, BATCH):
        ranked.select("cid", "n", "token", "second", "third").write.parquet(f"{place}/ranked")
    ranked = spark.read.parquet(f"{place}/ranked")

    bucket = Window.partitionBy("token").orderBy("n", "cid")
    pairs = (
        ranked.where("second")
        .select("cid", F.lag("cid").over(bucket).alias("before"), "n", F.lag("n").over(bucket).alias("less"))
        .where(F.col("less") * 100 >= F.col("n") * percent)
        .select("cid", "before")
    )
    cells = graph.components(pairs, "cid", "before").select(F.col("node").alias("cid"), F.col("component").alias("cell"))
    cells.write.parquet(f"{place}/cells")
    cells = spark.read.parquet(f"{place}/cells")
    counted = cells.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    blocks = cells.join(counted, "cell").withColumn("block", F.expr("pmod(xxhash64(cid), blocks)"))
    listed = ranked.groupBy("cid").agg(
        F.expr("collect_list(token) FILTER (WHERE second)").alias("second"),
        F.expr("collect_list(token) FILTER (WHERE third)").alias("third"),
    )
    again = named.mapInArrow(_wanted_sets(size, _filter_of(cells)), whole)
    reps = members.where("doc_id IS NOT NULL").groupBy("cid").agg(F.min("doc_id").alias("doc_id"))
    facts = blocks.join(listed, "cid").join(reps, "cid")
    other = F.explode(F.expr("sequence(0L, blocks - 1)"))
    tasks = (
        again.join(facts, ["cid", "doc_id"])
        .withColumn("other", other)
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .select("cell", "i", "j", "block", "cid", "n", "tokens", "second", "third")
    )
    links = tasks.groupBy("cell", "i", "j").applyInPandas(_compare(percent), "a long, b long")
    with arrow_rows(spark, BATCH):
        links.write.parquet(f"{place}/links")

    # Nodes are doc_ids: a class is its smallest doc_id, and rows of one doc_id hold classes together.
    classes = members.where("doc_id IS NOT NULL AND n > 0")
    exact = classes.groupBy("cid", "second").agg(F.min("doc_id").alias("rep"))
    by_cid = exact.groupBy("cid").agg(F.min("rep").alias("rep"))
    links = spark.read.parquet(f"{place}/links")
    between = (
        links.join(by_cid.select(F.col("cid").alias("a"), F.col("rep").alias("x")), "a")
        .join(by_cid.select(F.col("cid").alias("b"), F.col("rep").alias("y")), "b")
        .select("x", "y")
    )
    twice = classes.join(exact, ["cid", "second"]).select(F.col("doc_id").alias("x"), F.col("rep").alias("y"))
    several = classes.groupBy("doc_id").agg(F.countDistinct("cid").alias("k")).where("k > 1")
    twice = twice.join(several.select(F.col("doc_id").alias("x")), "x", "left_semi")
    found = graph.components(between.unionByName(twice.select("x", "y")), "x", "y")
    rooted = exact.join(found, F.col("rep") == F.col("node"), "left")
    rooted = rooted.select("cid", "second", F.coalesce("component", "rep").alias("root"))
    return (
        members.join(rooted, ["cid", "second"], "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.col("cid").alias("class_id"),
            F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("root")).otherwise(F.col("doc_id"))).alias(
                "component_id"
            ),
        )
    )
