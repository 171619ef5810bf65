"""Mixing sources to target weights, with DataFrame functions only.

The words of a source's documents, in an order mixed by hash, form one stream cut into blocks of equal
length. The mix is a row of slots grouped into output shards. Every slot draws its source by
its share of all slots, so the sources' counts in a shard are multinomial. A source's k-th slot takes
the k-th block of a pseudorandom permutation of the source's block indexes; a second pass has a permutation of
its own. Where a source was drawn more often than it has slots to fill, the slots too many go to sources drawn
too rarely, so that each source gets its target exactly.

Running sums and ranks inside a source are taken bucket by bucket of a hash, never source by source,
so a source with a third of all rows is no single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import run_dir

BLANK = r"[\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
SHARE, MOST = 1.5, 2.0
BLOCK_WORDS = 256
SHARD_SLOTS = 4096
BUCKET_ROWS = 4096
HASHED = 1 << 40
GUIDES = 1024


def word_count(text: str) -> Column:
    """Words of a text; NULL has none."""
    return F.size(words_of(text)).cast("long")


def words_of(text: str) -> Column:
    return F.array_remove(F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), BLANK), "")


def _hash(seed: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(HASHED))


def running(df: DataFrame, group: list[str], order: str, rows: str, value: Column, out: str) -> DataFrame:
    """Add the sum of `value` over the rows of the same group that come before in `order`.

    `order` is a hash below HASHED, `rows` about how many rows the group has. Equal hashes are told apart
    by `tie`, a unique column.
    """
    cut = df.withColumn("_bucket", F.expr(f"({order} * CAST(floor({rows} / {BUCKET_ROWS}) + 1 AS LONG)) DIV {HASHED}"))
    cut = cut.withColumn("_value", value.cast("long"))
    ahead = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy(*group, "_bucket").agg(F.sum("_value").alias("_sum"))
    offsets = offsets.select(*group, "_bucket", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*group, "_bucket").orderBy(order, "tie").rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
        .join(offsets, [*group, "_bucket"])
        .withColumn(out, F.col("_offset") + F.col("_inside"))
        .drop("_bucket", "_value", "_inside", "_offset")
    )


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_id, source_size, source_rows, target) of a table (source, size).

    Sources stand in code point order, NULL last, and the weights repeat along it. A source gets its
    share by weight up to `most` times its size; what is over goes to the others by weight. The level at which
    that ends is found from the sources in order of size by weight.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("source_id") % len(weights) + 1)
    found = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
        .withColumn("source_id", (F.row_number().over(named) - 1).cast("int"))
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(most))
        .withColumn("level", F.col("cap") / F.col("weight"))
    )
    by_level = Window.orderBy("level", "source_id")
    before, after = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(0))
    rest = F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    found = found.withColumn("reached", rest / F.sum("weight").over(after))
    ends = F.min(F.when(F.col("level") >= F.col("reached"), F.struct("level", "source_id", "reached"))).over(whole)
    free = F.coalesce(ends["reached"], F.lit(0.0)) * F.col("weight")
    found = found.withColumn("target", F.when(ends.isNull(), F.col("cap")).otherwise(F.least("cap", free)))
    return found.select("source", "source_id", "source_size", "source_rows", "target")


def _slots(sources: DataFrame, block: int) -> DataFrame:
    """Per source and pass: words to take, slots, and where the source's slots begin among all slots."""
    passes = sources.withColumn("wanted", F.round("target").cast("long")).withColumn(
        "round", F.explode(F.sequence(F.lit(0), F.lit(int(MOST) - 1)))
    )
    words = F.least(F.greatest(F.col("wanted") - F.col("round") * F.col("source_size"), F.lit(0)), F.col("source_size"))
    tail = F.expr(f"source_size % {block}")
    head = F.least(F.col("words"), F.col("tail"))
    passes = passes.withColumn("words", words).withColumn("tail", tail)
    return passes.withColumn("slots", F.expr(f"IF(tail > 0 AND words > 0, 1, 0) + (words - least(words, tail) + {block - 1}) DIV {block}")).withColumn("head", head)


def mix(docs: DataFrame, block: int = BLOCK_WORDS, seed: int = 7) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix of a table (doc_id, text, source, row unique): (documents, sources, parts).

    documents: (row, doc_id, source_id, size, at), `at` being the place of the first word in its source's
    stream. sources: see `targets`. parts: (row, shard, slot, round, low, high), words low to high of the
    document that the slot takes. NULL text has size 0 and is taken 0 times; NULL is a source of its own;
    rows that share a doc_id stay apart by `row`; an empty table gives empty results. Reruns agree.
    """
    spark, place = docs.sparkSession, run_dir(docs.sparkSession, "mix")
    docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count("text").alias("size"),
        "row",
    ).write.parquet(f"{place}/sized")
    sized = spark.read.parquet(f"{place}/sized")
    targets(sized).coalesce(1).write.parquet(f"{place}/sources")
    sources = spark.read.parquet(f"{place}/sources")

    known = sources.select("source_id", F.col("source").alias("_source"), "source_size", "source_rows")
    placed = sized.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("source", "_source")
    placed = placed.withColumn("h", _hash(seed, "doc_id", "size")).withColumn("tie", F.col("row"))
    documents = running(placed, ["source_id"], "h", "source_rows", F.col("size"), "at")
    documents.select("row", "doc_id", "source_id", "size", "source_size", "at").write.parquet(f"{place}/documents")
    documents = spark.read.parquet(f"{place}/documents")

    full = documents.where("size > 0")
    spans = full.withColumn("block", F.explode(F.expr(f"sequence(at DIV {block}, (at + size - 1) DIV {block})")))
    spans = spans.select(
        "row",
        "source_id",
        "block",
        F.greatest(F.lit(0), F.col("at") - F.col("block") * block).alias("low"),
        F.least(F.lit(block), F.col("at") + F.col("size") - F.col("block") * block).alias("high"),
        F.greatest(F.lit(0), F.col("block") * block - F.col("at")).alias("skip"),
        "source_size",
    )
    whole = spans.where((F.col("low") == 0) & ((F.col("block") + 1) * block <= F.col("source_size")))
    whole = whole.select("source_id", "block", F.expr(f"source_size DIV {block}").alias("blocks"))
    turns = whole.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(int(MOST) - 1))))
    turns = turns.withColumn("h", _hash(seed + 1, "source_id", "block", "round")).withColumn("tie", F.col("block"))
    order = running(turns, ["source_id", "round"], "h", "blocks", F.lit(1), "rank")

    quota = _slots(sources, block)
    drawn = _draw(quota, seed, place)
    mapped = drawn.join(
        quota.select("source_id", "round", "words", "tail", "head", "slots", (F.sum("slots").over(
            Window.partitionBy("source_id").orderBy("round").rowsBetween(Window.unboundedPreceding, -1))).alias("earlier")),
        "source_id",
    )
    mapped = mapped.withColumn("k", F.col("number") - F.coalesce("earlier", F.lit(0))).where("k >= 0 AND k < slots")
    first = F.col("tail") > 0
    mapped = (
        mapped.withColumn("rank", F.when(first, F.col("k") - 1).otherwise(F.col("k")))
        .withColumn("take", F.when(F.col("rank") < 0, F.col("head")).otherwise(
            F.least(F.lit(block), F.col("words") - F.col("head") - F.col("rank") * block)))
    )
    by_rank = mapped.where("rank >= 0").join(order.select("source_id", "round", "rank", "block"), ["source_id", "round", "rank"])
    tails = mapped.where("rank < 0").join(
        sources.select("source_id", F.expr(f"source_size DIV {block}").alias("block")), "source_id"
    )
    columns = ["source_id", "block", "take", "round", "shard", "slot"]
    chosen = by_rank.select(*columns).unionByName(tails.select(*columns))
    parts = (
        chosen.join(spans.drop("source_size"), ["source_id", "block"])
        .where("low < take")
        .select(
            "row",
            "shard",
            "slot",
            "round",
            F.col("skip").alias("low"),
            (F.col("skip") + F.least("high", "take") - F.col("low")).alias("high"),
        )
    )
    return documents, sources, parts


def _draw(quota: DataFrame, seed: int, place: str) -> DataFrame:
    """(shard, slot, source_id, number): each slot's source and which of the source's slots it is."""
    spark = quota.sparkSession
    wanted = quota.groupBy("source_id").agg(F.sum("slots").alias("slots"))
    total = wanted.agg(F.sum("slots")).first()[0] or 0
    whole = Window.orderBy("source_id").rowsBetween(Window.unboundedPreceding, 0)
    ranges = wanted.withColumn("_to", F.sum("slots").over(whole)).withColumn("_from", F.col("_to") - F.col("slots"))
    # A slot draws a whole number below the total, hence a source by its share.
    guide = F.explode(F.expr(f"sequence(_from * {GUIDES} DIV {max(total, 1)}, (_to - 1) * {GUIDES} DIV {max(total, 1)})"))
    guided = ranges.where("slots > 0").withColumn("guide", guide)
    slots = spark.range(total).select(
        F.col("id").alias("slot"),
        F.expr(f"id DIV {SHARD_SLOTS}").alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed + 2), "id"), F.lit(max(total, 1))).alias("draw"),
    )
    slots = slots.withColumn("guide", F.expr(f"draw * {GUIDES} DIV {max(total, 1)}"))
    drawn = slots.join(guided, "guide").where("draw >= _from AND draw < _to").select("shard", "slot", "source_id")
    in_shard = Window.partitionBy("source_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = drawn.groupBy("source_id", "shard").agg(F.count("*").alias("n"))
    offsets = counts.select("source_id", "shard", F.coalesce(F.sum("n").over(in_shard), F.lit(0)).alias("offset"))
    place_in = F.row_number().over(Window.partitionBy("source_id", "shard").orderBy("slot")) - 1
    drawn = drawn.withColumn("_k", place_in).join(offsets, ["source_id", "shard"])
    drawn = drawn.select("shard", "slot", "source_id", (F.col("offset") + F.col("_k")).alias("number"))
    drawn.join(wanted, "source_id").write.parquet(f"{place}/drawn")
    drawn = spark.read.parquet(f"{place}/drawn")
    good = drawn.where("number < slots").drop("slots")
    # What is drawn too often and too rarely is of the order of the square root of the slots.
    over = drawn.where("number >= slots").select("shard", "slot")
    over = over.withColumn("k", F.row_number().over(Window.orderBy("slot")))
    had = drawn.groupBy("source_id").agg(F.count("*").alias("had"))
    short = wanted.join(had, "source_id", "left").withColumn("had", F.coalesce("had", F.lit(0))).where("had < slots")
    short = short.select("source_id", F.explode(F.expr("sequence(had, slots - 1)")).alias("number"))
    short = short.withColumn("k", F.row_number().over(Window.orderBy("source_id", "number")))
    return good.unionByName(over.join(short, "k").select("shard", "slot", "source_id", "number"))


def taken(docs: DataFrame, block: int = BLOCK_WORDS, seed: int = 7) -> DataFrame:
    """(doc_id, source_id, size, source_size, target, taken): how many words of each document the mix has."""
    documents, sources, parts = mix(docs.withColumn("row", F.monotonically_increasing_id()), block, seed)
    used = parts.groupBy("row").agg(F.sum(F.col("high") - F.col("low")).alias("taken"))
    return (
        documents.join(used, "row", "left")
        .join(sources.select("source_id", "target"), "source_id")
        .select("doc_id", "source_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    )


def mixed(docs: DataFrame, block: int = BLOCK_WORDS, seed: int = 7) -> DataFrame:
    """The mix as documents (doc_id, text, lang, source, n_chars): one row per document and pass.

    A document that a pass takes whole keeps its text; else its words of the blocks taken stand in
    their order with a blank between. What no slot takes is left out.
    """
    spark, place = docs.sparkSession, run_dir(docs.sparkSession, "mixed")
    docs.withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(f"{place}/docs")
    kept = spark.read.parquet(f"{place}/docs")
    documents, _, parts = mix(kept, block, seed)
    spans = parts.groupBy("row", "round").agg(
        F.sort_array(F.collect_list(F.struct("low", "high"))).alias("spans"), F.sum(F.col("high") - F.col("low")).alias("n")
    )
    joined = kept.join(spans, "row").join(documents.select("row", "size"), "row")
    some = F.array_join(F.flatten(F.transform("spans", lambda s: F.slice(words_of("text"), s["low"] + 1, s["high"] - s["low"]))), " ")
    text = F.when(F.col("n") == F.col("size"), F.col("text")).otherwise(some)
    joined = joined.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))
    return joined.select("doc_id", "text", "lang", "source", "n_chars")
