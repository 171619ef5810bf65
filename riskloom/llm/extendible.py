"""Sharding by extendible hashing.

A directory is indexed by leading bits of a row's hash. A bucket that holds more bytes than a shard
may is split on the next bit, the others stay; several directory cells may so point to one shard.
The directory is built from sums per cell, `STEP` bits at a time, and only cells that are still too
large are looked at more closely. It is a table, joined by cell, and never comes to the driver.

Rows with equal keys have equal hashes, which no bit separates. They are numbered before, in an order of their
content, and the number is part of the hash. A row that alone exceeds the limit gets a shard of its own, marked
`oversized`.

Whole rows are written, a folder per shard, and what is said about a shard is read from its files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from riskloom.llm.names import fresh
from riskloom.session import run_dir

BITS = 64
STEP = 16


def _first_bits(bits: str, depth) -> object:
    return F.substring(F.col(bits), F.lit(1), depth)


def numbered(df: DataFrame, keys: list[str], place: str, tie: Column | None = None) -> DataFrame:
    """(own, copy, bits): each row of df as a struct, its number among the rows of equal keys, 64 bits of a hash.

    Rows of equal keys are numbered in order of md5(tie), by default of all their columns, so the numbers do not depend on how
    rows lie in files; rows equal in that too may change places. The bits are those of the md5 of keys and copy, so
    that other engines can find the same shards. A key's rows are counted by the beginnings of their md5 and by the task
    that wrote them, so neither a key nor a row with very many copies needs a task of its own.
    """
    spark = df.sparkSession
    # Keys are told apart as they are hashed, so NULL and '' count together.
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    tie = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])) if tie is None else tie
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("own"),
        F.concat_ws("|", *parts).alias("name"),
        F.md5(F.coalesce(tie, F.lit(""))).alias("tie"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows.write.option("compression", "zstd").parquet(f"{place}/rows")
    rows = spark.read.parquet(f"{place}/rows")
    repeated = rows.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    slim = rows.select("name", "tie", "row").join(repeated, "name", "left_semi")
    slim = slim.withColumn("bucket", F.substring("tie", 1, 3)).withColumn("task", F.shiftright("row", 33))
    slim.write.parquet(f"{place}/repeated")  # few or none, as a rule
    slim = spark.read.parquet(f"{place}/repeated")

    def before(counts: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
        earlier = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumn(name, F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")

    buckets = slim.groupBy("name", "bucket").agg(F.count("*").alias("n"))
    equals = slim.groupBy("name", "bucket", "tie", "task").agg(F.count("*").alias("n"))
    buckets = before(buckets, ["name"], ["bucket"], "buckets_before")
    equals = before(equals, ["name", "bucket"], ["tie", "task"], "equals_before")
    within = F.row_number().over(Window.partitionBy("name", "bucket", "tie", "task").orderBy("row")) - 1
    places = slim.withColumn("within", within).join(equals, ["name", "bucket", "tie", "task"]).join(buckets, ["name", "bucket"])
    copy = (F.col("buckets_before") + F.col("equals_before") + F.col("within")).cast("long")
    places.select("row", copy.alias("copy")).where("copy > 0").write.parquet(f"{place}/copies")
    rows = rows.join(spark.read.parquet(f"{place}/copies"), "row", "left")
    rows = rows.withColumn("copy", F.coalesce("copy", F.lit(0).cast("long")))
    digest = F.substring(F.md5(F.concat_ws("|", "name", F.col("copy").cast("string"))), 1, BITS // 4)
    return rows.select("own", "copy", F.lpad(F.conv(digest, 16, 2), BITS, "0").alias("bits"))


def directory(rows: DataFrame, size: str, limit: int) -> DataFrame:
    """Cells and their shards: (cell, shard, depth, shard_bytes, shard_rows, oversized).

    `cell` is a prefix of the bits as long as the pass that settled it looked at; `shard` is the
    prefix of `cell` that names the bucket and `depth` its length.
    """
    spark = rows.sparkSession
    place = run_dir(spark, "directory")
    open_cells = None
    for done in range(0, BITS, STEP):
        depth = done + STEP
        scoped = rows
        if open_cells is not None:
            scoped = rows.join(open_cells, F.substring("bits", 1, done) == F.col("open"), "left_semi")
        cells = (
            scoped.groupBy(F.substring("bits", 1, depth).alias("cell"))
            .agg(F.sum(size).alias("bytes"), F.count("*").alias("rows"))
        )
        settled = _settle(cells, done, depth, limit)
        settled.write.parquet(f"{place}/pass={depth}")
        left = spark.read.parquet(f"{place}/pass={depth}").where("shard IS NULL")
        if left.isEmpty():
            break
        open_cells = left.select(F.col("cell").alias("open"))
    found = spark.read.option("basePath", place).parquet(place)
    return found.where("shard IS NOT NULL").withColumn("cell_depth", F.col("pass")).drop("pass")


def _settle(cells: DataFrame, done: int, depth: int, limit: int) -> DataFrame:
    """Give each cell the shortest prefix whose bucket fits; none if even the whole cell does not."""
    levels = range(done + 1 if done else 0, depth + 1)
    buckets = (
        cells.withColumn("level", F.explode(F.array(*[F.lit(x) for x in levels])))
        .groupBy(_first_bits("cell", F.col("level")).alias("prefix"), "level")
        .agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    )
    fits = (F.col("bytes") <= limit) | ((F.col("level") == BITS) | (F.col("rows") == 1))
    good = buckets.where(fits)
    named = cells.select("cell").withColumn("level", F.explode(F.array(*[F.lit(x) for x in levels])))
    named = named.withColumn("prefix", _first_bits("cell", F.col("level"))).join(good, ["prefix", "level"])
    best = named.groupBy("cell").agg(F.min(F.struct("level", "prefix", "bytes", "rows")).alias("b"))
    return cells.select("cell").join(best, "cell", "left").select(
        "cell",
        F.col("b.prefix").alias("shard"),
        F.col("b.level").alias("depth"),
        F.col("b.bytes").alias("shard_bytes"),
        F.col("b.rows").alias("shard_rows"),
        (F.col("b.bytes") > limit).alias("oversized"),
    )


def write_shards(df: DataFrame, keys: list[str], measure: Column, limit: int, path: str, tie: Column | None = None) -> None:
    """Write all rows of df as (own, copy), a folder `shard=s<bits>` per shard of at most `limit` bytes.

    `own` is a struct of df's columns, so these may have any names. `measure` gives a row's bytes from them; NULL counts 0.
    NULL keys are a key of their own. `tie` orders rows of equal keys, see `numbered`.
    """
    spark = df.sparkSession
    place = run_dir(spark, "sharding")
    (size,) = fresh(df, "size")
    sized = df.withColumn(size, F.coalesce(measure, F.lit(0)).cast("long"))
    tie = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])) if tie is None else tie
    rows = numbered(sized, keys, place, tie)
    rows.select("bits", F.col(f"own.`{size}`").alias("size")).write.parquet(f"{place}/sizes")
    names = directory(spark.read.parquet(f"{place}/sizes"), "size", limit).select("shard").distinct()
    names.write.parquet(f"{place}/names")
    names = spark.read.parquet(f"{place}/names")
    # Shards have different depths; up to the least one all rows of a shard agree.
    least = names.agg(F.min(F.length("shard"))).first()[0] or 0
    fits = F.substring("bits", 1, least) == F.substring("shard", 1, least)
    fits &= _first_bits("bits", F.length("shard")) == F.col("shard")
    own = F.struct(*[F.col(f"own.`{c}`").alias(c) for c in df.columns]).alias("own")
    routed = rows.join(names, fits).select(own, "copy", F.concat(F.lit("s"), "shard").alias("shard"))
    routed.repartition("shard").write.partitionBy("shard").option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows written by `write_shards` as (own, copy, shard), `schema` being that of its df."""
    whole = StructType([StructField("own", schema), StructField("copy", LongType()), StructField("shard", StringType())])
    return spark.read.schema(whole).parquet(path).withColumn("shard", F.expr("substring(shard, 2)"))


def shards(df: DataFrame, keys: list[str], size: str, limit: int, measure: Column | None = None, tie: Column | None = None) -> DataFrame:
    """Every row as read from its shard's files: df's columns, copy, size, shard, depth, shard_bytes, shard_rows, oversized.

    `size` is the column of a row's bytes; with `measure` it is new, computed from the row that was read. NULL
    sizes count 0, NULL keys are a key of their own, an empty table gives no rows. Columns of df named like the new
    ones are written with the others, but replaced in this result.
    """
    spark, measure = df.sparkSession, F.col(size) if measure is None else measure
    path = run_dir(spark, "shards")
    write_shards(df, keys, measure, limit, path, tie)
    told = ["copy", "shard", "depth", "shard_bytes", "shard_rows", "oversized"]
    read = read_shards(spark, path, df.schema)
    new = {name.lower() for name in told}
    aside = dict(zip(told, fresh(df, *told), strict=True))
    found = read.select("own.*", F.col("copy").alias(aside["copy"]), F.col("shard").alias(aside["shard"]))
    found = found.withColumn(size, F.coalesce(measure, F.lit(0)).cast("long"))
    kept = [c for c in found.columns if c.lower() not in new or c in aside.values()]
    found = found.select(*[F.col(f"`{c}`") for c in kept])
    found = found.withColumnsRenamed({aside["copy"]: "copy", aside["shard"]: "shard"})
    sums = found.groupBy("shard").agg(F.sum(size).alias("shard_bytes"), F.count("*").alias("shard_rows"))
    sums = sums.withColumn("depth", F.length("shard")).withColumn("oversized", F.col("shard_bytes") > limit)
    return found.join(sums, "shard")
