"""A corpus pipeline of five stages: toxicity, near duplicates, secrets, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
`documents`. A stage's result is written and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import mixing, ngram_join, packing, secrets, tokens, toxicity
from riskloom.llm.queries import TOXIC
from riskloom.session import arrow_rows, run_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
REPLACEMENT = "[secret]"
BATCH = 1000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject, from all labels of documents that are there."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    place = run_dir(spark, "not-toxic")
    with arrow_rows(spark, BATCH):
        models = toxicity.train(docs, labels, F.col("doc_id").isNotNull())
        scored = toxicity.score(docs.select(*COLUMNS), models, texts=True)
        scored.where(F.col("score") < TOXIC).select(*COLUMNS).write.option("compression", "zstd").parquet(place)
    return spark.read.parquet(place)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of rows that are near copies the first by doc_id, then text; NULL doc_ids come last.

    Rows are told apart whatever their doc_id. Texts without words have no copies, but of those that share a
    doc_id the first by text is kept.
    """
    place = run_dir(spark, "near-copies")
    numbered = docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id())
    numbered.write.option("compression", "zstd").parquet(f"{place}/docs")
    kept = spark.read.parquet(f"{place}/docs")
    joined = ngram_join.ngram_join(kept.select(F.col("_row").alias("doc_id"), "text"))
    joined = joined.select(F.col("doc_id").alias("_row"), "n_shingles", "component_id").join(kept.select("_row", "doc_id"), "_row")
    wordless = (F.col("n_shingles") == 0) & F.col("doc_id").isNotNull()
    group = F.struct(wordless.alias("wordless"), F.when(wordless, F.col("doc_id")).otherwise(F.col("component_id")).alias("of"))
    joined.select("_row", "doc_id", group.alias("group")).write.parquet(f"{place}/groups")
    groups = spark.read.parquet(f"{place}/groups")

    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id")
    least = groups.groupBy("group").agg(F.min(order).alias("least"))
    ahead = groups.join(least, "group").where(F.col("doc_id").eqNullSafe(F.col("least.doc_id"))).select("_row", "group")
    ahead.write.parquet(f"{place}/ahead")
    ahead = spark.read.parquet(f"{place}/ahead")
    counted = ahead.groupBy("group").agg(F.count("*").alias("n"), F.min("_row").alias("_row"))
    ahead.join(counted.where("n > 1").select("group"), "group", "left_semi").write.parquet(f"{place}/tied")
    tied = spark.read.parquet(f"{place}/tied")  # rows that share a doc_id, the only ones whose texts are compared
    first = tied.join(kept.select("_row", "text"), "_row").groupBy("group").agg(F.min(F.struct("text", "_row")).alias("first"))
    first = counted.where("n = 1").select("_row").unionByName(first.select("first._row"))
    groups.join(first, "_row", "left_anti").select("_row").write.parquet(f"{place}/dropped")
    return kept.join(spark.read.parquet(f"{place}/dropped"), "_row", "left_anti").select(*COLUMNS)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret found, alone or linked, replaced."""
    return secrets.redacted(docs.select(*COLUMNS), run_dir(spark, "hidden"), REPLACEMENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by weight, as documents."""
    return mixing.mixed(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    return packing.best_fit(packing.pieces(docs, tokens.tokenizer_path()))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("secret_scan", hide_secrets),
    ("source_mix", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Classifier, secret linking and tokenizer can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages on `documents`, each stage's rows written before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    place = run_dir(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{place}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
