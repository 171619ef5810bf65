"""State, commits and numbering: streams over several micro-batches, snapshots, positions and codes as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.catalog.observations import OBS, SCORED, observed, table
from riskloom.operators import codes, comoments, positions, sketches
from riskloom.operators.dims import local_table
from riskloom.operators.models import score
from riskloom.session import counting_session, run_dir
from riskloom.sinks import snapshots
from riskloom.sinks.manifest import ManifestSink, committed
from riskloom.sources.files import read_file_stream
from riskloom.streaming import alerts, finality, resetting, summaries
from riskloom.streaming.comoments import read_comoments, start_comoments
from riskloom.streaming.messages import replay
from riskloom.streaming.scoring import start_query, start_scoring

BATCHES, FILES = 4, 2  # files of a micro-batch, more where it has many rows
FILE_ROWS = 100_000
DAY = 24 * 3600
SPAN = 6 * 3600
MEASURED = ("age", "bmi", "hba1c_level", "blood_glucose_level", "diabetes")
PRICED, SHARES = ("l_extendedprice", "l_quantity"), (0.01, 0.25, 0.5, 0.75, 0.99)


def arriving(spark, sf_dir, delayed: bool) -> DataFrame:
    """The events as a stream of four micro-batches in order of event_id; with `delayed` every tenth comes a batch late."""
    events = table(spark, sf_dir, "events")
    total = events.agg(F.max("event_id") + 1).first()[0] or 1
    batch = F.least(F.lit(BATCHES - 1), F.expr(f"{BATCHES} * event_id div {total} + int({str(delayed).lower()} AND event_id % 10 = 0)"))
    path = run_dir(spark, "arriving")
    sizes = events.groupBy(batch.alias("batch")).count().collect()  # a row per batch
    # Each batch has the same number of files, so none may be without rows: the smallest batch sets it.
    files = max(FILES, min((r["count"] for r in sizes), default=0) // FILE_ROWS)
    for number in range(BATCHES):
        replay(events.where(batch == number), path, files=files)
    return read_file_stream(spark, path, events.schema, max_files=files)


def _minutes(spark, sf_dir) -> str:
    root, checkpoint = run_dir(spark, "final"), run_dir(spark, "checkpoint")
    finality.start_final_windows(arriving(spark, sf_dir, True), F.col("ts"), root, checkpoint, late=DAY).awaitTermination()
    return root


def final_minutes(spark, sf_dir):
    found = finality.final_windows(spark, _minutes(spark, sf_dir))
    return found.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n")


def late_messages(spark, sf_dir):
    root = _minutes(spark, sf_dir)
    late = finality.late_rows(spark, root).groupBy("batch_id").agg(F.count("*").alias("late"), F.sum("event_id").alias("ids"))
    rows = finality.marks(spark, root).select(F.col("batch_id").cast("long").alias("batch_id"), "rows")
    late = late.select(F.col("batch_id").alias("_batch"), "late", "ids")
    joined = rows.join(late, F.col("batch_id") == F.col("_batch"), "left")
    return joined.select("batch_id", "rows", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("late", "ids")])


def reset_counts(spark, sf_dir):
    out, checkpoint = run_dir(spark, "resetting"), run_dir(spark, "checkpoint")
    # The state grows with the users, so it is dealt over as many partitions as the session's shuffles.
    partitions = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    events = arriving(counting_session(spark, partitions), sf_dir, False)
    counted = resetting.resetting_counts(events, "user_id", F.col("ts"), "1 hour", SPAN, buckets=16 * partitions)
    start_query(counted.writeStream.format("parquet").option("path", out), checkpoint).awaitTermination()
    found = spark.read.schema(counted.schema).parquet(out)
    return found.withColumn("counter_start", F.col("counter_start").cast("timestamp_ntz"))


def refreshed_levels(spark, sf_dir):
    root, checkpoint = run_dir(spark, "cells"), run_dir(spark, "checkpoint")
    events = observed(arriving(spark, sf_dir, True))
    summaries.start_summaries(events, root, checkpoint, every=None).awaitTermination()
    found = summaries.refreshed(spark, root)["gender_risk"]
    rounded = [F.round(c, 6).alias(c) for c in ("share", "avg_bmi", "avg_blood_glucose_level", "avg_risk_score")]
    return found.select("gender", "risk_level", "n", "correct", *rounded)


def manifest_rows(spark, sf_dir):
    """A primary sink that breaks halfway through the second batch."""
    root, checkpoint = run_dir(spark, "manifest"), run_dir(spark, "checkpoint")
    calls: list[int] = []

    def primary(df: DataFrame) -> None:
        calls.append(1)
        broken = len(calls) == 2
        (df.where("obs_id % 2 = 0") if broken else df).write.mode("append").parquet(f"{root}/primary")
        if broken:
            raise ConnectionError("lost halfway")

    events = observed(arriving(spark, sf_dir, True))
    start_scoring(events, ManifestSink(primary, root), checkpoint, keep=("obs_id",)).awaitTermination()
    held = spark.read.parquet(f"{root}/primary")
    return committed(held, root).select("obs_id", F.col("predicted_diabetes").alias("predicted"), "batch_id", "sink")


def snapshot_as_of(spark, sf_dir):
    root = run_dir(spark, "snapshots")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    first = snapshots.commit(rows, root, "first")
    snapshots.commit(rows.where("c_acctbal < 0"), root, "second")
    return snapshots.read_as_of(spark, root, version=first)


def attach_by_file_position(spark, sf_dir):
    left, right = f"{sf_dir}/events.parquet", f"{sf_dir}/orders.parquet"
    return positions.attach_by_file_position(spark, left, right, ["o_orderpriority"]).select("event_id", "o_orderpriority")


def name_index(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return codes.encode(rows, "c_name", codes.code_table(rows, "c_name"), "code", hot=100).select("c_custkey", "code")


def _ranks(column: str, value: float):
    """Rows below a value, up to it, and all."""
    return F.struct(F.count_if(F.col(column) < value).alias("below"), F.count_if(F.col(column) <= value).alias("upto"), F.count(column).alias("n"))


def quantile_bounds(spark, sf_dir):
    """Sketched quantiles of four parts of the rows, merged: do the true ranks of the answers lie within the bound?"""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", *PRICED)
    parts = rows.select((F.col("l_orderkey") % 4).alias("part"), *PRICED)
    cells = sketches.merge_cells(sketches.quantile_cells(parts, PRICED, ["part"]))
    asked = cells.select("column", "n", F.explode(F.array(*[F.struct(F.lit(s).alias("share"), sketches.quantile(s).alias("value")) for s in SHARES])).alias("a"))
    asked = asked.select("column", "n", "a.share", "a.value")
    answers = {(r["column"], r["share"]): r["value"] for r in asked.collect()}  # a row per column and share
    values = rows.agg(*[_ranks(c, v).alias(f"{c}|{s}") for (c, s), v in answers.items()])
    ranks = values.first()
    bound = sketches.rank_error()
    found = []
    for c, s in answers:
        below, upto, n = ranks[f"{c}|{s}"]
        found.append((c, s, n, below / n - bound <= s <= upto / n + bound))
    return local_table(spark, "column string, share double, n long, within boolean", found)


def merged_correlation(spark, sf_dir):
    """Correlations within each gender from the co-moments of four micro-batches."""
    root, checkpoint = run_dir(spark, "comoments"), run_dir(spark, "checkpoint")
    events = observed(arriving(spark, sf_dir, True))
    start_comoments(events, MEASURED, root, checkpoint, by=["gender"]).awaitTermination()
    found = comoments.correlations(read_comoments(spark, root, ["gender"]), MEASURED, ["gender"])
    return found.withColumn("r", F.round("r", 6))


def comoment_state(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    found = comoments.comoment_cells(rows, PRICED, by=["l_returnflag"])
    return found.select("l_returnflag", "x", "y", "n", *[F.round(c, 4).alias(c) for c in ("mean_x", "mean_y")])


def _alerts(spark, sf_dir) -> str:
    root, checkpoint = run_dir(spark, "alerts"), run_dir(spark, "checkpoint")
    events = score(observed(arriving(spark, sf_dir, True)))
    time, value = F.col("processing_time"), F.col("predicted_diabetes")
    alerts.start_rate_alerts(events, time, value, root, checkpoint, late=DAY, by=["gender"], k=1.5).awaitTermination()
    return root


def stream_rate_alerts(spark, sf_dir):
    found = alerts.read_rate_alerts(spark, _alerts(spark, sf_dir), ["gender"])
    rounded = [F.round(c, 6).alias(c) for c in ("rate", "trailing_mean", "trailing_sd")]
    return found.select("gender", F.date_format("window_start", "yyyy-MM-dd").alias("day"), "n", *rounded, "alert")


QUERIES = {
    f.__name__: f
    for f in (
        final_minutes,
        late_messages,
        reset_counts,
        refreshed_levels,
        manifest_rows,
        snapshot_as_of,
        attach_by_file_position,
        name_index,
        quantile_bounds,
        merged_correlation,
        comoment_state,
        stream_rate_alerts,
    )
}

_ARRIVING = """WITH RECURSIVE total AS (SELECT max(event_id) + 1 AS total FROM events), arriving AS (
  SELECT *, least(3, (4 * event_id) // total + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END) AS batch,
         date_trunc('minute', ts) AS minute
  FROM events, total
), newest AS (
  SELECT batch, max(max(ts)) OVER (ORDER BY batch) - INTERVAL 1 DAY AS mark FROM arriving GROUP BY batch
), judged AS (
  SELECT a.*, coalesce(minute + INTERVAL 1 MINUTE <= mark, FALSE) AS late
  FROM arriving a LEFT JOIN newest ON newest.batch = a.batch - 1
)"""

ORACLES = {
    "final_minutes": f"""{_ARRIVING}
SELECT minute AS window_start, COUNT(*) AS n FROM judged
WHERE NOT late AND minute + INTERVAL 1 MINUTE <= (SELECT max(mark) FROM newest) GROUP BY 1""",
    "late_messages": f"""{_ARRIVING}
SELECT batch AS batch_id, COUNT(*) AS rows, COUNT(*) FILTER (late) AS late,
  CAST(COALESCE(SUM(event_id) FILTER (late), 0) AS BIGINT) AS ids FROM judged GROUP BY 1""",
    "reset_counts": """WITH RECURSIVE counters AS (
  SELECT user_id, min(ts) AS counter_start FROM events GROUP BY 1
  UNION ALL
  SELECT c.user_id, min(e.ts) FROM counters c
  JOIN events e ON e.user_id = c.user_id AND e.ts >= c.counter_start + INTERVAL 6 HOUR GROUP BY 1
)
SELECT c.user_id, counter_start, COUNT(*) AS n
FROM counters c JOIN events e ON e.user_id = c.user_id AND ts >= counter_start AND ts < counter_start + INTERVAL 6 HOUR
WHERE counter_start + INTERVAL 6 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events) GROUP BY 1, 2""",
    "refreshed_levels": f"""{SCORED}
SELECT gender, risk_level, COUNT(*) AS n, COUNT(*) FILTER (prediction_match) AS correct,
  ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 6) AS share, ROUND(AVG(bmi), 6) AS avg_bmi,
  ROUND(AVG(blood_glucose_level), 6) AS avg_blood_glucose_level, ROUND(AVG(risk_score), 6) AS avg_risk_score
FROM scored GROUP BY 1, 2""",
    "manifest_rows": f"""{SCORED}, total AS (SELECT max(event_id) + 1 AS total FROM events), placed AS (
  SELECT obs_id, predicted_diabetes AS predicted,
         least(3, (4 * obs_id) // total + CASE WHEN obs_id % 10 = 0 THEN 1 ELSE 0 END) AS batch_id FROM scored, total
)
SELECT *, CASE batch_id WHEN 1 THEN 'fallback' ELSE 'primary' END AS sink FROM placed""",
    "snapshot_as_of": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "attach_by_file_position": """WITH l AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS p FROM events),
r AS (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderkey) AS p FROM orders)
SELECT event_id, o_orderpriority FROM l LEFT JOIN r USING (p)""",
    "quantile_bounds": """SELECT "column", share, CASE "column" WHEN 'l_quantity' THEN quantity ELSE price END AS n, TRUE AS within
FROM (SELECT COUNT(l_extendedprice) AS price, COUNT(l_quantity) AS quantity FROM lineitem),
  (VALUES ('l_extendedprice'), ('l_quantity')) AS c("column"),
  (VALUES (0.01::DOUBLE), (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE), (0.99::DOUBLE)) AS s(share)""",
    "name_index": """WITH counts AS (SELECT c_name, COUNT(*) AS n FROM customer GROUP BY 1),
codes AS (SELECT c_name, row_number() OVER (ORDER BY n DESC, c_name) - 1 AS code FROM counts)
SELECT c_custkey, CAST(code AS DOUBLE) AS code FROM customer JOIN codes USING (c_name)""",
    "merged_correlation": f"{OBS} "
    + " UNION ALL ".join(
        f"SELECT gender, '{x}' AS x, '{y}' AS y, ROUND(corr({x}, {y}), 6) AS r FROM obs GROUP BY gender"
        for x in MEASURED
        for y in MEASURED
    ),
    "comoment_state": " UNION ALL ".join(
        f"""SELECT l_returnflag, '{x}' AS x, '{y}' AS y, COUNT(*) AS n, ROUND(AVG({x}), 4) AS mean_x, ROUND(AVG({y}), 4) AS mean_y
FROM lineitem WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY 1"""
        for i, x in enumerate(PRICED)
        for y in PRICED[i:]
    ),
    "stream_rate_alerts": f"""{SCORED}, total AS (SELECT max(obs_id) + 1 AS total FROM scored), arriving AS (
  SELECT *, least(3, (4 * obs_id) // total + CASE WHEN obs_id % 10 = 0 THEN 1 ELSE 0 END) AS batch,
         date_trunc('day', processing_time) AS day FROM scored, total
), newest AS (
  SELECT batch, max(max(processing_time)) OVER (ORDER BY batch) - INTERVAL 1 DAY AS mark FROM arriving GROUP BY batch
), d AS (
  SELECT gender, day, COUNT(predicted_diabetes) AS n, AVG(predicted_diabetes) AS rate
  FROM arriving a LEFT JOIN newest ON newest.batch = a.batch - 1
  WHERE NOT coalesce(day + INTERVAL 1 DAY <= mark, FALSE)
    AND day + INTERVAL 1 DAY <= (SELECT max(mark) FROM newest) GROUP BY 1, 2
), t AS (
  SELECT *, AVG(rate) OVER w AS m, STDDEV_POP(rate) OVER w AS s FROM d
  WINDOW w AS (PARTITION BY gender ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT gender, strftime(day, '%Y-%m-%d') AS day, n, ROUND(rate, 6) AS rate, ROUND(m, 6) AS trailing_mean,
  ROUND(s, 6) AS trailing_sd, COALESCE(ABS(rate - m) > 1.5 * s, FALSE) AS alert FROM t""",
}
