"""Streams over several batches, replays, broken sinks, versions and numbering."""

import random

import numpy as np
import pytest
from helpers import scored
from pyspark.sql import functions as F

from riskloom.operators import codes, comoments, models, positions, sketches
from riskloom.operators.features import fit_features
from riskloom.operators.profile import box_stats
from riskloom.operators.trends import geo_rollup
from riskloom.sinks import jdbc, snapshots
from riskloom.sinks.manifest import ManifestSink, committed, manifest
from riskloom.sources.files import read_file_stream
from riskloom.streaming import alerts, finality, resetting, summaries
from riskloom.streaming.comoments import read_comoments, start_comoments
from riskloom.streaming.messages import replay
from riskloom.streaming.scoring import start_query

EVENTS = "id long, key string, at timestamp"


def seconds(spark, rows):
    """(id, key, second) rows, the second as a time."""
    frame = spark.createDataFrame(rows, "id long, key string, s double")
    return frame.select("id", "key", F.timestamp_seconds("s").alias("at"))


def streamed(spark, path, *batches):
    for rows in batches:
        replay(seconds(spark, rows), path, files=1)
    return read_file_stream(spark, path, seconds(spark, []).schema, max_files=1)


def test_rows_are_final_or_open_or_late(spark, path):
    first = [(1, "a", 5.0), (2, "a", 59.9), (3, "a", 60.0), (4, "a", 200.0), (5, "a", None)]
    second = [(6, "a", 70.0), (7, "a", 119.9), (8, "a", 120.0), (9, "a", 500.0)]
    third = [(10, "a", 400.0), (11, "a", 439.0), (12, "a", 440.0)]
    stream = streamed(spark, f"{path}/in", first, second, third)
    finality.start_final_windows(stream, F.col("at"), f"{path}/out", f"{path}/c", late=60).awaitTermination()
    # After batch 0 the mark is at 140, after batch 1 at 440.
    late = {(r["batch_id"], r["id"]) for r in finality.late_rows(spark, f"{path}/out").collect()}
    assert late == {(0, 5), (1, 6), (1, 7), (2, 10)}
    found = {int(r["window_start"].timestamp()): r["n"] for r in finality.final_windows(spark, f"{path}/out").collect()}
    assert found == {0: 2, 60: 1, 120: 1, 180: 1}
    every = finality.final_windows(spark, f"{path}/out", ended=True).agg(F.sum("n")).first()[0]
    assert every + len(late) == 12 and len(finality.marks(spark, f"{path}/out").collect()) == 3


def test_a_replayed_batch_replaces_what_it_wrote(spark, path):
    stream = streamed(spark, f"{path}/in", [(1, "a", 5.0), (2, "a", 300.0)], [(3, "a", 7.0), (4, "a", 310.0)])
    finality.start_final_windows(stream, F.col("at"), f"{path}/out", f"{path}/c", late=60).awaitTermination()
    before = sorted(map(str, finality.final_windows(spark, f"{path}/out", ended=True).collect()))
    # Another checkpoint plays the same batches again over the same root.
    finality.start_final_windows(stream, F.col("at"), f"{path}/out", f"{path}/c2", late=60).awaitTermination()
    assert sorted(map(str, finality.final_windows(spark, f"{path}/out", ended=True).collect())) == before
    assert finality.late_rows(spark, f"{path}/out").count() == 1


def test_counters_start_anew_whatever_the_order_of_arrival(spark, path):
    rng = random.Random(3)
    times = {k: sorted(round(rng.random() * 2000, 3) for _ in range(80)) for k in ("a", "b", "c")}
    times["d"] = [10.0, 10.0, 69.999, 70.0, 70.0, 500.0]
    rows = sorted((t, k) for k, ts in times.items() for t in ts)
    rows = [(t + rng.random() * 100, t, k) for t, k in rows]  # arrive up to 100 seconds late
    rows = [(i, k, t) for i, (_, t, k) in enumerate(sorted(rows))] + [(999, None, 5.0), (998, "a", None), (997, "z", 9000.0)]
    quarter = len(rows) // 4 + 1
    stream = streamed(spark, f"{path}/in", *[rows[i : i + quarter] for i in range(0, len(rows), quarter)])
    counted = resetting.resetting_counts(stream, "key", F.col("at"), "700 seconds")
    start_query(counted.writeStream.format("parquet").option("path", f"{path}/out"), f"{path}/c").awaitTermination()
    found = sorted((r["key"], round(r["counter_start"].timestamp(), 3), r["n"]) for r in spark.read.parquet(f"{path}/out").collect())
    expected = []
    for key, ts in times.items():
        closed, start, n = resetting.fold(-1, 0, [round(t * 1e6) for t in ts], [1] * len(ts), 60_000_000)
        expected += [(key, round(s / 1e6, 3), m) for s, m in [*closed, (start, n)]]
    assert found == sorted(expected) and sum(n for *_, n in found) == 246


def test_many_keys_share_the_states_of_a_few_buckets(spark, path):
    """A state per key takes a call of Python per key and batch; NaN is a key like any other."""
    nan = float("nan")
    rows = [(k, float(t)) for k in range(300) for t in (k + 5, k + 35, k + 65, k + 405)] + [(-1, t) for t in (1.0, 2.0, 500.0)]
    frame = spark.createDataFrame([(nan if k < 0 else float(k), t) for k, t in rows], "key double, s double")
    frame = frame.select("key", F.timestamp_seconds("s").alias("at"))
    replay(frame, f"{path}/in", files=2)
    replay(spark.createDataFrame([(nan, 5000.0), (7.0, 4000.0)], "key double, s double").select("key", F.timestamp_seconds("s").alias("at")), f"{path}/in", files=1)
    stream = read_file_stream(spark, f"{path}/in", frame.schema, max_files=2)
    counted = resetting.resetting_counts(stream, "key", F.col("at"), "0 seconds", buckets=8)
    query = start_query(counted.writeStream.format("parquet").option("path", f"{path}/out"), f"{path}/c")
    query.awaitTermination()
    rows = spark.read.parquet(f"{path}/out").collect()  # Arrow makes NULL of a NaN in pandas
    found = sorted((r["key"], int(r["counter_start"].timestamp()), r["n"]) for r in rows if r["key"] is not None)
    assert [x for x in found if x[0] != 7] == [(float(k), k + t, n) for k in range(300) if k != 7 for t, n in ((5, 2), (65, 1), (405, 1))]
    assert sorted((r["counter_start"].timestamp(), r["n"]) for r in rows if r["key"] is None) == [(1.0, 2), (500.0, 1)]
    assert 0 < max(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]) <= 8


def test_cells_of_batches_add_up(spark, path):
    changes = [{"age": float(a), "bmi": None if a % 3 else 20.0 + a, "predicted_diabetes": a % 2} for a in range(20, 60)]
    every = scored(spark, *changes)
    for number in range(3):
        part = every.where(F.col("age") % 3 == number)
        summaries.write_batch_parquet(summaries.cells(part), number, f"{path}/cells")
    found = summaries.refreshed(spark, f"{path}/cells")
    whole = summaries.summary(summaries.merged(summaries.cells(every)), ("age_group",))

    def shown(df):
        return sorted(str([round(x, 9) if isinstance(x, float) else x for x in r]) for r in df.collect())

    assert shown(found["age_groups"]) == shown(whole) and set(found) == set(summaries.SUMMARIES)
    summaries.compact_cells(spark, f"{path}/cells", f"{path}/compact")
    compact = spark.read.parquet(f"{path}/compact")
    assert shown(summaries.refreshed(spark, f"{path}/compact")["age_groups"]) == shown(whole)
    assert {r["batch_id"] for r in compact.select("batch_id").distinct().collect()} == {1, 2}


def test_a_broken_primary_leaves_nothing_twice_or_lost(spark, path):
    def primary(df):
        if broken == "before":
            raise ConnectionError
        (df.where("id < 5") if broken == "halfway" else df).write.mode("append").parquet(f"{path}/primary")
        if broken:
            raise ConnectionError

    sink = ManifestSink(primary, f"{path}/m")
    used = []
    for number, broken in enumerate(["", "halfway", "before", "after", ""]):
        rows = spark.range(number * 10, number * 10 + 10).select((F.col("id") % 10).alias("id"), F.lit(number).alias("batch"))
        used.append(sink(rows, number))
    broken = ""
    assert sink(spark.range(10).select("id", F.lit(0).alias("batch")), 0) == "primary"  # a replay writes nothing
    assert used == ["primary", "fallback", "fallback", "fallback", "primary"]
    held = spark.read.parquet(f"{path}/primary")
    assert held.count() > 20
    found = committed(held, f"{path}/m").collect()
    assert sorted((r["batch"], r["id"]) for r in found) == [(b, i) for b in range(5) for i in range(10)]
    assert all(r["batch"] == r["batch_id"] and r["sink"] == used[r["batch"]] for r in found)
    assert sorted((r["batch_id"], r["sink"], r["rows"]) for r in manifest(spark, f"{path}/m").collect()) == [
        (b, s, 10) for b, s in enumerate(used)
    ]
    assert committed(held, f"{path}/none").count() == 0


def test_versions(spark, path):
    assert snapshots.versions(spark, path) == []
    with pytest.raises(FileNotFoundError):
        snapshots.read_as_of(spark, path)
    for number in range(4):
        assert snapshots.commit(spark.range(number), path, f"run{number % 2}") == number
    counts = [snapshots.read_as_of(spark, path, version=v).count() for v in range(4)]
    assert counts == [0, 1, 2, 3] == [v["rows"] for v in snapshots.versions(spark, path)]
    assert snapshots.read_as_of(spark, path).count() == 3 and snapshots.read_as_of(spark, path, run="run0").count() == 2
    then = snapshots.versions(spark, path)[1]["at"]
    assert snapshots.read_as_of(spark, path, at=then).count() == 1
    # A number that another writer has taken is not taken twice.
    assert not snapshots._create(spark, f"{path}/_log/{3:012d}.json", "{}") and snapshots.read_as_of(spark, path).count() == 3
    assert snapshots.expire(spark, path, 2) == [0, 1]
    assert [v["version"] for v in snapshots.versions(spark, path)] == [2, 3]
    with pytest.raises(FileNotFoundError):
        snapshots.read_as_of(spark, path, version=1)
    assert snapshots.commit(spark.range(1), path, "later") == 4


def test_positions_by_file(spark, path):
    spark.range(1000, 1100).repartition(7).write.parquet(f"{path}/left")
    spark.range(30).select((F.col("id") * 2).alias("x")).coalesce(1).write.parquet(f"{path}/right")
    numbered = positions.number_by_file(spark, f"{path}/left").collect()
    assert sorted(r["position"] for r in numbered) == list(range(100)) and {r["id"] for r in numbered} == set(range(1000, 1100))
    joined = positions.attach_by_file_position(spark, f"{path}/left", f"{path}/right", ["x"])
    at = {r["id"]: r["position"] for r in numbered}
    assert {r["id"]: r["x"] for r in joined.collect()} == {i: 2 * p if p < 30 else None for i, p in at.items()}
    assert "rangepartitioning" not in joined._jdf.queryExecution().executedPlan().toString()


def test_positions_in_order(spark):
    frame = spark.range(500).select((F.col("id") * 37 % 500).alias("v"), (F.col("id") % 3).alias("w")).repartition(6)
    found = positions.number_in_order(frame, [F.desc("w"), F.asc("v")]).collect()
    ordered = sorted(found, key=lambda r: (-r["w"], r["v"]))
    assert [r["position"] for r in ordered] == list(range(500))
    assert positions.number_in_order(frame.limit(0), [F.asc("v")]).count() == 0


@pytest.mark.parametrize("hot", [0, 2, 100])
def test_codes(spark, hot):
    values = ["b"] * 40 + ["a"] * 9 + ["c"] * 9 + ["d", "", None, None]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v string").repartition(5)
    table = codes.code_table(frame, "v")
    assert {r["value"]: r["code"] for r in table.collect()} == {"b": 0, "a": 1, "c": 2, "": 3, "d": 4}
    more = frame.unionByName(spark.createDataFrame([(100, "new")], "id long, v string"))
    found = {r["id"]: r["code"] for r in codes.encode(more, "v", table, "code", hot).collect()}
    of = {"b": 0.0, "a": 1.0, "c": 2.0, "": 3.0, "d": 4.0}
    assert found == {**{i: of.get(v, 5.0) for i, v in enumerate(values)}, 100: 5.0}


def test_sketches_merge(spark):
    values = [(i % 3, float(i) if i % 10 else None) for i in range(30_000)] + [(0, float("nan"))]
    frame = spark.createDataFrame(values, "g long, v double")
    parts = frame.withColumn("part", F.col("g") + F.pmod(F.hash("v"), F.lit(4)) * 3)
    merged = sketches.merge_cells(sketches.quantile_cells(parts, ["v"], ["g", "part"]), ["g"])
    for row in sketches.box_cells(merged).collect():
        own = sorted(v for g, v in values if g == row["g"] and v == v and v is not None)
        assert (row["n"], row["least"], row["most"]) == (len(own), own[0], own[-1])
        for name, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
            assert abs(own.index(row[name]) / len(own) - share) <= sketches.rank_error()
    assert sketches.quantile_cells(frame.limit(0), ["v"], ["g"]).count() == 0


def test_first_append_makes_the_table(spark, monkeypatch):
    written = []
    monkeypatch.setattr(jdbc, "write_jdbc", lambda df, options, table: written.append((table, df.count(), df.columns)))
    rows = spark.range(3).withColumnRenamed("id", "k")
    options = {"url": "jdbc:none:x", "driver": "no.such.Driver"}
    monkeypatch.setattr(jdbc, "jdbc_available", lambda *_: True)
    jdbc.append_batch(rows, 4, options, "t", "k")
    assert written == [("t", 3, ["k", "batch_id"])]
    monkeypatch.setattr(jdbc, "jdbc_available", lambda *_: False)
    with pytest.raises(Exception, match="(?i)driver"):
        jdbc.append_batch(rows, 4, options, "t", "k")


def test_patients_without_a_home_count_as_unknown(spark):
    rows = spark.createDataFrame([(1, "high"), (2, "low"), (None, "low"), (3, "high")], "patient_id long, risk_level string")
    customer = spark.createDataFrame([(1, 7), (3, 8)], "c_custkey long, c_nationkey long")
    nation = spark.createDataFrame([(7, "N", 0)], "n_nationkey long, n_name string, n_regionkey long")
    region = spark.createDataFrame([(0, "R")], "r_regionkey long, r_name string")
    found = {(r["region"], r["nation"]): (r["n"], r["high_n"]) for r in geo_rollup(rows, customer, nation, region).collect()}
    assert found == {
        ("R", "N"): (1, 1),
        ("R", None): (1, 1),
        ("unknown", "unknown"): (3, 1),
        ("unknown", None): (3, 1),
        (None, None): (4, 2),
    }


def test_boxes_leave_nan_out(spark):
    frame = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4)] + [("a", float("nan")), ("a", None)], "g string, v double")
    for exact in (True, False):
        row = box_stats(frame, "v", "g", exact).first()
        assert (row["min"], row["max"], row["upper_fence"]) == (1.0, 4.0, 4.0)


def test_a_forest_depends_on_its_rows_alone(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("ab"), rng.random(), int(rng.random() < 0.4)) for i in range(600)]
    frame = spark.createDataFrame(rows, "id long, c string, x double, y int")
    features = fit_features(frame, ["c"], ["x"])
    fitted = []
    for files in (2, 8):
        with models.cached(models.training_rows(frame.repartition(files), features, "y", "id", partitions=5)) as train:
            assert train.count() == 600 and sorted(train.columns) == ["c", "x", "y"]
            fitted.append(models.fit_classifier(features, models.forest("y", numTrees=5, maxDepth=4), train).stages[-1].toDebugString)
    assert fitted[0].split("\n")[1:] == fitted[1].split("\n")[1:]


def measured(rows=400, seed=5):
    """Rows (part, a, b, c, k, i): a far from 0, b with NULL and NaN, c apart from both, k constant, i with an infinite value."""
    rng = np.random.default_rng(seed)
    a = 1e9 + rng.normal(size=rows)
    b = 0.5 * (a - 1e9) + rng.normal(size=rows)
    c = rng.normal(size=rows)
    found = []
    for n in range(rows):
        gap = None if n % 7 == 0 else float("nan") if n % 11 == 0 else float(b[n])
        found.append((n % 4, float(a[n]), gap, None if n % 5 == 0 else float(c[n]), 0.1, float("inf") if n == 9 else float(n)))
    return found


def pearson(rows, x, y):
    pairs = [(r[x], r[y]) for r in rows if None not in (r[x], r[y]) and r[x] == r[x] and r[y] == r[y]]
    return float(np.corrcoef(np.array(pairs).T)[0, 1])


def test_comoments_of_parts_merge_into_those_of_the_whole(spark):
    rows, names = measured(), ["a", "b", "c", "k", "i"]
    frame = spark.createDataFrame(rows, "part int, a double, b double, c double, k double, i double")
    whole = comoments.comoment_cells(frame, names)
    parts = comoments.comoment_cells(frame, names, by=["part"])
    merged = comoments.merge_comoments(parts.drop("part"))
    for cells in (whole, merged):
        found = {(r["x"], r["y"]): r["r"] for r in comoments.correlations(cells, names).collect()}
        assert len(found) == 25
        for i, x in enumerate("abc"):
            assert found[x, x] == 1.0 and found[x, "k"] is None and found["k", x] is None and found[x, "i"] is None
            for j, y in enumerate("abc"):
                assert found[x, y] == pytest.approx(pearson(rows, i + 1, j + 1), abs=1e-9)
        assert found["k", "k"] is None and found["i", "i"] is None
    counts = {(r["x"], r["y"]): r["n"] for r in merged.collect()}
    assert counts["a", "b"] == sum(r[2] is not None and r[2] == r[2] for r in rows) and counts["a", "a"] == 400
    one = {(r["part"], r["x"], r["y"]): r["r"] for r in comoments.correlations(parts, names, ["part"]).collect()}
    assert one[2, "a", "b"] == pytest.approx(pearson([r for r in rows if r[0] == 2], 1, 2), abs=1e-9)


def test_comoments_of_nothing_and_of_clashing_names(spark):
    empty = spark.createDataFrame([], "n double, x double")
    found = comoments.correlations(comoments.comoment_cells(empty, ["n", "x"]), ["n", "x"]).collect()
    assert len(found) == 4 and all(r["r"] is None for r in found)
    named = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, None), (3.0, 6.0, 1.0)], "present double, sum double, `it's` double")
    found = comoments.correlations(comoments.comoment_cells(named, named.columns), named.columns).collect()
    found = {(r["x"], r["y"]): r["r"] for r in found}
    assert found["present", "sum"] == pytest.approx(1.0) and found["it's", "sum"] is None and len(found) == 9


def test_comoments_of_a_stream_are_those_of_its_rows(spark, path):
    rows = [(i, "ab"[i % 2], float((i * 37) % 101)) for i in range(120)]
    stream = streamed(spark, f"{path}/in", rows[:50], rows[50:51], rows[51:])
    stream = stream.select("key", F.col("id").cast("double").alias("id"), F.unix_seconds("at").alias("s"))
    for attempt in ("c", "c2"):  # the second plays the same batches over the same root
        start_comoments(stream, ["id", "s"], f"{path}/out", f"{path}/{attempt}", by=["key"]).awaitTermination()
        cells = read_comoments(spark, f"{path}/out", ["key"])
        found = {(r["key"], r["x"], r["y"]): r["r"] for r in comoments.correlations(cells, ["id", "s"], ["key"]).collect()}
        for key in "ab":
            of = np.array([(i, s) for i, k, s in rows if k == key]).T
            assert found[key, "id", "s"] == pytest.approx(float(np.corrcoef(of)[0, 1]), abs=1e-9)


def alerted(cells, windows, k):
    """{(key, start): (n, rate, mean, sd, alert)} from {(key, start): values}, in plain Python."""
    found = {}
    for key in {c[0] for c in cells}:
        rates = []
        for start in sorted(s for name, s in cells if name == key):
            values = [v for v in cells[key, start] if v is not None]
            rate = sum(values) / len(values) if values else None
            before = [r for r in rates[-windows:] if r is not None]
            mean, sd = (float(np.mean(before)), float(np.std(before))) if before else (None, None)
            alert = rate is not None and mean is not None and abs(rate - mean) > k * sd
            found[key, start] = (len(values), rate, mean, sd, alert)
            rates.append(rate)
    return found


def test_alerts_of_a_stream_are_those_of_its_final_windows(spark, path):
    rng = random.Random(11)
    rows = []
    for n in range(900):
        at = n * 1.0 + rng.random() * 15
        rows.append((None if n % 13 == 0 else rng.randint(0, 9), rng.choice(["a", "b", None]), round(at, 3)))
    rows[500] = (5, "a", 3.0)  # far too late
    rows[501] = (5, "b", None)
    batches = [rows[i : i + 150] for i in range(0, 900, 150)]
    stream = streamed(spark, f"{path}/in", *batches)
    size, late, windows, k = 20, 30, 3, 0.8
    kept, newest, too_late = {}, None, 0
    for batch in batches:
        for value, key, at in batch:
            start = None if at is None else int(at // size) * size
            if at is None or (newest is not None and start + size <= newest - late):
                too_late += 1
            else:
                kept.setdefault((key, start), []).append(value)
        newest = max([newest or 0, *[at for *_, at in batch if at is not None]])
    final = {c: v for c, v in kept.items() if c[1] + size <= newest - late}
    expected = alerted(final, windows, k)
    for attempt in ("c", "c2"):  # the second plays the same batches over the same root
        alerts.start_rate_alerts(
            stream, F.col("at"), F.col("id"), f"{path}/out", f"{path}/{attempt}", late, ["key"], size, windows, k
        ).awaitTermination()
        found = alerts.read_rate_alerts(spark, f"{path}/out", ["key"]).collect()
        assert len(found) == len(expected) > 60
        for r in found:
            n, rate, mean, sd, alert = expected[r["key"], int(r["window_start"].timestamp())]
            assert (r["n"], r["alert"]) == (n, alert)
            for got, want in ((r["rate"], rate), (r["trailing_mean"], mean), (r["trailing_sd"], sd)):
                assert got == (want if want is None else pytest.approx(want, abs=1e-9))
        assert any(r["alert"] for r in found) and not all(r["alert"] for r in found)
        assert spark.read.parquet(f"{path}/out/late").count() == too_late >= 2
    held = spark.read.parquet(f"{path}/out/ring/batch_id=5").groupBy("key").count().collect()
    assert max(r["count"] for r in held) == windows


def test_alerts_without_key_and_of_a_stream_without_rows(spark, path):
    stream = streamed(spark, f"{path}/in", [(1, "a", 5.0), (3, "b", 6.0)], [(9, "a", 25.0)], [(0, "a", 900.0)])
    alerts.start_rate_alerts(stream, F.col("at"), F.col("id"), f"{path}/out", f"{path}/c", late=0, size=20, windows=2).awaitTermination()
    found = sorted((int(r["window_start"].timestamp()), r["n"], r["rate"], r["alert"]) for r in alerts.read_rate_alerts(spark, f"{path}/out").collect())
    assert found == [(0, 2, 2.0, False), (20, 1, 9.0, True)]
    stream = streamed(spark, f"{path}/none", [(1, "a", None)])
    alerts.start_rate_alerts(stream, F.col("at"), F.col("id"), f"{path}/o2", f"{path}/c3", late=0).awaitTermination()
    assert alerts.read_rate_alerts(spark, f"{path}/o2").count() == 0
    assert spark.read.parquet(f"{path}/o2/late").count() == 1
