"""Summaries of the scored table.

Each one aggregates with map-side combining first, so what is shuffled and what the later
windows and joins see is one row per group, not per observation.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.bands import AGE_BANDS, BMI_BANDS, age_band, band_of
from riskloom.functions.nulls import count_if, nan_to_null, ratio, same
from riskloom.functions.rules import LEVEL_NAMES, RISK_FACTORS, UNKNOWN, band_label, factor_structs, risk_level, risk_score
from riskloom.operators.comoments import comoment_cells, correlations
from riskloom.operators.dims import complete, members
from riskloom.operators.metrics import ACTUAL, PREDICTED
from riskloom.operators.prep import with_position_share
from riskloom.operators.ranges import exact_quantiles


def _over_all(value: Column) -> Column:
    """Aggregate over the whole table; only ever used on one row per group."""
    return value.over(Window.partitionBy())


def with_risk(df: DataFrame, factors=RISK_FACTORS) -> DataFrame:
    """Add risk_score and risk_level."""
    scored = df.withColumn("risk_score", risk_score(factors))
    return scored.withColumn("risk_level", risk_level(F.col("risk_score")))


def factor_points(df: DataFrame, keys: Sequence[str], factors=RISK_FACTORS) -> DataFrame:
    """Long form: (*keys, factor, band, points), one row per observation and factor."""
    return df.select(*keys, F.inline(factor_structs(factors)))


# --- rows -------------------------------------------------------------------------------


def since(df: DataFrame, instant: dt.datetime, column: str = "processing_time") -> DataFrame:
    """Rows after the instant, which is cut to whole seconds and read in the column's own time zone rules."""
    start = F.lit(instant.strftime("%Y-%m-%d %H:%M:%S")).cast(df.schema[column].dataType)
    return df.where(F.col(column) > start)


def recent(df: DataFrame, order: Sequence[str], n: int, columns: Sequence[str]) -> DataFrame:
    """The n latest rows; Spark keeps only n per task for this."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n).select(*columns)


DISPLAY_DIGITS = {"age": 0, "blood_glucose_level": 1, "HbA1c_level": 1, "bmi": 1}


def displayed(df: DataFrame, digits=DISPLAY_DIGITS) -> DataFrame:
    """Numbers rounded half-even the way the recent-rows table shows them."""
    return df.withColumns({c: F.bround(c, n) for c, n in digits.items()})


def risk_points(df: DataFrame, keys: Sequence[str], fraction: float | None = None, seed: int = 42) -> DataFrame:
    """Points of the bubble and 3-D charts; give `fraction` to thin out what a chart draws."""
    points = df.select(
        *keys, "blood_glucose_level", "HbA1c_level", "bmi", "risk_score", "risk_level", "age", "gender"
    )
    return points if fraction is None else points.sample(fraction=fraction, seed=seed)


# The high-risk reference line runs from (100, 5.0) to (200, 8.0).
RISK_LINE = ((100.0, 5.0), (200.0, 8.0))


def above_line(
    df: DataFrame, x: str = "blood_glucose_level", y: str = "HbA1c_level", line=RISK_LINE
) -> DataFrame:
    (x0, y0), (x1, y1) = line
    slope = (y1 - y0) / (x1 - x0)
    return df.where(F.col(y) > F.lit(y0) + F.lit(slope) * (F.col(x) - F.lit(x0)))


# --- distributions ----------------------------------------------------------------------


def level_distribution(df: DataFrame, levels: Sequence[str] = LEVEL_NAMES) -> DataFrame:
    """(risk_level, severity, n, pct): every level, also unseen ones, most severe first."""
    return complete_levels(df.groupBy("risk_level").agg(F.count("*").alias("n")), levels)


def complete_levels(counts: DataFrame, levels: Sequence[str] = LEVEL_NAMES) -> DataFrame:
    dim = members(counts.sparkSession, "risk_level", levels, "severity")
    return (
        complete(counts, dim, "risk_level", {"n": 0})
        .withColumn("pct", F.bround(ratio(F.col("n"), _over_all(F.sum("n"))) * 100.0, 1))
        .select("risk_level", "severity", "n", "pct")
        .orderBy("severity")
    )


def band_counts(df: DataFrame) -> DataFrame:
    """(age_band, predicted, n, pct): bands x observed classes with zero cells, share in band."""
    counts = (
        df.select(age_band(F.col("age")).alias("age_band"), F.col(PREDICTED).alias("predicted"))
        .where(F.col("predicted").isNotNull())
        .groupBy("age_band", "predicted")
        .agg(F.count("*").alias("n"))
    )
    # Each count brings a zero for every band along, so all bands appear with all classes.
    own = F.struct(F.col("age_band"), F.col("n"))
    zeros = [F.struct(F.lit(b.label).alias("age_band"), F.lit(0).cast("long").alias("n")) for b in AGE_BANDS]
    full = (
        counts.select("predicted", F.inline(F.array(own, *zeros)))
        .where(F.col("age_band").isNotNull())
        .groupBy("age_band", "predicted")
        .agg(F.sum("n").alias("n"))
    )
    return share_of(full, "age_band")


def share_of(df: DataFrame, by: str, value: str = "n", out: str = "pct") -> DataFrame:
    """Percent of the group's total, on an already grouped table."""
    return df.withColumn(out, ratio(F.col(value), F.sum(value).over(Window.partitionBy(by))) * 100.0)


def crosstab_share(df: DataFrame, row: str, column: str) -> DataFrame:
    """Long cross-tabulation (row, column, n, pct of the row) of all values there are, zero cells included.

    A NULL column value is a value like the others; rows without a `row` value are left out.
    """
    counts = df.where(F.col(row).isNotNull()).groupBy(row, column).agg(F.count("*").alias("n"))
    seen = _over_all(F.collect_set(F.struct(column)))
    per_row = counts.withColumn("_seen", seen).groupBy(row).agg(
        F.collect_list(F.struct(column, "n")).alias("_own"), F.first("_seen").alias("_seen")
    )
    zeros = F.transform("_seen", lambda v: F.struct(v[column].alias(column), F.lit(0).cast("long").alias("n")))
    cells = per_row.select(row, F.inline(F.concat("_own", zeros)))
    return share_of(cells.groupBy(row, column).agg(F.sum("n").alias("n")), row)


def stacked_positions(df: DataFrame, row: str, column: str, floor: float = 5.0) -> DataFrame:
    """Label position of each stacked segment with a share of at least `floor` percent."""
    shares = with_position_share(crosstab_share(df, row, column), "pct", row, column, "label_y")
    return shares.where(F.col("pct") >= floor).select(row, column, "pct", "label_y")


def histogram(df: DataFrame, column: str, bins: int, by: str) -> DataFrame:
    """Equal-width bins over the whole range, the last one closed: (by, bin, lo, hi, n). NaN counts as missing."""
    value = nan_to_null(F.col(column).cast("double"))
    low, high = df.agg(F.min(value), F.max(value)).first()
    width = ((high - low) / bins if low is not None else 0.0) or 1.0
    index = F.least(F.floor((value - F.lit(low).cast("double")) / width), F.lit(bins - 1)).cast("int")
    return (
        df.where(value.isNotNull())
        .groupBy(by, index.alias("bin"))
        .agg(F.count("*").alias("n"))
        .withColumn("lo", F.lit(low).cast("double") + F.col("bin") * width)
        .withColumn("hi", F.lit(low).cast("double") + (F.col("bin") + 1) * width)
        .select(by, "bin", "lo", "hi", "n")
    )


def score_histogram(df: DataFrame) -> DataFrame:
    """Rows per risk level and whole score."""
    return (
        df.groupBy("risk_level", F.col("risk_score").alias("bin"))
        .agg(F.count("*").alias("n"))
        .select("risk_level", "bin", F.col("bin").alias("lo"), (F.col("bin") + 1).alias("hi"), "n")
    )


def box_stats(df: DataFrame, column: str, by: str, exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """min, quartiles, max and fences: the outermost values within 1.5 interquartile ranges."""
    rows = df.select(by, nan_to_null(F.col(column).cast("double")).alias("value")).where(F.col("value").isNotNull())
    if exact:
        shares = exact_quantiles(rows, ["value"], (0.25, 0.5, 0.75), [by])
        quartiles = shares.groupBy(by).agg(
            *[
                F.max(F.when(F.col("share") == s, F.col("value"))).alias(name)
                for s, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
            ]
        )
    else:
        found = F.percentile_approx("value", [0.25, 0.5, 0.75], accuracy)
        quartiles = rows.groupBy(by).agg(found.alias("q")).select(
            by, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
        )
    joined = rows.alias("l").join(quartiles.alias("r"), F.col(f"l.{by}").eqNullSafe(F.col(f"r.{by}")))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    value = F.col("value")
    return joined.groupBy(F.col(f"r.{by}")).agg(
        F.min(value).alias("min"),
        F.first("q1").alias("q1"),
        F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.max(value).alias("max"),
        F.min(F.when(value >= F.col("q1") - reach, value)).alias("lower_fence"),
        F.max(F.when(value <= F.col("q3") + reach, value)).alias("upper_fence"),
    )


def bmi_bands(df: DataFrame) -> DataFrame:
    banded = df.where(F.col("bmi").isNotNull())
    return banded.groupBy(band_of(F.col("bmi"), BMI_BANDS).alias("band")).agg(F.count("*").alias("n"))


# --- time -------------------------------------------------------------------------------


def hourly(df: DataFrame, column: str = "processing_time") -> DataFrame:
    """Per hour of day, all days together; rows without a prediction are not counted."""
    total, positive, correct = F.col("total"), F.col("positive"), F.col("correct")
    return (
        df.groupBy(F.date_format(column, "HH:00").alias("hour_bin"))
        .agg(
            F.count(PREDICTED).alias("total"),
            F.coalesce(F.sum(F.col(PREDICTED).cast("long")), F.lit(0).cast("long")).alias("positive"),
            count_if(same(F.col(ACTUAL), F.col(PREDICTED))).alias("correct"),
        )
        .withColumn("positive_rate", F.bround(F.try_divide(positive, total) * 100.0, 1))
        .withColumn("accuracy", F.bround(F.try_divide(correct, total) * 100.0, 1))
    )


def record_growth(df: DataFrame, column: str = "processing_time") -> DataFrame:
    """Record total at the end of each day against the day before: (day, n, prev_n, growth, growth_pct)."""
    daily = df.groupBy(F.to_date(column).alias("day")).agg(F.count("*").alias("added"))
    # One row per calendar day from here on.
    days = Window.orderBy("day")
    return (
        daily.withColumn("n", F.sum("added").over(days))
        .withColumn("prev_n", F.lag("n", 1, 0).over(days))
        .withColumn("growth", F.col("n") - F.col("prev_n"))
        .withColumn("growth_pct", ratio(F.col("growth"), F.col("prev_n")) * 100.0)
        .select("day", "n", "prev_n", "growth", "growth_pct")
    )


def session_span(df: DataFrame, by: str, column: str = "processing_time") -> DataFrame:
    """Time between first and last row per group as hours (days included), minutes, seconds."""
    span = F.timestamp_diff("SECOND", F.min(column), F.max(column))
    return df.groupBy(by).agg(span.alias("span")).select(
        by,
        F.floor(F.col("span") / 3600).alias("hours"),
        F.floor((F.col("span") % 3600) / 60).alias("minutes"),
        (F.col("span") % 60).alias("seconds"),
    )


# --- correlation and profiles -----------------------------------------------------------


def correlation_matrix(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Pearson (x, y, r) over the rows where both are present; NULL for a constant column."""
    found = correlations(comoment_cells(df, columns), columns)
    return found.withColumn("r", F.bround("r", digits))


def risk_radar(
    df: DataFrame,
    continuous: Sequence[str] = ("bmi", "blood_glucose_level", "HbA1c_level", "age"),
    binary: Sequence[str] = ("hypertension", "heart_disease"),
    levels: Sequence[str] = LEVEL_NAMES,
) -> DataFrame:
    """(risk_level, metric, value): mean profile per level, continuous ones scaled to 0..1.

    The overall range comes from the per-level ranges, so the table is read once.
    """
    metrics = [*continuous, *binary]
    per_level = df.groupBy("risk_level").agg(
        *[F.avg(c).alias(c) for c in metrics],
        *[F.min(c).alias(f"{c}_min") for c in continuous],
        *[F.max(c).alias(f"{c}_max") for c in continuous],
    )
    scaled = per_level.select("risk_level", *[_scaled_mean(c).alias(c) for c in continuous], *binary)
    dim = members(df.sparkSession, "risk_level", levels).drop("rank")
    full = complete(scaled, dim, "risk_level", dict.fromkeys(metrics, 0.0))
    return full.unpivot(["risk_level"], metrics, "metric", "value")


def _scaled_mean(column: str) -> Column:
    low = _over_all(F.min(f"{column}_min"))
    high = _over_all(F.max(f"{column}_max"))
    return ratio(F.col(column) - low, high - low)


def high_risk_profile(df: DataFrame, level: str = LEVEL_NAMES[0]) -> DataFrame:
    """n, pct and mean profile of one level, rounded to one decimal; zeros when it is empty."""
    chosen = F.col("risk_level") == level
    summary = df.agg(
        F.count("*").alias("total"),
        count_if(chosen).alias("n"),
        F.avg(F.when(chosen, F.col("blood_glucose_level"))).alias("avg_glucose"),
        F.avg(F.when(chosen, F.col("HbA1c_level"))).alias("avg_hba1c"),
        F.avg(F.when(chosen, F.col("bmi"))).alias("avg_bmi"),
        (F.avg(F.when(chosen, F.col("hypertension"))) * 100).alias("hypertension_pct"),
    )
    means = ("avg_glucose", "avg_hba1c", "avg_bmi", "hypertension_pct")
    return summary.select(
        "n",
        F.bround(ratio(F.col("n"), F.col("total")) * 100.0, 1).alias("pct"),
        *[F.coalesce(F.bround(c, 1), F.lit(0.0)).alias(c) for c in means],
    )


def most_at_risk(df: DataFrame, level: str = LEVEL_NAMES[0]) -> DataFrame:
    """(dimension, value, n): most frequent gender and age band of a level, smallest on a tie.

    The level is counted, not filtered on: a filter would be pushed down to the scan together
    with a copy of the whole score for each of its uses.
    """
    dimensions = ["gender", "age_band"]
    cells = df.groupBy("gender", age_band(F.col("age")).alias("age_band")).agg(
        count_if(F.col("risk_level") == level).alias("n")
    )
    counts = (
        cells.unpivot(["n"], dimensions, "dimension", "value")
        .where(F.col("value").isNotNull())
        .groupBy("dimension", "value")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") > 0)
    )
    rank = Window.partitionBy("dimension").orderBy(F.col("n").desc(), F.col("value"))
    top = counts.withColumn("rank", F.row_number().over(rank)).where("rank = 1").drop("rank")
    dim = members(df.sparkSession, "dimension", dimensions).drop("rank")
    return complete(top, dim, "dimension", {"value": UNKNOWN, "n": 0})


def age_decade_mode(df: DataFrame) -> DataFrame:
    """The most common age decade, the smallest on a tie."""
    decade = (F.floor(F.col("age") / 10) * 10).cast("int")
    return (
        df.where(F.col("age").isNotNull())
        .groupBy(decade.alias("decade"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), "decade")
        .limit(1)
        .select("decade")
    )


def correct_bmi_class(df: DataFrame) -> DataFrame:
    """Mean BMI of the correctly predicted rows, `normal` below 25, else `high`."""
    mean = F.avg(F.when(same(F.col(ACTUAL), F.col(PREDICTED)), F.col("bmi")))
    return df.agg(mean.alias("avg_bmi")).withColumn(
        "bmi_class", F.when(F.col("avg_bmi") < 25, "normal").otherwise("high")
    )


def risk_headline(df: DataFrame, level: str = LEVEL_NAMES[0]) -> DataFrame:
    return df.agg(
        count_if(F.col("risk_level") == level).alias("high_n"),
        F.avg("risk_score").alias("avg_risk_score"),
    )


def decision_flow(df: DataFrame, factors=RISK_FACTORS) -> DataFrame:
    """Observations per (factor, band, risk level).

    Rows are first counted per combination of bands, of which there are only so many, and the
    combinations instead of the observations are then taken apart by factor.
    """
    names = [f.name for f in factors]
    combinations = (
        df.select("risk_level", *[band_label(f).alias(f.name) for f in factors])
        .groupBy("risk_level", *names)
        .agg(F.count("*").alias("n"))
    )
    return (
        combinations.unpivot(["risk_level", "n"], names, "factor", "band")
        .groupBy("factor", "band", "risk_level")
        .agg(F.sum("n").alias("n"))
    )
