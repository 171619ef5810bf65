"""The rule classifier and the additive risk score, both kept as data."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.bands import Band, first_match

UNKNOWN = "unknown"


@dataclass(frozen=True)
class BandFactor:
    """Points by the band a number falls into; NULL scores nothing."""

    name: str
    column: str
    bands: tuple[Band, ...]

    def cases(self) -> list[tuple[Column, Band]]:
        return [(band.contains(F.col(self.column)), band) for band in self.bands]

    @property
    def max_points(self) -> int:
        return max(band.points for band in self.bands)


@dataclass(frozen=True)
class MemberFactor:
    """Points when the value is one of a few."""

    name: str
    column: str
    members: tuple[object, ...]
    points: int

    def cases(self) -> list[tuple[Column, Band]]:
        value = F.col(self.column)
        inside = value.isin(*self.members)
        return [
            (inside, Band("yes", None, None, self.points)),
            (value.isNotNull(), Band("no", None, None, 0)),
        ]

    @property
    def max_points(self) -> int:
        return self.points


Factor = BandFactor | MemberFactor

# The additive risk score.
RISK_FACTORS: tuple[Factor, ...] = (
    BandFactor(
        "bmi",
        "bmi",
        (Band("30+", 30, None, 3), Band("25-30", 25, 30, 2), Band("23-25", 23, 25, 1), Band("<23", None, 23, 0)),
    ),
    BandFactor(
        "glucose",
        "blood_glucose_level",
        (
            Band("180+", 180, None, 4),
            Band("140-180", 140, 180, 3),
            Band("100-140", 100, 140, 1),
            Band("<100", None, 100, 0),
        ),
    ),
    BandFactor(
        "hba1c",
        "HbA1c_level",
        (Band("6.5+", 6.5, None, 4), Band("5.7-6.5", 5.7, 6.5, 2), Band("<5.7", None, 5.7, 0)),
    ),
    BandFactor(
        "age",
        "age",
        (Band("65+", 65, None, 2), Band("45-65", 45, 65, 1), Band("<45", None, 45, 0)),
    ),
    MemberFactor("hypertension", "hypertension", (1,), 2),
    MemberFactor("heart_disease", "heart_disease", (1,), 2),
    MemberFactor("smoking", "smoking_history", ("current", "former"), 1),
)
# Lowest score of each level, most severe first.
RISK_LEVELS = (("high", 10), ("moderate", 6), ("low", 3), ("very_low", None))
LEVEL_NAMES = tuple(name for name, _ in RISK_LEVELS)
# The rule classifier; any rule whose conditions all hold predicts 1.
POSITIVE_RULES = (
    (("blood_glucose_level", 140), ("HbA1c_level", 6.5)),
    (("blood_glucose_level", 125), ("HbA1c_level", 6.0), ("bmi", 30)),
    (("age", 65),),
)


def max_score(factors: Sequence[Factor] = RISK_FACTORS) -> int:
    return sum(factor.max_points for factor in factors)


def risk_score(factors: Sequence[Factor] = RISK_FACTORS) -> Column:
    """Sum of the points of every factor."""
    return reduce(operator.add, [points(f) for f in factors])


def risk_level(score: Column, levels: Sequence[tuple[str, int | None]] = RISK_LEVELS) -> Column:
    *cuts, (lowest, _) = levels
    return first_match([(score >= cut, name) for name, cut in cuts], lowest)


def band_label(factor: Factor) -> Column:
    return first_match([(c, band.label) for c, band in factor.cases()], UNKNOWN)


def points(factor: Factor) -> Column:
    return first_match([(c, band.points) for c, band in factor.cases()], 0)


def factor_structs(factors: Sequence[Factor] = RISK_FACTORS) -> Column:
    """Array of struct<factor, band, points>, one entry per factor."""
    return F.array(
        *[
            F.struct(F.lit(f.name).alias("factor"), band_label(f).alias("band"), points(f).alias("points"))
            for f in factors
        ]
    )


def rule_prediction(rules=POSITIVE_RULES) -> Column:
    """1 when some rule has all its strict lower bounds exceeded, else 0."""
    cases = [
        (reduce(operator.and_, [F.col(name) > bound for name, bound in rule]), 1) for rule in rules
    ]
    return first_match(cases, 0)
