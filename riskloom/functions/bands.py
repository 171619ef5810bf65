"""Value bands as data, compiled to CASE expressions."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Band:
    """A labelled interval; None is an open end."""

    label: str
    low: float | None
    high: float | None
    points: int = 0

    def contains(self, value: Column, closed: str = "left") -> Column:
        conditions = []
        if self.low is not None:
            conditions.append(value >= self.low if closed == "left" else value > self.low)
        if self.high is not None:
            conditions.append(value < self.high if closed == "left" else value <= self.high)
        return reduce(operator.and_, conditions) if conditions else value.isNotNull()


def first_match(cases: Sequence[tuple[Column, object]], otherwise: object = None) -> Column:
    """CASE WHEN over (condition, value) pairs."""
    head, *rest = cases
    chain = F.when(*head)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain.otherwise(otherwise)


def band_of(
    value: Column, bands: Sequence[Band], closed: str = "left", otherwise: str | None = None
) -> Column:
    return first_match([(b.contains(value, closed), b.label) for b in bands], otherwise)


# Age groups are right-closed, so 0 and anything above 100 has no group.
AGE_BANDS = (
    Band("<30", 0, 30),
    Band("30-40", 30, 40),
    Band("40-50", 40, 50),
    Band("50-60", 50, 60),
    Band("60-70", 60, 70),
    Band("70+", 70, 100),
)
# Body-mass reference lines at 18.5, 25 and 30.
BMI_BANDS = (
    Band("underweight", None, 18.5),
    Band("normal", 18.5, 25),
    Band("overweight", 25, 30),
    Band("obese", 30, None),
)
# HbA1c bands; 5.7 up to 6.5 is the borderline one.
HBA1C_BANDS = (
    Band("normal", None, 5.7),
    Band("borderline", 5.7, 6.5),
    Band("high", 6.5, None),
)


def age_band(age: Column) -> Column:
    return band_of(age, AGE_BANDS, closed="right")
