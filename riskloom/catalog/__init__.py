"""Every operator as a query over the test tables, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.catalog import charts, extensions, mechanisms, models, prep, profiles, rules, streams

SECTIONS = (rules, prep, profiles, charts, streams, models, extensions, mechanisms)

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    return {name: query for section in SECTIONS for name, query in section.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for section in SECTIONS for name, sql in section.ORACLES.items()}
