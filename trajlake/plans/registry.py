"""Named queries over the tables of a scale folder, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated (spark, folder) -> DataFrame under name."""

    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


def sql(name: str, text: str) -> None:
    """Give a registered query its SQL."""
    assert name in QUERIES
    ORACLES[name] = text
