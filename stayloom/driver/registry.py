"""Registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from stayloom.driver.views import Views, with_views
from stayloom.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: Sequence[str] = ()):
    """Register a function of the derived tables, with the SQL that gives the same rows."""

    def register(function: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(Views(tune(spark), folder))

        run.__name__ = name
        run.__doc__ = function.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql, views)
        return function

    return register
