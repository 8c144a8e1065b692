"""Registered queries: a callable over the given tables, and the same question as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodgeline.plans.views import with_views
from lodgeline.sources.fixtures import Tables

Query = Callable[[Tables], DataFrame]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query. Views named in the SQL are put before it."""

    def add(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: run(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return run

    return add
