"""The registered queries, each next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foldspark.session import configure, release_held

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder)``; without SQL only our own tests check it."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            release_held()
            return fn(configure(spark), folder)

        run.__name__, run.__doc__ = name, fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
