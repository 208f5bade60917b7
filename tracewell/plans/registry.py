"""Named queries over the tables of one directory, with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tracewell.session import prepare
from tracewell.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` as ``name``; ``sql`` computes the same rows."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, directory: str) -> DataFrame:
            return fn(Tables(prepare(spark), directory))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
