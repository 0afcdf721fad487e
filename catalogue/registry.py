"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its SQL where SQL can express it."""

    def register(build: Query) -> Query:
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(use_utc(spark), sf_dir)

        QUERIES[name] = call
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
