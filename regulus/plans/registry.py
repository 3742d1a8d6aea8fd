"""Registry of the runnable queries and their SQL twins."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from regulus.plans import oracle
from regulus.session import use_business_time

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_BODIES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the body of its DuckDB twin, or None for a rows-only check."""
    def wrap(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_business_time(spark)
            return function(spark, sf_dir)

        run.__doc__ = function.__doc__
        QUERIES[name] = run
        if sql is not None:
            _BODIES[name] = sql
        return function
    return wrap


def oracles() -> dict[str, str]:
    """The complete SQL of every query that has a twin."""
    return {name: oracle.complete(body) for name, body in _BODIES.items()}
