"""The registered queries and their DuckDB equivalents, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clipspans.plans.inputs import with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, *ctes: str):
    """Registers a query; sql may use the CTEs that it names."""

    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            plain = sql.replace(", 6) as ", ", 6) + 0.0e0 as ")  # DuckDB rounds small negatives to -0.0
            ORACLES[name] = with_ctes(plain, *ctes) if ctes else plain
        return function

    return keep
