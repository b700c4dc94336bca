"""The register of queries."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, when given, the SQL that must return the same rows."""
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register
