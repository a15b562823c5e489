"""Registry of the queries: name -> (function of (spark, sf_dir), SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register


def load() -> None:
    from vetrina.queries import funnel, lifecycle, misc, operations, profiles, reports, scans, stream  # noqa: F401
