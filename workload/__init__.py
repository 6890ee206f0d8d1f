"""Queries over the driver's tables, each with its SQL counterpart where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query and, if SQL can state its result, that SQL."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"Duplicate query: {name}")
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


from workload import dates, jobs, reads, tables  # noqa: E402, F401
