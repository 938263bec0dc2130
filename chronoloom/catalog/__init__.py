"""Registered queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Adds a query (spark, sf_dir) -> DataFrame; sql is its twin on the same tables."""

    def add(f):
        assert name not in QUERIES, name
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


from chronoloom.catalog import audit, files, forms, levels, places, reconcile, rules, serving, stores, streams, trees  # noqa: E402, F401
