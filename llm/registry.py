"""The queries of this package and the SQL that must give the same rows, by name."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    """Register a query (spark, sf_dir) -> DataFrame with its DuckDB twin, where SQL can express it."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register
