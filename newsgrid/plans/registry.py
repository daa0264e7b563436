"""Registry of runnable queries and the SQL each one is checked against."""

from __future__ import annotations

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    """Register a ``(spark, sf_dir) -> DataFrame`` callable, with its DuckDB SQL when one exists."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register
