"""Registration of a query with its optional SQL."""

from __future__ import annotations


def registry() -> tuple[dict, dict, object]:
    """``(queries, oracles, decorator)`` for one module."""
    queries: dict = {}
    oracles: dict = {}

    def query(name: str, sql: str | None = None):
        def register(function):
            queries[name] = function
            if sql is not None:
                oracles[name] = sql
            return function

        return register

    return queries, oracles, query
