"""Registered queries: name -> DataFrame function, and name -> SQL."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("text_queries", "split_queries", "access_queries", "vector_queries", "metric_queries", "stream_queries", "storage_queries")


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for name in _MODULES:
        part = getattr(import_module(f"sievegate.catalog.{name}"), attribute)
        repeated = merged.keys() & part.keys()
        if repeated:
            raise ValueError(f"registered twice: {sorted(repeated)}")
        merged.update(part)
    return merged


def all_queries() -> dict:
    return _merged("QUERIES")


def all_oracles() -> dict:
    return _merged("ORACLES")
