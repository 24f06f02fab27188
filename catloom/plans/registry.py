"""Queries with their oracles: a decorator that keeps both side by side."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) under its name, with the SQL that gives the same rows."""

    def add(function: Callable) -> Callable:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return add
