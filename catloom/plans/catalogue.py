"""Registered queries of the catalogue operators, each with its SQL oracle where SQL can express it."""

from __future__ import annotations

from catloom.plans import registry, table_queries, text_queries  # noqa: F401  (registration happens on import)


def queries() -> dict:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.ORACLES)
