"""Queries over the shared tables that exercise the engine's operators, with their SQL twins."""

from __future__ import annotations

from weftline.plans import extraction, records, retrieval, web

_MODULES = (extraction, records, retrieval, web)


def flagship(spark, sf_dir: str):
    """Completeness of what the rules find in pages."""
    return extraction.page_completeness(spark, sf_dir)


def queries() -> dict:
    return {name: query for m in _MODULES for name, (query, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, (_, sql) in m.QUERIES.items() if sql}
