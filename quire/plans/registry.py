"""All queries of the core, by name, and their SQL."""

from __future__ import annotations

from quire.plans import answers, navigation, pages, quantities, retrieval, sections

MODULES = (quantities, pages, answers, sections, retrieval, navigation)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: s for m in MODULES for k, s in m.SQL.items()} | navigation.WHOLE_SQL
