"""Registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from importlib import import_module

#: Modules with QUERIES and SQL.
MODULES = ["queries_search", "queries_text"]


def _merged(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out |= getattr(import_module(f"pagelathe.llm.{name}"), attribute)
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict:
    return _merged("SQL")
