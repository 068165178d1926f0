"""Registered queries of the core engine and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

_MODULES = ["nested", "scalars", "retrieval", "pipeline"]


def _merged(attribute: str) -> dict:
    out: dict = {}
    for name in _MODULES:
        part = getattr(import_module(f"pagelathe.plans.{name}"), attribute)
        clash = out.keys() & part.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        out |= part
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("SQL")
