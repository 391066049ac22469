"""The table of registered queries."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

_MODULES = ("sketches", "etl", "batches", "graphs", "dosages", "workflows", "care", "streams")
_QUERIES: dict[str, Query] = {}


@dataclass(frozen=True)
class Query:
    """A query over a table folder; ``sql`` gives the same rows in SQL."""

    run: Run
    sql: str | None = None


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its own name."""

    def add(run: Run) -> Run:
        _QUERIES[run.__name__] = Query(run, sql)
        return run

    return add


def registered() -> dict[str, Query]:
    """All queries by name."""
    for module in _MODULES:
        importlib.import_module(f"tallyloom.plans.{module}")
    return dict(_QUERIES)
