"""Queries over the given tables, each with its check in SQL where SQL can state it."""

from tallyloom.plans.registry import Query, registered

__all__ = ["Query", "registered"]
