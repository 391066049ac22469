"""Small helpers shared by the column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_column(value: Column | str) -> Column:
    """A column from a name or an expression."""
    return F.col(value) if isinstance(value, str) else value


def present(*candidates: Column) -> Column:
    """An array of the non-null candidates, in the given order."""
    return F.filter(F.array(*candidates), lambda item: item.isNotNull())


def empty_strings() -> Column:
    """An empty ``array<string>``."""
    return F.array().cast("array<string>")


def whole_div(value: Column | str, divisor: int) -> Column:
    """Integral division, exact for every bigint."""
    return F.call_function("div", as_column(value).cast("bigint"), F.lit(divisor).cast("bigint"))
