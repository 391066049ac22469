"""Rules on drug codes, strengths and frequencies."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallyloom.functions.columns import as_column

# The accepted forms.
NDC11_PATTERN = r"^\d{11}$"
STRENGTH_PATTERN = r"^\d+(\.\d+)?\s*(mg|g|mcg|mL|%|unit|IU)$"
FREQUENCY_PATTERNS = [
    r"^\d+\s*times?\s*(daily|per\s*day)$",
    r"^every\s*\d+\s*(hours?|days?)$",
    r"^once\s*daily$",
    r"^twice\s*daily$",
    r"^three\s*times?\s*daily$",
    r"^four\s*times?\s*daily$",
    r"^as\s*needed$",
    r"^with\s*meals?$",
]
LABELER_LENGTH, PRODUCT_LENGTH, PACKAGE_LENGTH = 5, 4, 2

NDC_ERROR = "Invalid NDC-11 code"
STRENGTH_WARNING = "Unusual strength format"
FREQUENCY_WARNING = "Unusual frequency pattern"


def ndc11_format(code: Column | str) -> Column:
    """True for exactly eleven digits; false for null."""
    return _matches(code, NDC11_PATTERN)


def labeler_of(code: Column | str) -> Column:
    """The labeler part of a drug code."""
    return F.substring(as_column(code), 1, LABELER_LENGTH)


def strength_ok(strength: Column | str) -> Column:
    """True for a number followed by a known unit, ignoring case."""
    return _matches(strength, f"(?i){STRENGTH_PATTERN}")


def frequency_ok(frequency: Column | str) -> Column:
    """True for any of the accepted frequency forms, ignoring case."""
    return _matches(frequency, "(?i)" + "|".join(FREQUENCY_PATTERNS))


def _matches(value: Column | str, pattern: str) -> Column:
    return F.coalesce(as_column(value).rlike(pattern), F.lit(False))


def ndc11_parts(code: Column | str, valid: Column) -> dict[str, Column]:
    """``labeler, product, package``, null where the code is not valid."""
    code = as_column(code)
    product_at = 1 + LABELER_LENGTH
    package_at = product_at + PRODUCT_LENGTH
    return {
        "labeler": F.when(valid, labeler_of(code)),
        "product": F.when(valid, F.substring(code, product_at, PRODUCT_LENGTH)),
        "package": F.when(valid, F.substring(code, package_at, PACKAGE_LENGTH)),
    }
