"""Constants, estimator and SQL-callable functions of the distinct-count sketch."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

from tallyloom.functions.columns import as_column

MIN_PRECISION = 4
MAX_PRECISION = 16
DEFAULT_PRECISION = 14

# Fixed values of the estimator.
ALPHA_16 = 0.673
ALPHA_32 = 0.697
ALPHA_64 = 0.709
ALPHA_NUMERATOR = 0.7213
ALPHA_CORRECTION = 1.079
SMALL_RANGE_FACTOR = 2.5
HASH_SPACE = float(1 << 32)
# Rough cost of one element of an exact in-memory set: pointer plus string.
EXACT_BYTES_PER_ELEMENT = 48


def check_precision(precision: int) -> int:
    """Return ``precision`` or raise when it is outside 4..16."""
    if isinstance(precision, bool) or not isinstance(precision, int):
        raise ValueError("Precision must be an integer")
    if not MIN_PRECISION <= precision <= MAX_PRECISION:
        raise ValueError(f"Precision must be between {MIN_PRECISION} and {MAX_PRECISION}")
    return precision


def checked_precision(precision: Column | str) -> Column:
    """Column form of :func:`check_precision`: fails the job on a bad row."""
    precision = as_column(precision)
    ok = precision.between(MIN_PRECISION, MAX_PRECISION)
    message = f"Precision must be between {MIN_PRECISION} and {MAX_PRECISION}"
    return F.when(ok, precision).otherwise(F.raise_error(F.lit(message)).cast("int"))


def registers_of(precision: Column | str) -> Column:
    """Number of registers, ``2^precision``, as bigint."""
    return F.pow(F.lit(2), as_column(precision)).cast("bigint")


def alpha_mm(registers: Column | str) -> Column:
    """Bias constant times the squared register count."""
    m = as_column(registers).cast("double")
    alpha = (
        F.when(m == 16, ALPHA_16)
        .when(m == 32, ALPHA_32)
        .when(m == 64, ALPHA_64)
        .otherwise(F.lit(ALPHA_NUMERATOR) / (F.lit(1.0) + F.lit(ALPHA_CORRECTION) / m))
    )
    return alpha * m * m


def raw_estimate(registers: Column, harmonic_sum: Column) -> Column:
    """Uncorrected estimate from the sum of ``2^-register`` over all registers."""
    return alpha_mm(registers) / harmonic_sum


RANGE_MESSAGE = "The sketch is beyond the range of 32-bit hashes; build it with a 64-bit hash"


def corrected_estimate(registers: Column, raw: Column, zeros: Column, hash_bits: Column | int = 32) -> Column:
    """Small- and large-range corrections, truncated to bigint.

    Hashes of 32 bits need the large-range correction and fail the job where it has no answer; 64 bits need none.
    """
    narrow = (hash_bits if isinstance(hash_bits, Column) else F.lit(hash_bits)) == 32
    m = registers.cast("double")
    linear = m * F.ln(m / F.nullif(zeros, F.lit(0)))
    small = raw <= F.lit(SMALL_RANGE_FACTOR) * m
    large = raw > F.lit(HASH_SPACE / 30.0)
    estimate = F.when(small & (zeros > 0), linear).when(small, raw)
    estimate = estimate.when(narrow & (raw >= HASH_SPACE), F.raise_error(F.lit(RANGE_MESSAGE)).cast("double")).when(
        narrow & large, F.lit(-HASH_SPACE) * F.ln(F.lit(1.0) - raw / F.lit(HASH_SPACE))
    )
    return estimate.otherwise(raw).cast("bigint")


def error_pct(actual: Column | str, estimate: Column | str) -> Column:
    """Relative error in percent; null when nothing was counted."""
    actual, estimate = as_column(actual), as_column(estimate)
    return F.try_divide(F.abs(actual - estimate), actual) * 100


_SQL_FUNCTIONS = {
    "compute_hash": (
        "value STRING",
        "BIGINT",
        "CAST(conv(concat(substr(sha2(value, 256), 7, 2), substr(sha2(value, 256), 5, 2), "
        "substr(sha2(value, 256), 3, 2), substr(sha2(value, 256), 1, 2)), 16, 10) AS BIGINT)",
    ),
    "count_leading_zeros": (
        "value BIGINT, width INT",
        "INT",
        "CAST(width - 1 - floor(log2(value + 0.5D)) AS INT)",
    ),
    "get_alpha_constant": (
        "registers INT",
        "DOUBLE",
        f"CASE registers WHEN 16 THEN {ALPHA_16}D WHEN 32 THEN {ALPHA_32}D WHEN 64 THEN {ALPHA_64}D "
        f"ELSE {ALPHA_NUMERATOR}D / (1.0D + {ALPHA_CORRECTION}D / registers) END "
        "* CAST(registers AS DOUBLE) * CAST(registers AS DOUBLE)",
    ),
}


def register_hll_functions(spark: SparkSession) -> list[str]:
    """Create the SQL-callable functions; Catalyst inlines them into the query."""
    for name, (arguments, result, body) in _SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    return list(_SQL_FUNCTIONS)
