"""Persisted sketches: one row per id with a packed register array.

Each change is a new frame made from the old one. Write it (see
``session.materialize``) before the next change is built on it: a lost executor
or a failed job then leaves the old version whole, and plans stay short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tallyloom.functions.cardinality import DEFAULT_PRECISION, check_precision
from tallyloom.operators.sketch import (
    DEFAULT_HASH,
    DENSE,
    MIXED_HASHES,
    MIXED_MESSAGE,
    SPARSE,
    encoded_registers,
    hash_bits_of,
    hll_estimate,
    larger_registers,
    pack_registers,
    stored_entries,
    unpack_registers,
)

#: Every row names the hash of its registers and how they are encoded.
STATE_SCHEMA = (
    "hll_id int, precision int, hash string, encoding string, buckets binary, created_date timestamp_ntz, last_updated_date timestamp_ntz"
)
_KEY = ["hll_id"]


def utc_now() -> Column:
    """Current time as a UTC wall clock without zone."""
    return F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), F.localtimestamp()
    )


def empty_state(spark: SparkSession) -> DataFrame:
    """A state table without sketches."""
    columns = StructType.fromDDL(STATE_SCHEMA)
    return spark.range(0).select(*[F.lit(None).cast(column.dataType).alias(column.name) for column in columns])


def init_sketch(
    state: DataFrame,
    ids: DataFrame,
    precision: int = DEFAULT_PRECISION,
    now: Column | None = None,
    hash_name: str = DEFAULT_HASH,
    encoding: str = DENSE,
) -> DataFrame:
    """Replace or create the sketches of ``ids.hll_id`` with empty ones of that hash; a dense one is all zeros, a sparse one has no bytes."""
    check_precision(precision)
    hash_bits_of(hash_name)
    if encoding not in (DENSE, SPARSE):
        raise ValueError(f"encoding must be {DENSE} or {SPARSE}")
    now = utc_now() if now is None else now
    ids = ids.select("hll_id").distinct()
    empty = ids.select(
        F.col("hll_id").cast("int"),
        F.lit(precision).alias("precision"),
        F.lit(hash_name).alias("hash"),
        F.lit(encoding).alias("encoding"),
        F.unhex(F.repeat(F.lit("00"), 1 << precision) if encoding == DENSE else F.lit("")).alias("buckets"),
        now.alias("created_date"),
        now.alias("last_updated_date"),
    )
    return state.join(ids, "hll_id", "left_anti").unionByName(empty)


def upsert_sketch(state: DataFrame, delta: DataFrame, now: Column | None = None) -> DataFrame:
    """Merge the long-form ``delta`` (``hll_id, precision, hash, bucket, rank``) into ``state``.

    ``last_updated_date`` moves only where a register grew. State and delta are
    read once and meet in one join; registers are compared byte by byte inside
    the row. A sparse sketch stays sparse until a dense one is shorter. Ids without a sketch are an error, as is a different
    precision or hash.
    """
    now = utc_now() if now is None else now
    new = pack_registers(delta, _KEY).select(
        "hll_id", F.col("precision").alias("_precision"), F.col("hash").alias("_hash"), F.col("buckets").alias("_buckets")
    )
    dense_of = encoded_registers(stored_entries(F.col("buckets"), F.col("encoding")), F.col("precision"), F.lit(DENSE))
    larger = larger_registers(F.col("_dense"), F.col("_buckets"))
    found = F.col("precision").isNotNull()
    differ = lambda message, one, other: F.raise_error(F.concat(F.lit(f"{message}: "), F.col(one).cast("string"), F.lit(", "), F.col(other).cast("string")))
    checked = (
        F.when(~found, F.raise_error(F.lit("Sketch with specified ID not found")).cast("int"))
        .when(F.col("_precision") != F.col("precision"), differ(MIXED_MESSAGE, "precision", "_precision").cast("int"))
        .when(F.col("_hash") != F.col("hash"), differ(MIXED_HASHES, "hash", "_hash").cast("int"))
        .otherwise(F.col("precision"))
    )
    touched = F.col("_buckets").isNotNull()
    sparse = encoded_registers(stored_entries(F.col("_merged"), F.lit(DENSE)), F.col("precision"), F.lit(SPARSE))
    kept = F.struct("encoding", "buckets")
    merged = F.struct(F.lit(DENSE).alias("encoding"), F.col("_merged").alias("buckets"))
    stored = F.when(~touched, kept).when(F.col("encoding") == SPARSE, sparse).otherwise(merged)
    return (
        state.join(new, "hll_id", "full")
        .withColumn("precision", checked)
        .withColumn("_dense", F.when(F.col("encoding") == SPARSE, dense_of["buckets"]).otherwise(F.col("buckets")))
        .withColumn("_merged", F.when(touched, larger))
        .withColumn("_stored", stored)
        .select(
            "hll_id",
            "precision",
            "hash",
            F.col("_stored.encoding").alias("encoding"),
            F.col("_stored.buckets").alias("buckets"),
            "created_date",
            F.when(F.col("_merged") != F.col("_dense"), now).otherwise(F.col("last_updated_date")).alias("last_updated_date"),
        )
    )


def merge_into(state: DataFrame, target_id: int, source_id: int, now: Column | None = None) -> DataFrame:
    """Merge one stored sketch into another; the source stays as it is."""
    source = unpack_registers(state.where(F.col("hll_id") == source_id), _KEY)
    return upsert_sketch(state, source.withColumn("hll_id", F.lit(target_id)), now)


def hll_estimates(state: DataFrame) -> DataFrame:
    """``(hll_id, estimate)`` of every stored sketch, each by the range of its own hash."""
    return hll_estimate(unpack_registers(state, _KEY), _KEY).select("hll_id", "estimate")


def estimate_cardinality(state: DataFrame, ids: DataFrame) -> DataFrame:
    """Estimates for ``ids.hll_id``; an unknown id counts 0."""
    wanted = ids.select("hll_id").distinct()
    estimates = hll_estimates(state.join(wanted, "hll_id", "left_semi"))
    return ids.select("hll_id").join(estimates, "hll_id", "left").select(
        "hll_id", F.coalesce("estimate", F.lit(0)).alias("estimate")
    )


def register_estimates_view(state: DataFrame, name: str = "hll_estimates") -> str:
    """Make the estimates readable from SQL under ``name``."""
    hll_estimates(state).createOrReplaceTempView(name)
    return name
