"""Row-level ETL: preprocess, validate, transform, route, log, count."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tallyloom.functions.columns import as_column, empty_strings
from tallyloom.functions.values import (
    DATETIME_KIND,
    INT_KIND,
    STRING_KIND,
    stable_id,
    transform_by_type,
    transform_failed,
)

NULL_ERROR = "Data cannot be null"
OVERFLOW_ERROR = "Transformation error: number out of range"
LOAD_ERROR = "Validation errors present"

Step = Callable[[DataFrame], DataFrame]


def preprocess(raw: DataFrame, now: Column | None = None) -> DataFrame:
    """``id, processed_data, processed_at``; missing content becomes empty text."""
    now = F.current_timestamp() if now is None else now
    return raw.select(
        "id",
        F.coalesce(F.col("raw_content").cast("string"), F.lit("")).alias("processed_data"),
        now.alias("processed_at"),
    )


def validate_not_null(df: DataFrame, payload: str = "value") -> DataFrame:
    """Add ``validation_errors``; rows with a null payload stay, with an error."""
    return df.withColumn(
        "validation_errors",
        F.when(F.col(payload).isNull(), F.array(F.lit(NULL_ERROR))).otherwise(empty_strings()),
    )


def transform_or_keep(
    df: DataFrame, payload: str = "value", zone: str = "UTC", now: Column | None = None
) -> DataFrame:
    """Transform by payload type; a row that fails keeps its payload and gains an error."""
    now = F.current_timestamp() if now is None else now
    tried = transform_by_type(df, payload, "_tried", zone)
    failed = transform_failed(payload, "_tried")
    return tried.select(
        "id",
        F.col(payload).alias("original_data"),
        F.when(failed, F.col(payload)).otherwise(F.col("_tried")).alias("transformed_data"),
        now.alias("processed_at"),
        empty_strings().alias("warnings"),
        F.when(failed, F.array_append("validation_errors", F.lit(OVERFLOW_ERROR)))
        .otherwise(F.col("validation_errors"))
        .alias("validation_errors"),
    )


def drop_failed(df: DataFrame, attempt: Column, output: str) -> DataFrame:
    """Keep the rows whose ``attempt`` (a ``try_`` expression) has a value, as ``output``."""
    return df.withColumn(output, attempt).where(F.col(output).isNotNull())


def is_loadable(results: DataFrame) -> DataFrame:
    """Rows without validation errors."""
    return results.where(F.size("validation_errors") == 0)


def default_store() -> str:
    """Store of payloads without one of their own."""
    return "default_store"


def store_of(payload: Column | str) -> Column:
    """Store name by payload type."""
    kind = as_column(payload)["kind"]
    return (
        F.when(kind == STRING_KIND, "string_store")
        .when(kind == INT_KIND, "number_store")
        .when(kind == DATETIME_KIND, "datetime_store")
        .otherwise(default_store())
    )


def load_result_log(
    results: DataFrame, object_id: Column | None = None, now: Column | None = None
) -> DataFrame:
    """One audit row per result: its store location, or the reason it was not loaded.

    ``object_id`` defaults to a hash of the result id, so a retried task logs
    the same location.
    """
    now = F.current_timestamp() if now is None else now
    object_id = stable_id("id") if object_id is None else object_id
    loaded = F.col("_loaded")
    return results.withColumn("_loaded", F.size("validation_errors") == 0).select(
        stable_id(F.lit("load"), F.col("id")).alias("id"),
        F.col("id").alias("transformation_id"),
        loaded.alias("success"),
        F.when(loaded, F.concat_ws("/", store_of("transformed_data"), object_id)).alias("storage_location"),
        F.when(~loaded, F.lit(LOAD_ERROR)).alias("error_message"),
        now.alias("loaded_at"),
    )


def load_lineage(results: DataFrame, loads: DataFrame) -> DataFrame:
    """Every transformation with its load, if there is one."""
    return results.select("id", "original_data", "transformed_data", "validation_errors").join(
        loads.select(
            F.col("transformation_id").alias("id"),
            F.col("id").alias("load_id"),
            "success",
            "storage_location",
            "error_message",
        ),
        "id",
        "left",
    )


def observe_stats(results: DataFrame, observation: Observation) -> DataFrame:
    """Count rows by outcome while another action runs over them."""
    invalid = F.size("validation_errors") > 0
    return results.observe(
        observation,
        F.count(F.lit(1)).alias("extracted_count"),
        F.count_if(F.col("transformed_data").isNotNull() & ~invalid).alias("transformed_count"),
        F.count_if(~invalid).alias("loaded_count"),
        F.count_if(invalid).alias("error_count"),
    )


@dataclass
class EtlJob:
    """A job of pluggable steps: source, preprocessing, transformation, load."""

    source: Callable[[], DataFrame]
    load: Callable[[DataFrame], object]
    steps: Sequence[Step] = field(default_factory=lambda: [validate_not_null, transform_or_keep])

    def results(self) -> DataFrame:
        """The lazy result rows."""
        rows = self.source()
        for step in self.steps:
            rows = rows.transform(step)
        return rows


STATS_SCHEMA = (
    "extracted_count bigint, transformed_count bigint, loaded_count bigint, error_count bigint,"
    " start_time timestamp, status string"
)


def run_with_stats(job: EtlJob, cancelled: Callable[[], bool] = lambda: False) -> DataFrame:
    """Run the job once; one row of counts taken during the load, start and status.

    The status is ``Completed``, ``Failed`` if source, step or load raised an error, or ``Cancelled`` if ``cancelled`` says so before
    the load or after it broke off (as ``SparkContext.cancelJobGroup`` makes it do). Without a finished load there are no counts.
    Failed rows keep their payload and count as errors, not as transformed.
    """
    started = datetime.now(timezone.utc)
    observation = Observation("etl")
    names = ["extracted_count", "transformed_count", "loaded_count", "error_count"]
    counts: dict[str, int | None] = dict.fromkeys(names)
    status = "Cancelled"
    if not cancelled():
        try:
            job.load(observe_stats(job.results(), observation))
            counts, status = observation.get, "Completed"
        except Exception:
            status = "Cancelled" if cancelled() else "Failed"
    row = (*[counts[name] for name in names], started, status)
    return SparkSession.active().createDataFrame([row], STATS_SCHEMA)
