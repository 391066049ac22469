"""File readers with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tallyloom.operators.batching import take_first

DOSAGE_SCHEMA = (
    "ndc11 string, drug_name string, strength string, dosage_form string,"
    " route string, quantity float, unit string, frequency string"
)
APPOINTMENT_SCHEMA = (
    "id string, patient_id string, date_time timestamp_ntz, procedure_type string, dentist_id string, status string"
)
ESTIMATE_REQUEST_SCHEMA = "request_id string, elements array<string>, precision int"
FORECAST_SCHEMA = "date date, temperature_c int, summary string"
USER_EVENTS_SCHEMA = "event_id bigint, user_id string, event_timestamp timestamp_ntz"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a Parquet folder, ``<folder>/<name>.parquet``."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def event_table_scan(spark: SparkSession, path: str) -> DataFrame:
    """User events from Parquet; later filters and projections reach the scan."""
    return spark.read.schema(USER_EVENTS_SCHEMA).parquet(path)


def read_json_requests(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON request bodies, one per line, as typed rows."""
    return spark.read.schema(schema).json(path)


def parse_json_requests(df: DataFrame, body: Column | str, schema: str) -> DataFrame:
    """JSON request bodies held in a column, as typed rows; bad bodies become nulls."""
    return df.select(F.from_json(body, schema).alias("_body")).select("_body.*")


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files holding one JSON array each, as rows; null items are skipped.

    An array cannot be split: a file is one row of one task, so by contract it is small (megabytes). Large inputs come as
    JSON lines, see :func:`read_json_requests`; any number of files is read in parallel.
    """
    fields = ", ".join(f"{field.name}: {field.dataType.simpleString()}" for field in StructType.fromDDL(schema))
    items = F.explode(F.from_json("value", f"array<struct<{fields}>>")).alias("_item")
    return spark.read.text(path, wholetext=True).select(items).where("_item is not null").select("_item.*")


def read_json_array_stream(
    spark: SparkSession, path: str, schema: str, max_items: int, order_by: list[str]
) -> DataFrame:
    """The first ``max_items`` non-null items of JSON arrays."""
    return take_first(read_json_array(spark, path, schema), max_items, order_by)


def read_dosage_file(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Dosage rows from delimited files, columns by position."""
    return spark.read.schema(DOSAGE_SCHEMA).csv(path, header=header)
