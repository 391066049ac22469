"""Record sources: rows shaped from a range or from the index column of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.functions.columns import as_column, whole_div
from tallyloom.functions.hashing import hash32_md5

# Fixed values of the forecast source.
SUMMARIES = ["Freezing", "Bracing", "Chilly", "Cool", "Mild", "Warm", "Balmy", "Hot", "Sweltering", "Scorching"]
COLDEST, WARMEST = -20, 55


def raw_records(
    df: DataFrame,
    index: Column | str,
    content: Column | str,
    source: str,
    batch_size: int = 100,
    now: Column | None = None,
) -> DataFrame:
    """``id, raw_content, metadata, batch`` per row of a table, the content from a column of it, batches cut by the index."""
    index = as_column(index).cast("bigint")
    now = F.current_timestamp() if now is None else now
    batch = whole_div(index, batch_size)
    return df.select(
        index.cast("string").alias("id"),
        as_column(content).cast("string").alias("raw_content"),
        F.create_map(
            F.lit("timestamp"), now.cast("string"),
            F.lit("source"), F.lit(source),
            F.lit("batch"), batch.cast("string"),
        ).alias("metadata"),
        batch.alias("batch"),
    )


def flat_records(
    df: DataFrame, index: Column | str, data: Column | str, source: str, now: Column | None = None
) -> DataFrame:
    """``id, data, timestamp, source`` per row of a table."""
    now = F.current_timestamp() if now is None else now
    return df.select(
        as_column(index).alias("id"),
        as_column(data).cast("string").alias("data"),
        now.alias("timestamp"),
        F.lit(source).alias("source"),
    )


def with_error_fallback(
    records: DataFrame, fails_when: Column, error: str, now: Column | None = None
) -> DataFrame:
    """Replace failing raw records by ``Error_<id>`` rows; mark the others as no retry."""
    now = (F.current_timestamp() if now is None else now).cast("string")
    failed_metadata = F.create_map(
        F.lit("error"), F.lit(error), F.lit("timestamp"), now, F.lit("isError"), F.lit("true")
    )
    kept_metadata = F.map_concat(
        F.map_filter("metadata", lambda key, _: key.isin("timestamp", "source")),
        F.create_map(F.lit("isRetry"), F.lit("false")),
    )
    failed = F.coalesce(fails_when, F.lit(False))
    return records.withColumns(
        {
            "raw_content": F.when(failed, F.concat(F.lit("Error_"), F.col("id"))).otherwise(F.col("raw_content")),
            "metadata": F.when(failed, failed_metadata).otherwise(kept_metadata),
        }
    )


def seeded_int(index: Column | str, seed: int, low: int, high: int) -> Column:
    """A pseudo-random int in ``[low, high)`` that depends on index and seed only."""
    text = F.concat(F.lit(f"{seed}:"), as_column(index).cast("string"))
    return (F.pmod(hash32_md5(text, signed=False), F.lit(high - low)) + F.lit(low)).cast("int")


def random_ints(df: DataFrame, index: Column | str, seed: int = 42, low: int = 1, high: int = 100) -> DataFrame:
    """``index, value`` with one seeded int per row, the same under any partitioning."""
    return df.select(as_column(index).alias("index"), seeded_int(index, seed, low, high).alias("value"))


def random_int_source(
    spark: SparkSession, n: int = 10_000_000, seed: int = 42, low: int = 1, high: int = 100
) -> DataFrame:
    """``n`` seeded ints in ``[low, high)``."""
    return random_ints(spark.range(n), "id", seed, low, high)


def forecasts(df: DataFrame, day: Column | str, seed: int = 42) -> DataFrame:
    """``date, temperature_c, summary`` per day, drawn from a seeded hash of the day."""
    day = as_column(day)
    summary = F.element_at(F.array(*[F.lit(s) for s in SUMMARIES]), seeded_int(day, seed + 1, 1, len(SUMMARIES) + 1))
    return df.select(
        day.alias("date"), seeded_int(day, seed, COLDEST, WARMEST).alias("temperature_c"), summary.alias("summary")
    )


def forecast_source(spark: SparkSession, days: int = 5, seed: int = 42, today: Column | None = None) -> DataFrame:
    """Forecasts for the ``days`` days after today."""
    today = F.current_date() if today is None else today
    return forecasts(
        spark.range(1, days + 1).select(F.date_add(today, F.col("id").cast("int")).alias("day")), "day", seed
    )


def numbered_elements(spark: SparkSession, n: int, prefix: str = "user_", start: int = 0) -> DataFrame:
    """``index, element`` with elements ``<prefix><i>``; input of the sketch benchmarks."""
    return spark.range(start, start + n).select(
        F.col("id").alias("index"), F.concat(F.lit(prefix), F.col("id").cast("string")).alias("element")
    )
