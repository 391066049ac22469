"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.operators.etl import default_store, is_loadable, store_of

STORE_COLUMN = "store"


def load_batch(df: DataFrame, target: str) -> str:
    """Append every row to ``default_store`` below ``target``."""
    path = f"{target.rstrip('/')}/{default_store()}"
    df.write.mode("append").parquet(path)
    return path


def route_by_type_sink(results: DataFrame, target: str, mode: str = "append", payload: str = "transformed_data") -> str:
    """Write loadable rows partitioned by the store of their payload type."""
    routed = is_loadable(results).withColumn(STORE_COLUMN, store_of(F.col(payload)))
    routed.write.mode(mode).partitionBy(STORE_COLUMN).parquet(target)
    return target


def append_log(log: DataFrame, target: str) -> str:
    """Append audit rows."""
    log.write.mode("append").parquet(target)
    return target


def noop_sink(df: DataFrame) -> None:
    """Run the whole plan and drop the rows."""
    df.write.format("noop").mode("overwrite").save()
