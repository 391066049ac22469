"""Sums, positions, batches and slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.functions.columns import as_column, whole_div
from tallyloom.session import materialize

_ROW_BITS = 33


def parallel_sum(df: DataFrame, value: Column | str) -> DataFrame:
    """Sum as bigint; partial sums per task, one row per task shuffled."""
    return df.agg(F.coalesce(F.sum(as_column(value).cast("bigint")), F.lit(0)).alias("total"))


def with_index(df: DataFrame, order_by: Sequence[str], index: str = "index") -> DataFrame:
    """Add the 0-based position in the order of ``order_by``.

    ``order_by`` must identify a row. The rows are sorted by range, so no task
    holds more than its range, and written once to the shared scratch folder:
    ranges are drawn from a sample and may differ between runs of a plan. Only
    one count per range is summed up in one place.
    """
    numbered = materialize(
        df.orderBy(*order_by).withColumn("_place", F.monotonically_increasing_id()), "index"
    )
    task = F.shiftright("_place", _ROW_BITS)
    in_task = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    before = Window.partitionBy(F.lit(0)).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy(task.alias("_task"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        numbered.withColumn("_task", task)
        .join(F.broadcast(offsets), "_task")  # one row per sort task
        .select(*df.columns, (F.col("_offset") + in_task).alias(index))
    )


def chunked_sum(indexed: DataFrame, value: Column | str, index: str, chunks: int) -> DataFrame:
    """``chunk, items, chunk_sum`` over ``chunks`` contiguous chunks of equal length.

    Rows left over by the division form one more chunk, so that the chunk sums
    add up to the whole.
    """
    size = max(indexed.count() // chunks, 1)
    return (
        indexed.groupBy(whole_div(index, size).alias("chunk"))
        .agg(F.count(F.lit(1)).alias("items"), F.sum(as_column(value).cast("bigint")).alias("chunk_sum"))
    )


def modulo_batch(index: Column | str, batches: int) -> Column:
    """Batch of a row by its position, round robin."""
    return F.pmod(as_column(index), F.lit(batches)).cast("bigint")


def modulo_batches(
    indexed: DataFrame, item: Column | str, index: str, batches: int, part_size: int = 10_000
) -> DataFrame:
    """``batch, part, items``: the ordered items of every round-robin batch.

    A batch grows with the table, so its list comes in numbered parts of at
    most ``part_size`` items; the parts follow each other without gaps.
    """
    position = whole_div(index, batches)
    return (
        indexed.groupBy(
            modulo_batch(index, batches).alias("batch"),
            whole_div(position, part_size).alias("part"),
        )
        .agg(_ordered_items(index, item).alias("items"))
    )


def fixed_size_batches(indexed: DataFrame, item: Column | str, index: str, size: int = 10) -> DataFrame:
    """``batch, batch_size, items``: consecutive batches; the last may be short."""
    return (
        indexed.groupBy(whole_div(index, size).alias("batch"))
        .agg(_ordered_items(index, item).alias("items"))
        .select("batch", F.size("items").alias("batch_size"), "items")
    )


def _ordered_items(index: str, item: Column | str) -> Column:
    pairs = F.array_sort(F.collect_list(F.struct(F.col(index).alias("k"), as_column(item).alias("v"))))
    return F.transform(pairs, lambda pair: pair["v"])


def take_first(df: DataFrame, max_items: int = 10, order_by: Sequence[str] = ()) -> DataFrame:
    """At most ``max_items`` rows; the first ones when an order is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(max_items)


def slice_rows(df: DataFrame, order_by: Sequence[str], skip: int, take: int, most_held: int = 100_000) -> DataFrame:
    """Rows ``skip .. skip+take-1`` in the order of ``order_by``, which must identify a row.

    A slice that ends within ``most_held`` rows is a bounded top-k: every task keeps that many at most, and nothing else is sorted or
    written. A later one is found by position, with the same rows.
    """
    if skip + take <= most_held:
        return df.orderBy(*order_by).offset(skip).limit(take)
    indexed = with_index(df, order_by, "_index")
    return indexed.where((F.col("_index") >= skip) & (F.col("_index") < skip + take)).drop("_index")


def flatten(df: DataFrame, items: str, output: str = "item") -> DataFrame:
    """One row per element of the array column ``items``."""
    others = [name for name in df.columns if name != items]
    return df.select(*others, F.explode(items).alias(output))


def merge_streams(*streams: DataFrame) -> DataFrame:
    """All rows of several frames or streams with the same columns, in no order."""
    merged = streams[0]
    for stream in streams[1:]:
        merged = merged.unionByName(stream)
    return merged
