"""Sums, positions and batches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.values import processed_label
from tallyloom.operators import batching
from tallyloom.sources.records import random_ints


def items(spark, n=100):
    return spark.range(1, n + 1).select(F.col("id").alias("item"))


def test_all_sums_agree(spark):
    ints = random_ints(spark.range(100_003), "id")
    total = batching.parallel_sum(ints, "value").first()["total"]
    assert total == sum(r["value"] for r in ints.collect())
    chunks = batching.chunked_sum(ints, "value", "index", 8).collect()
    assert sum(r["chunk_sum"] for r in chunks) == total
    assert sorted(r["items"] for r in chunks) == [3] + [12_500] * 8


def test_sum_is_wide_and_empty_is_zero(spark):
    big = spark.range(10).select(F.lit(2_000_000_000).alias("v"))
    assert batching.parallel_sum(big, "v").first()["total"] == 20_000_000_000
    assert batching.parallel_sum(big.where("v < 0"), "v").first()["total"] == 0


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_positions(spark, partitions):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("x").alias("v")).repartition(partitions)
    indexed = batching.with_index(rows, ["k"])
    assert indexed.where("index <> k").isEmpty() and indexed.count() == 5000


def test_positions_with_a_hot_first_key(spark):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 > 0, F.lit(5)).otherwise(F.col("id")).alias("k"), "id")
    indexed = batching.with_index(rows, ["k", "id"]).collect()
    assert [r["index"] for r in sorted(indexed, key=lambda r: (r["k"], r["id"]))] == list(range(9000))


def test_round_robin_batches(spark):
    indexed = batching.with_index(items(spark), ["item"])
    whole = {r["batch"]: r["items"] for r in batching.modulo_batches(indexed, "item", "index", 8).collect()}
    assert whole[0] == list(range(1, 101, 8)) and whole[7] == list(range(8, 101, 8))
    parts = batching.modulo_batches(indexed, "item", "index", 8, part_size=4).orderBy("batch", "part").collect()
    joined = {}
    for row in parts:
        assert len(row["items"]) <= 4
        joined.setdefault(row["batch"], []).extend(row["items"])
    assert joined == whole


def test_fixed_batches_and_flatten(spark):
    indexed = batching.with_index(items(spark, 95), ["item"])
    batches = batching.fixed_size_batches(indexed, "item", "index", 10)
    rows = batches.orderBy("batch").collect()
    assert [r["batch_size"] for r in rows] == [10] * 9 + [5] and rows[-1]["items"] == [91, 92, 93, 94, 95]
    assert batching.flatten(batches, "items").count() == 95
    assert items(spark, 1).select(processed_label("item").alias("l")).first()["l"] == "Processed 1"


def test_slices_and_limits(spark):
    rows = items(spark, 1000).repartition(5)
    assert sorted(r["item"] for r in batching.slice_rows(rows, ["item"], 100, 7).collect()) == list(range(101, 108))
    assert batching.slice_rows(rows, ["item"], 995, 50).count() == 5
    assert [r["item"] for r in batching.take_first(rows, 3, ["item"]).collect()] == [1, 2, 3]
    assert batching.take_first(rows, 2000).count() == 1000


def test_merge(spark):
    assert batching.merge_streams(items(spark), items(spark, 5), items(spark, 1)).count() == 106
