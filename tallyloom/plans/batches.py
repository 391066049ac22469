"""Sums, positions, batches and slices of orders and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions.values import processed_label
from tallyloom.operators import batching
from tallyloom.plans.registry import query
from tallyloom.sources.files import read_table
from tallyloom.sources.records import random_ints


@query("select sum(l_partkey)::bigint as total from lineitem")
def sum_of_part_keys(spark: SparkSession, folder: str) -> DataFrame:
    return batching.parallel_sum(read_table(spark, folder, "lineitem"), "l_partkey")


RANDOM_SQL = """
  select o_orderkey as index, (('0x' || substr(md5(unhex(regexp_replace(hex('42:' || o_orderkey), '(..)', '\\100', 'g'))),
         1, 8))::bigint % 99 + 1)::integer as value from orders
"""


@query(RANDOM_SQL)
def random_ints_per_order(spark: SparkSession, folder: str) -> DataFrame:
    return random_ints(read_table(spark, folder, "orders"), "o_orderkey")


@query(f"select sum(value)::bigint as total from ({RANDOM_SQL})")
def sum_of_random_ints(spark: SparkSession, folder: str) -> DataFrame:
    return batching.parallel_sum(random_ints(read_table(spark, folder, "orders"), "o_orderkey"), "value")


POSITIONS_SQL = """
  select o_orderkey, o_custkey, row_number() over (order by o_orderdate, o_orderkey) - 1 as index from orders
"""


def _indexed(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return batching.with_index(orders, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(POSITIONS_SQL)
def orders_with_index(spark: SparkSession, folder: str) -> DataFrame:
    return _indexed(spark, folder)


@query("""
select o_orderkey // (select count(*) // 7 from orders) as chunk, count(*) as items, sum(o_custkey)::bigint as chunk_sum
from orders group by 1
""")
def chunked_sum_of_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Seven chunks by the dense order key, and the rest."""
    return batching.chunked_sum(read_table(spark, folder, "orders"), "o_custkey", "o_orderkey", 7)


@query(f"""
select index % 8 as batch, index // 8 // 500 as part, string_agg(o_orderkey, ',' order by index) as items
from ({POSITIONS_SQL}) group by 1, 2
""")
def round_robin_batches(spark: SparkSession, folder: str) -> DataFrame:
    batches = batching.modulo_batches(_indexed(spark, folder), "o_orderkey", "index", 8, part_size=500)
    return batches.select("batch", "part", F.array_join(F.transform("items", lambda i: i.cast("string")), ",").alias("items"))


@query(f"""
select index // 10 as batch, count(*)::integer as batch_size, string_agg(o_orderkey, ',' order by index) as items
from ({POSITIONS_SQL}) group by 1
""")
def batches_of_ten(spark: SparkSession, folder: str) -> DataFrame:
    batches = batching.fixed_size_batches(_indexed(spark, folder), "o_orderkey", "index", 10)
    return batches.withColumn("items", F.array_join(F.transform("items", lambda i: i.cast("string")), ","))


@query(f"select index // 10 as batch, o_orderkey as item, 'Processed ' || o_orderkey as label from ({POSITIONS_SQL})")
def processed_batch_items(spark: SparkSession, folder: str) -> DataFrame:
    """Batches opened up again, every item labelled."""
    batches = batching.fixed_size_batches(_indexed(spark, folder), "o_orderkey", "index", 10)
    return batching.flatten(batches.select("batch", "items"), "items").withColumn("label", processed_label("item"))


@query("select o_orderkey, o_orderdate from orders order by o_orderdate, o_orderkey limit 10")
def first_ten_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return batching.take_first(orders, 10, ["o_orderdate", "o_orderkey"])


@query("select o_orderkey, o_orderdate from orders order by o_orderdate, o_orderkey limit 250 offset 1000")
def slice_of_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return batching.slice_rows(orders, ["o_orderdate", "o_orderkey"], 1000, 250)


@query("""
select 'order' as origin, o_orderkey as key, o_orderdate as at from orders
union all select 'line', l_orderkey, l_shipdate from lineitem
""")
def orders_and_lines_merged(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select(
        F.lit("order").alias("origin"), F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("at")
    )
    lines = read_table(spark, folder, "lineitem").select(
        F.lit("line").alias("origin"), F.col("l_orderkey").alias("key"), F.col("l_shipdate").alias("at")
    )
    return batching.merge_streams(orders, lines)
