"""Exact top-k inner products by a three-phase uniform threshold over lists of partial scores.

Vectors are cut into ``lists`` parts of neighbouring components; a list holds the partial scores of one part. If a
total reaches a cutoff, some part reaches the cutoff divided by the number of lists. Phase one gathers the best
entries of every list and scores them exactly, which gives a cutoff per query that the k-th best total can't be below. Phase two sends the
cutoffs to all lists, which return the entries that reach their share. Phase three fetches the parts that are still missing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import is_finite_vector, renewed
from tallyloom.session import materialize

_ENTRY = pa.schema([("query", pa.int64()), ("list", pa.int32()), ("item", pa.int64()), ("score", pa.int64())])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Equally long lists of integers as rows."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False).reshape(len(array), -1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: in doubles where these are exact, else in 64-bit integers."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _entries(table: pa.Table, queries: np.ndarray, items: np.ndarray, scores: np.ndarray) -> pa.Table:
    number = table.column("list")[0].as_py()
    return pa.table([pa.array(queries), pa.array(np.full(len(queries), number, np.int32)), pa.array(items), pa.array(scores)], schema=_ENTRY)


def _best(k: int):
    def best(queries: pa.Table, items: pa.Table) -> pa.Table:
        """The k best entries of one list in one block of items, for one block of queries."""
        if not queries.num_rows or not items.num_rows:
            return _ENTRY.empty_table()
        scores = _products(_matrix(queries["part"]), _matrix(items["part"]))
        n = min(k, scores.shape[1])
        at = np.argpartition(-scores, n - 1, axis=1)[:, :n]
        names = items["id"].to_numpy()
        return _entries(queries, np.repeat(queries["id"].to_numpy(), n), names[at].ravel(), np.take_along_axis(scores, at, 1).ravel())

    return best


def _reaching(lists: int):
    def reaching(queries: pa.Table, items: pa.Table) -> pa.Table:
        """The entries of one list in one block that reach the query's cutoff divided by the number of lists."""
        if not queries.num_rows or not items.num_rows:
            return _ENTRY.empty_table()
        cutoffs = queries["cutoff"].to_numpy(zero_copy_only=False)
        share = np.ceil(cutoffs / lists)
        found = [[], [], []]
        names, ids = items["id"].to_numpy(), queries["id"].to_numpy()
        parts, all_items = _matrix(queries["part"]), _matrix(items["part"])
        for start in range(0, len(ids), 256):
            scores = _products(parts[start : start + 256], all_items)
            q, i = np.nonzero(scores >= share[start : start + 256, None])
            for column, values in zip(found, (ids[start + q], names[i], scores[q, i])):
                column.append(values)
        return _entries(queries, *map(np.concatenate, found))

    return reaching


def _missing(vectors: pa.Table, wanted: pa.Table) -> pa.Table:
    """The partial scores of asked pairs in one list."""
    if not wanted.num_rows:
        return _ENTRY.empty_table()
    ids = vectors["id"].to_numpy()
    is_query = vectors["is_query"].to_numpy(zero_copy_only=False).astype(bool)
    parts = _matrix(vectors["part"])
    place = [dict(zip(ids[side].tolist(), np.flatnonzero(side).tolist())) for side in (is_query, ~is_query)]
    queries, items = wanted["query"].to_numpy(), wanted["item"].to_numpy()
    scores = np.empty(len(queries), np.int64)
    for start in range(0, len(queries), 50_000):
        q = [place[0][name] for name in queries[start : start + 50_000].tolist()]
        i = [place[1][name] for name in items[start : start + 50_000].tolist()]
        scores[start : start + 50_000] = np.einsum("ij,ij->i", parts[q].astype(np.int64), parts[i].astype(np.int64))
    return _entries(wanted, queries, items, scores)


def _in_parts(rows: DataFrame, lists: int) -> DataFrame:
    """A row per list with the components of its part; the last parts of short vectors may be empty."""
    size = F.ceil(F.size("vector") / lists).cast("int")
    number = F.explode(F.sequence(F.lit(0), F.lit(lists - 1))).alias("list")
    parts = rows.select("*", number)
    return parts.withColumn("part", F.slice("vector", F.col("list") * size + 1, F.greatest(size, F.lit(1)))).drop("vector")


def _block(column: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")


def exact_top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, lists: int = 2, item_block: int = 8192, query_block: int = 1024, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Rows ``query_id, rank, key, score``: for the rows of ``is_query`` the ``k`` best others by integer inner product, ties to the smaller key.

    Components x become ``floor(scale * x)``. Equal integer vectors are scored once and stand for their ``k + 1`` smallest keys, which is all that a
    result can hold. Queries meet all items in blocks of bounded size; no block is left out, and a cutoff only drops what can't be in a result.

    Rows whose key or vector is null, and vectors that are empty or hold null or non-finite components, take no part; of several rows
    with one key the smallest vector counts. Vectors are compared with those of equal length only; partial sums must fit 64 bits. An empty table
    gives no rows; other columns are not read.
    """
    at_scale = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    slim = vectors.where(F.col(key).isNotNull() & is_finite_vector(F.col(vector))).select(
        F.col(key).cast("long").alias("row"), at_scale.alias("vector"), is_query.alias("asks")
    )
    rows = slim.groupBy("row").agg(F.min(F.struct("vector", "asks")).alias("r")).select("row", "r.vector", "r.asks")
    rows = materialize(rows, "top-rows")
    items = materialize(rows.groupBy("vector").agg(F.min("row").alias("id"), F.count(F.lit(1)).alias("copies"), F.max("asks").alias("asks")), "top-items")
    found = items.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    item_blocks, query_blocks = (max(1, math.ceil(n / size)) for n, size in zip(found, (item_block, query_block)))
    length = F.size("vector").alias("length")
    keys = ["length", "list", "item_block", "query_block"]

    def spread(side: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        """One row per list, repeated for every block of the other side."""
        side = side.withColumn(own, _block("id", blocks)).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
        return _in_parts(side, lists)

    def sides(queries: DataFrame):
        asked = spread(queries, "query_block", query_blocks, "item_block", item_blocks)
        held = spread(items.select("id", "vector", length), "item_block", item_blocks, "query_block", query_blocks)
        return asked, renewed(held)

    queries = items.where("asks").select("id", "vector", length)
    asked, held = sides(queries)
    entry = "query long, list int, item long, score long"
    lists_of = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(_best(k + 1), entry)
    by_score = Window.partitionBy("query", "list").orderBy(F.desc("score"), "item")
    best = lists_of.withColumn("n", F.row_number().over(by_score)).where(F.col("n") <= k + 1).select("query", "item").distinct()
    of_query = queries.select(F.col("id").alias("query"), F.col("vector").alias("query_vector"))
    of_item = items.select(F.col("id").alias("item"), F.col("vector").alias("item_vector"))
    product = F.aggregate(F.zip_with("query_vector", "item_vector", lambda a, b: a * b), F.lit(0).cast("long"), lambda total, x: total + x)
    exact = best.join(of_query, "query").join(of_item, "item").select("query", product.alias("score"))
    by_total = Window.partitionBy("query").orderBy(F.desc("score"))
    cutoffs = exact.withColumn("n", F.row_number().over(by_total)).where(F.col("n") == k + 1).select(F.col("query").alias("id"), F.col("score").alias("cutoff"))

    # Fewer than k + 1 distinct vectors of a length leave a query without a cutoff: then every entry is wanted.
    lowest = F.lit(float("-inf"))
    asked, held = sides(queries.join(cutoffs, "id", "left").withColumn("cutoff", F.coalesce(F.col("cutoff").cast("double"), lowest)))
    reached = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(_reaching(lists), entry)
    sums = reached.groupBy("query", "item").agg(F.sum("score").alias("score"), F.collect_set("list").alias("seen"))
    sums = materialize(sums, "top-reached")

    blocks = items.select("id", length)
    wanted = sums.where(F.size("seen") < lists).select("query", "item", F.explode(F.array_except(F.sequence(F.lit(0), F.lit(lists - 1)), F.col("seen"))).alias("list"))
    wanted = wanted.join(blocks.withColumnRenamed("id", "item"), "item")
    wanted = wanted.withColumns({"item_block": _block("item", item_blocks), "query_block": _block("query", query_blocks)})
    asked, held = sides(queries)
    both = asked.withColumn("is_query", F.lit(True)).unionByName(held.withColumn("is_query", F.lit(False)))
    rest = both.groupBy(*keys).cogroup(renewed(wanted).groupBy(*keys)).applyInArrow(_missing, entry)
    totals = sums.select("query", "item", "score").unionByName(rest.select("query", "item", "score")).groupBy("query", "item").agg(F.sum("score").alias("score"))

    # Of the k + 1 best distinct vectors, the smaller id first, each stands for a row at least, and one of these may be the query's own.
    by_rank = Window.partitionBy("query").orderBy(F.desc("score"), "item")
    totals = totals.withColumn("n", F.row_number().over(by_rank)).where(F.col("n") <= k + 1).drop("n")
    within = Window.partitionBy("vector").orderBy("row")
    members = rows.select("row", "vector").withColumn("n", F.row_number().over(within)).where(F.col("n") <= k + 1).drop("n")
    members = members.join(items.select("vector", F.col("id").alias("item")), "vector").select("item", F.col("row").alias(key))
    asking = rows.where("asks").join(items.select("vector", F.col("id").alias("query")), "vector").select("query", F.col("row").alias("query_id"))
    results = totals.join(members, "item").join(asking, "query").where(F.col(key) != F.col("query_id"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
    return results.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", "rank", key, "score")
