"""Token files: Parquet lists of token identifiers in key order, whose row groups and pages can be read selectively."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import byte_blocks, tokenizer_path, whole_texts
from tallyloom.llm.encoders import library_encoder

ENCODINGS = ("delta", "dictionary")


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str | None = None,
    end_id: int | None = 2,
    encoding: str = "delta",
    row_group_bytes: int = 16 << 20,
    page_bytes: int = 256 << 10,
    page_rows: int = 512,
    key: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode every whole text and write ``key, part, place, n_tokens, ids`` in ascending key order.

    ``part`` is the range of keys that one task wrote and ``place`` the number of identifiers before the document in
    it, so a global position needs only the sums of the parts. Identifiers are delta-encoded or dictionary-encoded; a
    row group holds about ``row_group_bytes`` and a page at most ``page_rows`` rows, and the page index over the
    sorted key lets a reader of a few keys skip the other pages. Ranges are over the key and that hash, so the rows of a repeated or null key
    may lie in several parts.

    Null and empty texts hold the end identifier alone (nothing if ``end_id`` is None). Null keys come first, repeated
    keys stand in the order of a hash of their texts. An empty table gives files without rows. Other columns are not read.
    """
    if encoding not in ENCODINGS:
        raise ValueError(f"encoding must be one of {ENCODINGS}")
    vocabulary = vocabulary or tokenizer_path("word_bpe_49k.json")
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
    mixed = F.xxhash64(text)  # spreads a repeated key, and is all of the texts that the choice of ranges samples
    ordered = whole_texts(docs, key, text).repartitionByRange(key, mixed).sortWithinPartitions(key, mixed, text)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, place, part = library_encoder(vocabulary), 0, TaskContext.get().partitionId()
        for whole in batches:
            for start, stop in byte_blocks(whole.column(1)):
                ids = [value + end for value in encoder.encode(whole.column(1).slice(start, stop - start))]
                counts = np.fromiter((len(value) // 4 for value in ids), np.int64, len(ids))
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        whole.column(0).slice(start, stop - start),
                        pa.array(np.full(len(ids), part, np.int32)),
                        pa.array(place + ends - counts),
                        pa.array(counts),
                        pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), "<i4"))),
                    ],
                    names=[key, "part", "place", "n_tokens", "ids"],
                )
                place += int(ends[-1])

    kind = ordered.schema[key].dataType.simpleString()
    rows = ordered.mapInArrow(encode, f"`{key}` {kind}, part int, place long, n_tokens long, ids array<int>")
    rows.write.options(
        **{
            "compression": "zstd",
            "parquet.writer.version": "v2",
            "parquet.block.size": row_group_bytes,
            "parquet.page.size": page_bytes,
            "parquet.page.row.count.limit": page_rows,
            "parquet.enable.dictionary#ids.list.element": str(encoding == "dictionary").lower(),
        }
    ).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """All columns of the files with ``start``, the number of identifiers of all documents before; unused columns are not read.

    The sums of the parts are a row per writing task, computed from the counts alone.
    """
    rows = spark.read.parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    bases = parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "part").withColumn("start", F.col("base") + F.col("place")).drop("base")


def token_checksums(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows ``key, start, n_tokens, ids_crc32`` from read token files, the checksum over little-endian 32-bit integers."""
    slim = tokens.select(key, "start", "n_tokens", "ids")

    def checksum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            offsets = lists.offsets.to_numpy()
            flat = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)).cast("B")
            sums = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], names=[key, "start", "n_tokens", "ids_crc32"])

    kind = slim.schema[key].dataType.simpleString()
    return slim.mapInArrow(checksum, f"`{key}` {kind}, start long, n_tokens long, ids_crc32 long")
