"""Large JSON arrays read by byte ranges.

A range can't know by itself whether it begins inside a string or how deep it lies. So every range is first summed up for both cases, a
running sum over the sums of a file gives each range its true beginning, and then each range cuts out the items that open in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

BLOCK_BYTES = 4 << 20  #: bytes of a range that are held at a time
QUOTE, BACKSLASH, COMMA = b'"\\,'
OPENING, CLOSING = b"[{", b"]}"


@dataclass
class Scanner:
    """Place of a reader in JSON text: inside a string or not, after an odd run of backslashes or not, and how deep."""

    inside: bool
    depth: int
    escaped: bool = False

    def _unescaped_quotes(self, codes: np.ndarray) -> np.ndarray:
        slashes = codes == BACKSLASH
        if not self.escaped and not slashes.any():
            return codes == QUOTE
        place = np.arange(len(codes), dtype=np.int32)
        # The last byte before each that is no backslash; an odd run that ran up to the block counts as one more backslash before it.
        other = np.maximum.accumulate(np.where(slashes, np.int32(-2 if self.escaped else -1), place))
        before = np.concatenate([[np.int32(-2 if self.escaped else -1)], other[:-1]])
        escaped = (place - 1 - before) % 2 == 1
        self.escaped = bool(slashes[-1] and not escaped[-1])
        return (codes == QUOTE) & ~escaped

    def _steps(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
        """Where the structure is, the change of depth there, and whether the block leaves the reader inside a string."""
        quotes = self._unescaped_quotes(codes)
        inside = np.logical_xor.accumulate(quotes) ^ self.inside
        step = np.isin(codes, list(OPENING)).astype(np.int8) - np.isin(codes, list(CLOSING)).astype(np.int8)
        return inside, step, bool(inside[-1])

    def sums(self, codes: np.ndarray) -> tuple[int, int]:
        """Changes of depth outside and inside of what are strings by this reader's reckoning; the reader goes on behind the block."""
        inside, step, self.inside = self._steps(codes)
        return int(step[~inside].sum(dtype=np.int64)), int(step[inside].sum(dtype=np.int64))

    def bounds(self, codes: np.ndarray) -> np.ndarray:
        """Places of the outer array's brackets and of the commas between its items; the reader goes on behind the block."""
        inside, step, self.inside = self._steps(codes)
        step[inside] = 0
        depth = np.cumsum(step, dtype=np.int32) + np.int32(self.depth)
        outer = ((codes == COMMA) & (depth == 1) & ~inside) | ((step == 1) & (depth == 1)) | ((step == -1) & (depth == 0))
        self.depth = int(depth[-1])
        return np.flatnonzero(outer)


def _open(path: str):
    # A path of Spark's may have one slash behind the scheme of local files.
    uri = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path
    system, inner = fs.FileSystem.from_uri(uri)
    return system.open_input_file(inner)


def _blocks(file, start: int, stop: int) -> Iterator[np.ndarray]:
    while start < stop:
        data = file.read_at(min(BLOCK_BYTES, stop - start), start)
        if not data:
            return
        start += len(data)
        yield np.frombuffer(data, np.uint8)


def _odd_backslashes_before(file, start: int) -> bool:
    """Whether an odd run of backslashes ends right before ``start``; they stand in strings only."""
    run = 0
    while start > 0:
        size = min(4096, start)
        data = file.read_at(size, start - size)
        ending = size - len(data.rstrip(b"\\"))
        run += ending
        if ending < size:
            break
        start -= size
    return run % 2 == 1


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start, stop in zip(*[column.to_pylist() for column in batch.columns]):
            with _open(path) as file:
                scanner = Scanner(inside=False, depth=0, escaped=_odd_backslashes_before(file, start))
                outside, inside = np.sum([(0, 0), *(scanner.sums(codes) for codes in _blocks(file, start, stop))], axis=0).tolist()
            columns = [[path], [start], [stop], [scanner.inside], [outside], [inside]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["path", "start", "stop", "odd", "outside", "inside"])


def _cut(path: str, start: int, stop: int, size: int, starts_inside: bool, depth: int) -> Iterator[bytes]:
    """The items whose opening bracket or comma stands in the range; the last is read to its end beyond it."""
    with _open(path) as file:
        scanner = Scanner(starts_inside, depth, _odd_backslashes_before(file, start))
        held: list[bytes] | None = None  # what was read of the item that is open
        at = start
        for codes in _blocks(file, start, size):
            if at >= stop and held is None:
                return
            data, last = codes.tobytes(), 0
            for bound in scanner.bounds(codes).tolist():
                if held is not None:
                    yield b"".join([*held, data[last:bound]]).strip()
                # The bracket that closes the array opens nothing.
                opens = at + bound < stop and data[bound] != CLOSING[0]
                held, last = ([] if opens else None), bound + 1
                if at + bound >= stop:
                    return
            if held is not None:
                held.append(data[last:])
            at += len(data)


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in zip(*[column.to_pylist() for column in batch.columns]):
            items: list[bytes] = []
            size = 0
            for item in _cut(*row):
                items.append(item)
                size += len(item)
                if size >= BLOCK_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(items, pa.binary()).cast(pa.string())], names=["value"])
                    items, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.binary()).cast(pa.string())], names=["value"])


def read_json_array_ranges(spark: SparkSession, path: str, schema: str, range_bytes: int = 64 << 20) -> DataFrame:
    """Items of JSON arrays of any length, one array a file, as rows; tasks share a file by ranges of ``range_bytes``.

    Brackets, commas and quotes inside strings, escapes and nested arrays are respected wherever a range begins. Null items and empty
    files and arrays give no rows; an item that doesn't fit the schema gives nulls. A file is read twice, a block at a time; between the readings only a row
    for each range is shuffled. An item must fit into a task. Tasks open files by their address, as Arrow's file systems do.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint")))
    stop = F.least(F.col("start") + range_bytes, F.col("length"))
    tasks = 4 * spark.sparkContext.defaultParallelism  # rows of ranges are too small for sizes to deal them out
    ranges = files.select("path", "length", starts.alias("start")).select("path", "start", stop.alias("stop")).repartition(tasks)
    sums = ranges.mapInArrow(_sum_up, "path string, start bigint, stop bigint, odd boolean, outside bigint, inside bigint")
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    begins_inside = F.coalesce(F.sum(F.col("odd").cast("int")).over(earlier), F.lit(0)) % 2 == 1
    change = F.when(F.col("begins_inside"), F.col("inside")).otherwise(F.col("outside"))
    placed = (
        sums.withColumn("begins_inside", begins_inside)
        .withColumn("depth", F.coalesce(F.sum(change).over(earlier), F.lit(0)))
        .withColumn("size", F.max("stop").over(whole))
        .select("path", "start", "stop", "size", "begins_inside", "depth")
    )
    items = placed.repartition(tasks).mapInArrow(_items, "value string").where("value not in ('', 'null')")
    return items.select(F.from_json("value", schema).alias("_item")).where("_item is not null").select("_item.*")
