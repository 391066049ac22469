"""Streaming forms of the batch operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallyloom.functions.cardinality import DEFAULT_PRECISION
from tallyloom.operators.batching import fixed_size_batches, with_index
from tallyloom.operators.etl import Step, is_loadable, load_result_log, store_of, transform_or_keep, validate_not_null
from tallyloom.operators.sketch import DEFAULT_HASH, REGISTER, hll_build
from tallyloom.sources.sinks import STORE_COLUMN
from tallyloom.streaming.jobs import batch_folder, finished_batches, folder_writer, path_exists, read_batches, write_batches

REGISTERS_SCHEMA = "precision int, hash string, bucket int, rank int"


def streaming_etl(
    records: DataFrame,
    target: str,
    log_target: str,
    checkpoint: str,
    steps: Sequence[Step] = (validate_not_null, transform_or_keep),
) -> StreamingQuery:
    """Extract, transform and load a stream of ``id, value`` records.

    The steps run in the stream. Each micro-batch writes its loadable rows by
    store and its audit rows, both to folders of that batch.
    """
    results = records
    for step in steps:
        results = results.transform(step)

    def load(batch: DataFrame, batch_id: int) -> None:
        cached = batch.persist()
        try:
            routed = is_loadable(cached).withColumn(STORE_COLUMN, store_of("transformed_data"))
            routed.write.mode("overwrite").partitionBy(STORE_COLUMN).parquet(batch_folder(target, batch_id))
            load_result_log(cached).write.mode("overwrite").parquet(batch_folder(log_target, batch_id))
        finally:
            cached.unpersist()

    return write_batches(results, load, checkpoint)


def incremental_hll(
    elements: DataFrame,
    element: Column | str,
    target: str,
    checkpoint: str,
    precision: int = DEFAULT_PRECISION,
    by: Sequence[str] = (),
    hash_name: str = DEFAULT_HASH,
) -> StreamingQuery:
    """Add a stream of elements to a persisted sketch.

    Each micro-batch writes its own registers. Registers only grow and merge by
    maximum, so no state store is needed and a replayed batch changes nothing. :func:`compact_registers` keeps the number of
    folders that a reader must open small.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        folder_writer(target)(hll_build(batch, element, precision, by, hash_name), batch_id)

    return write_batches(elements, add, checkpoint)


def _registers_schema(by_schema: str) -> StructType:
    return StructType.fromDDL(f"{by_schema}, {REGISTERS_SCHEMA}" if by_schema else REGISTERS_SCHEMA)


def stored_registers(spark: SparkSession, target: str, by_schema: str = "") -> DataFrame:
    """The sketch that :func:`incremental_hll` has written: the newest snapshot merged with the micro-batches after it."""
    schema = _registers_schema(by_schema)
    through = snapshot_through(spark, target)
    rows = read_batches(spark, target, schema)
    if through is not None:
        newer = rows.where(F.col("batch_id") > through).drop("batch_id")
        rows = newer.unionByName(spark.read.schema(schema).parquet(_snapshot(target, through)))
    by = [name for name in schema.fieldNames() if name not in REGISTER]
    merged = rows.groupBy(*by, "precision", "hash", "bucket").agg(F.max("rank").alias("rank"))
    return merged.select(*by, *REGISTER)


def _snapshot(target: str, through: int) -> str:
    return f"{target.rstrip('/')}_snapshots/through={through}"


def _manifest(target: str) -> str:
    return f"{target.rstrip('/')}_manifest"


def snapshot_through(spark: SparkSession, target: str) -> int | None:
    """The last micro-batch that the newest snapshot holds; None without one."""
    if not path_exists(spark, _manifest(target)):
        return None
    return spark.read.schema("through bigint").parquet(_manifest(target)).agg(F.max("through")).first()[0]


def compact_registers(spark: SparkSession, target: str, by_schema: str = "") -> int | None:
    """Merge the newest snapshot and all finished micro-batches after it into a new one; returns the last micro-batch it holds.

    The snapshot is written beside the micro-batches and counts from the moment its one row stands in the manifest, which is written last. If the
    work ends before that, readers go on with what they had, and the next call writes the same folder again. A micro-batch that is replayed
    after it went into a snapshot changes nothing, as registers merge by their maximum. The stream may run meanwhile: a micro-batch counts as
    finished when its writer has said so. Folders up to the returned number are not read any more and may be removed.
    """
    finished = finished_batches(spark, target)
    before = snapshot_through(spark, target)
    if not finished or (before is not None and finished[-1] <= before):
        return before
    through = finished[-1]
    schema = _registers_schema(by_schema)
    rows = read_batches(spark, target, schema).where(F.col("batch_id") <= through)
    if before is not None:
        rows = rows.where(F.col("batch_id") > before).unionByName(spark.read.schema(schema).parquet(_snapshot(target, before)), allowMissingColumns=True)
    by = [name for name in schema.fieldNames() if name not in REGISTER]
    merged = rows.groupBy(*by, "precision", "hash", "bucket").agg(F.max("rank").alias("rank")).select(*schema.fieldNames())
    merged.write.mode("overwrite").parquet(_snapshot(target, through))
    spark.createDataFrame([(through,)], "through bigint").coalesce(1).write.mode("append").parquet(_manifest(target))
    return through


def register_first_stream(
    records: DataFrame,
    key: str,
    event_time: str,
    target: str,
    checkpoint: str,
    within: str | None = None,
) -> StreamingQuery:
    """Keep the first record of every key.

    With ``within``, repeats are dropped for that long and then forgotten.
    Without it every key is kept, and the earliest record by time wins whatever
    order the records come in; repeats are combined before the shuffle.
    """
    if within is not None:
        timed = records.withColumn(event_time, F.col(event_time).cast("timestamp"))
        deduplicated = timed.withWatermark(event_time, within).dropDuplicatesWithinWatermark([key])
        return write_batches(deduplicated, folder_writer(target), checkpoint)
    others = [name for name in records.columns if name != key]
    first = F.min_by(F.struct(*others), F.struct(event_time, *[c for c in others if c != event_time]))
    firsts = records.groupBy(key).agg(first.alias("_first")).select(key, "_first.*")
    return write_batches(firsts, folder_writer(target), checkpoint, "update")


def micro_batches(
    items: DataFrame, item: str, order_by: Sequence[str], target: str, checkpoint: str
) -> StreamingQuery:
    """Number the items of each micro-batch in order and write them; :func:`stored_buffers` cuts them into buffers."""

    def number(batch: DataFrame, batch_id: int) -> None:
        folder_writer(target)(with_index(batch, order_by).select("index", F.col(item).alias("item")), batch_id)

    return write_batches(items, number, checkpoint)


def stored_buffers(spark: SparkSession, target: str, item_type: str, size: int) -> DataFrame:
    """``batch, batch_size, items``: buffers of ``size`` items over the whole stream; only its last one may be short.

    An item's place is its number in its micro-batch after those of all micro-batches before, so how the stream was cut into micro-batches
    shifts no buffer, and a replay overwrites its own folder. The counts are a row per micro-batch.
    """
    stored = read_batches(spark, target, StructType.fromDDL(f"index bigint, item {item_type}"))
    earlier = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("batch_id", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    placed = stored.join(F.broadcast(offsets), "batch_id").select((F.col("offset") + F.col("index")).alias("index"), "item")
    return fixed_size_batches(placed, "item", "index", size)
