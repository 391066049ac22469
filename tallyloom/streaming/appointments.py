"""The appointment workflow as a stream: one state of fixed size per appointment, refusals as rows when they happen."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallyloom.operators.workflow import STAGE_TIMES, UNKNOWN, WORKFLOW_STATUSES, notes_of, refusal_note, status_ordinal, walk_on
from tallyloom.session import REMOVE_SHUFFLES_CONF, thrifty_session
from tallyloom.streaming.jobs import batch_folder, finished_batches, read_batches, remove_batch, write_batches

_KEY = "appointment_id"
_REPORT = f"{_KEY} string, status string, event_time timestamp_ntz, ordinal int, reports bigint, patient_id string"
_TIMES = ", ".join(f"{name} timestamp_ntz" for name in STAGE_TIMES.values())
_STATE = f"{_KEY} string, patient_id string, status string, {_TIMES}, refused bigint, metadata map<string, string>, _ended timestamp_ntz, since bigint"
_OUT = f"{_STATE}, kind string, event_time timestamp_ntz, reports bigint"
_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    # Only the last micro-batch can be run again; the files of a hundred versions of the state would be many times the state.
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.parquet.compression.codec": "zstd",
    REMOVE_SHUFFLES_CONF: "true",
}
REPORTS_SCHEMA = "appointment_id string, patient_id string, status string, event_time timestamp_ntz"


def _schema(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def _columns(rows: DataFrame, ddl: str) -> DataFrame:
    """The columns of a schema, null where ``rows`` hasn't got them."""
    return rows.select(
        *[(F.col(one.name) if one.name in rows.columns else F.lit(None)).cast(one.dataType).alias(one.name) for one in _schema(ddl)]
    )


def workflow_stream(
    events: DataFrame, target: str, checkpoint: str, delay: str = "1 day", kept_days: int = 30
) -> StreamingQuery:
    """Walk a stream of ``appointment_id, patient_id, status, event_time`` and write changed states and refused reports, batch by batch.

    A report waits, equal ones as one row with their number, until the watermark, ``delay`` behind the newest time, has passed its time, so
    that one that comes in late, but within the delay, is still taken in its place; those without a time are refused at once. Reports that are
    older than the watermark are dropped by Spark and counted in the progress of the query (``numRowsDroppedByWatermark``, equal ones of
    a task as one). Every micro-batch hands on the reports that came due, and their appointments walk on from the states of the batch before, in
    ``<target>_states``. The state is one row: the times of the accepted reports, and counts. ``kept_days`` after its end an
    appointment leaves the states; later reports open a new one. The waiting reports are in the RocksDB state store, chosen for this query alone,
    compressed, known statuses as their number, and of its versions the last two are kept. Shuffle files go with the query that made them.
    """
    rows = events.select(
        _KEY,
        "patient_id",
        "status",
        F.coalesce(status_ordinal("status"), F.lit(UNKNOWN)).alias("ordinal"),
        F.col("event_time").cast("timestamp").alias("event_time"),
    )
    timed = rows.where(F.col("event_time").isNotNull()).withWatermark("event_time", delay)
    counts = F.count(F.lit(1)).alias("reports"), F.min("patient_id").alias("patient_id")
    other = F.when(F.col("ordinal") == UNKNOWN, F.col("status")).alias("_other")
    waited = timed.groupBy(_KEY, other, "event_time", "ordinal").agg(*counts)
    named = F.when(F.col("ordinal") == UNKNOWN, F.col("_other")).otherwise(F.get(F.array(*[F.lit(name) for name in WORKFLOW_STATUSES]), F.col("ordinal")))
    due = waited.select(_KEY, named.alias("status"), "event_time", "ordinal", "reports", "patient_id")
    untimed = rows.where(F.col("event_time").isNull()).withColumn("reports", F.lit(1).cast("bigint")).select(*due.columns)
    spark, folder, kept = events.sparkSession, target.rstrip("/"), F.make_dt_interval(days=F.lit(kept_days))
    own = thrifty_session(spark)

    def walk(batch: DataFrame, batch_id: int) -> None:
        path = batch_folder(f"{folder}_due", batch_id)
        _columns(batch, _REPORT).write.mode("overwrite").parquet(path)
        taken = own.read.schema(_REPORT).parquet(path)
        seen = taken.agg(F.count(F.lit(1)).alias("n"), F.max("event_time").alias("newest")).first()
        if seen["n"]:
            earlier = [number for number in finished_batches(spark, f"{folder}_states") if number < batch_id]
            live = own.read.schema(_STATE).parquet(batch_folder(f"{folder}_states", earlier[-1])) if earlier else own.createDataFrame([], _STATE)
            # Timed reports come due once, as one row; only those without a time have to be counted still.
            untimed = taken.where(F.col("event_time").isNull()).groupBy(_KEY, "status", "event_time", "ordinal")
            counted = untimed.agg(F.sum("reports").alias("reports"), F.min("patient_id").alias("patient_id"))
            states, refused = walk_on(taken.where(F.col("event_time").isNotNull()).unionByName(counted), live)
            since = F.coalesce("since", F.lit(batch_id))
            states, refused = states.withColumns({"kind": F.lit("state"), "since": since}), refused.withColumns({"kind": F.lit("refused"), "since": since})
            out = _columns(states, _OUT).unionByName(_columns(refused, _OUT))
            out.write.mode("overwrite").parquet(batch_folder(target, batch_id))
            changed = own.read.schema(_OUT).parquet(batch_folder(target, batch_id)).where(F.col("kind") == "state")
            kept_on = _columns(changed, _STATE)
            if earlier:
                rest = live.withColumn("_key", F.struct(_KEY)).hint("merge").join(changed.select(F.struct(_KEY).alias("_key")), "_key", "left_anti")
                kept_on = _columns(rest, _STATE).unionByName(kept_on)
            if seen["newest"] is not None:
                kept_on = kept_on.where(F.col("_ended").isNull() | (F.col("_ended") + kept > F.lit(str(seen["newest"])).cast("timestamp_ntz")))
            kept_on.write.mode("overwrite").parquet(batch_folder(f"{folder}_states", batch_id))
            for number in earlier[:-1]:
                remove_batch(spark, f"{folder}_states", number)
        remove_batch(spark, f"{folder}_due", batch_id)

    before = {name: spark.conf.get(name, None) for name in _STORE}
    try:
        for name, value in _STORE.items():
            spark.conf.set(name, value)
        return write_batches(due.unionByName(untimed), walk, checkpoint)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def report_the_time(spark: SparkSession, path: str, time: datetime) -> None:
    """Add to a folder of reports one of no appointment, at ``time``, so that the watermark goes on when no others come."""
    row = spark.createDataFrame([(None, None, None, time)], REPORTS_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(path)


def _written(spark: SparkSession, target: str) -> DataFrame:
    """What a stream has written; nothing if no report has come due yet."""
    if not finished_batches(spark, target):
        return _columns(spark.createDataFrame([], _OUT), f"{_OUT}, batch_id bigint")
    return read_batches(spark, target, _schema(_OUT))


def stored_workflow_states(spark: SparkSession, target: str) -> DataFrame:
    """The newest state of every appointment, in the columns of :func:`tallyloom.operators.workflow.workflow_states`."""
    columns = [_KEY, "patient_id", "status", *STAGE_TIMES.values(), "refused", "metadata"]
    # One shuffle, of which both groupings make use.
    rows = _written(spark, target).select(F.struct(_KEY).alias("_key"), "since", "kind", "batch_id", "event_time", "reports", *columns).repartition("_key")
    is_state = F.col("kind") == "state"
    place = F.when(is_state, F.struct("batch_id", F.col("metadata")["events"].cast("bigint").alias("events")))
    ordinal = F.coalesce(status_ordinal("status"), F.lit(UNKNOWN))
    notes = notes_of(F.col("status"), F.col("event_time"), ordinal, F.when(F.col("kind") == "refused", F.col("reports")))
    opened = rows.groupBy("_key", "since").agg(F.max_by(F.struct(*columns), place).alias("_state"), F.max(place).alias("_place"), notes.alias("notes"))
    newest = F.max_by(F.struct("_state", "notes"), F.col("_place")).alias("_newest")
    states = opened.where(F.col("_place").isNotNull()).groupBy("_key").agg(newest)
    return states.select(
        *[F.col(f"_newest._state.{name}").alias(name) for name in columns[:-2]],
        F.col("_newest.notes").alias("notes"),
        F.col("_newest._state.refused").alias("refused"),
        F.col("_newest._state.metadata").alias("metadata"),
    )


def stored_workflow_refusals(spark: SparkSession, target: str) -> DataFrame:
    """The refused reports, in the columns of :func:`tallyloom.operators.workflow.workflow_refusals`."""
    refused = _written(spark, target).where(F.col("kind") == "refused")
    return refused.select(_KEY, "status", "event_time", "reports", refusal_note("status").alias("note"))
