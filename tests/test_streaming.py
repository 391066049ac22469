"""Streams give what the batch gives, over several micro-batches and after a restart."""

from __future__ import annotations

import datetime as dt
import os
import random
import shutil
import time as clock
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import workflow
from tallyloom.operators.sketch import hll_build, hll_estimate
from tallyloom.plans.streams import BATCH_FILES, FILE_ROWS, files_of
from tallyloom.session import scratch_path
from tallyloom.sources.records import numbered_elements
from tallyloom.streaming import appointments, flows
from tallyloom.streaming.jobs import (
    JobLog,
    StreamJob,
    file_stream,
    folder_writer,
    late_rows,
    latest_rows,
    progress_feed,
    progress_messages,
    progress_writer,
    read_batches,
    write_batches,
)


def as_stream(spark, frame, files=4, max_files=1):
    path = scratch_path(spark, "input")
    frame.repartition(files).write.parquet(path)
    return path, file_stream(spark, path, frame.schema, max_files)


def test_sketch_grows_with_the_stream(spark):
    rows = numbered_elements(spark, 4000).withColumn("g", (F.col("index") % 2).cast("string"))
    path, stream = as_stream(spark, rows)
    target, checkpoint = scratch_path(spark, "hll"), scratch_path(spark, "ck")
    flows.incremental_hll(stream, "element", target, checkpoint, 12, ["g"]).awaitTermination()
    columns = ["g", "precision", "hash", "bucket", "rank"]
    got = {tuple(r) for r in flows.stored_registers(spark, target, "g string").select(columns).collect()}
    assert got == {tuple(r) for r in hll_build(rows, "element", 12, ["g"]).select(columns).collect()}
    more = numbered_elements(spark, 3000, start=3000).withColumn("g", F.lit("0"))
    more.write.mode("append").parquet(path)
    flows.incremental_hll(stream, "element", target, checkpoint, 12, ["g"]).awaitTermination()
    both = rows.unionByName(more)
    expected = {r["g"]: r["estimate"] for r in hll_estimate(hll_build(both, "element", 12, ["g"]), ["g"]).collect()}
    stored = flows.stored_registers(spark, target, "g string")
    assert {r["g"]: r["estimate"] for r in hll_estimate(stored, ["g"]).collect()} == expected


REPORTS = "appointment_id string, patient_id string, status string, event_time timestamp_ntz"
NEW_YEAR = dt.datetime(2025, 1, 1)


def run_workflow(spark, files, **options):
    """Files of reports, one per micro-batch in this order; the progress rows and the target."""
    path, target = scratch_path(spark, "reports"), scratch_path(spark, "wf")
    for number, rows in enumerate(files):
        spark.createDataFrame(rows, REPORTS).coalesce(1).write.parquet(f"{path}/{number:03}")
        for file in Path(f"{path}/{number:03}".removeprefix("file:")).glob("part-*"):
            os.utime(file, (number * 60 + 1e9,) * 2)
    stream = file_stream(spark, f"{path}/*", spark.createDataFrame([], REPORTS).schema, 1)
    query = appointments.workflow_stream(stream, target, scratch_path(spark, "ck"), **options)
    query.awaitTermination()
    return query.recentProgress, target


def test_workflow_stream_equals_batch(spark):
    rng = random.Random(5)
    stages = [*workflow.WORKFLOW_STATUSES, "Asleep", None]
    times = [NEW_YEAR + dt.timedelta(minutes=rng.randrange(3000)) for _ in range(600)]
    rows = [(str(rng.randrange(40)), str(rng.randrange(3)), rng.choice(stages), None if rng.random() < 0.02 else time) for time in times]
    rows.sort(key=lambda row: (row[3] or NEW_YEAR) + dt.timedelta(minutes=rng.randrange(600)))  # up to ten hours late
    clock = [(None, None, None, NEW_YEAR + dt.timedelta(days=9))]
    progress, target = run_workflow(spark, [rows[:150], rows[150:300], rows[300:450], rows[450:], clock], delay="11 hours", kept_days=10)
    assert len(progress) >= 5 and not any(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress)
    table = spark.createDataFrame(rows, REPORTS)
    expected = {r["appointment_id"]: r for r in workflow.workflow_states(table).collect()}
    assert {r["appointment_id"]: r for r in appointments.stored_workflow_states(spark, target).collect()} == expected
    listed = lambda df: sorted(map(str, df.groupBy("appointment_id", "status", "event_time", "note").agg(F.sum("reports")).collect()))
    assert listed(appointments.stored_workflow_refusals(spark, target)) == listed(workflow.workflow_refusals(table))
    early = {(r["batch_id"], r["kind"]) for r in spark.read.parquet(target).select("batch_id", "kind").distinct().collect()}
    assert {(2, "state"), (2, "refused")} <= early, "results come while the stream goes on"


def test_finished_appointments_leave_the_state_and_old_reports_are_counted(spark):
    day = lambda n: NEW_YEAR + dt.timedelta(days=n)
    stages = workflow.WORKFLOW_STATUSES[:6]
    done = [("a", "p", stage, day(0) + dt.timedelta(hours=i)) for i, stage in enumerate(stages)]
    after = [("a", "q", "CheckedIn", day(3)), ("b", "p", "CheckedIn", day(3))]
    progress, target = run_workflow(
        spark, [done, after, [("b", "p", "CheckedIn", day(50))], [("b", "p", "Asleep", day(1))], [("c", "p", "CheckedIn", day(99))], [("d", "p", None, day(200))]],
        delay="1 day", kept_days=10,
    )
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress) == 1
    states = {r["appointment_id"]: (r["status"], r["refused"]) for r in appointments.stored_workflow_states(spark, target).collect()}
    assert states == {"a": ("Completed", 1), "b": ("CheckedIn", 1), "c": ("CheckedIn", 0)}
    # Left in the state: rows and timers of b and c and what waits of d, and nothing of a.
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] <= 6


def test_waiting_reports_are_in_built_in_state_and_refusals_are_told(spark):
    hour = lambda n: NEW_YEAR + dt.timedelta(hours=n)
    files = [
        [("a", "p", "CheckedIn", hour(1)), ("a", "p", "CheckedIn", hour(1)), ("b", "p", "Asleep", None)],
        [("a", "p", "Cancelled", hour(30)), ("a", "q", "InsuranceVerified", hour(20))],
        [("a", "p", "CheckedIn", hour(40)), (None, None, None, hour(900))],
    ]
    progress, target = run_workflow(spark, files, delay="2 days")
    # A keyed processor in Python needs some milliseconds for every appointment and micro-batch.
    assert {p["stateOperators"][0]["operatorName"] for p in progress} == {"stateStoreSave"}
    states = {r["appointment_id"]: (r["status"], r["notes"]) for r in appointments.stored_workflow_states(spark, target).collect()}
    assert states == {"a": ("Cancelled", ["rejected CheckedIn"] * 2), "b": (None, ["rejected Asleep"])}


def test_workflow_stream_leaves_neither_shuffles_nor_old_versions_and_goes_on(spark):
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {path for path in store.getAllFiles().mkString("|").split("|") if "/shuffle_" in path}
    rng = random.Random(8)
    path, target, checkpoint = (scratch_path(spark, name) for name in ("reports", "wf", "ck"))
    reports = []
    for number in range(8):
        time = lambda: NEW_YEAR + dt.timedelta(days=number, minutes=rng.randrange(1400))
        some = [(str(rng.randrange(30)), "p", rng.choice([*workflow.WORKFLOW_STATUSES[:6], "Asleep", None]), time()) for _ in range(60)]
        reports += some
        spark.createDataFrame([*some, *[(None, None, None, NEW_YEAR + dt.timedelta(days=60))][: number == 7]], REPORTS).coalesce(1).write.parquet(f"{path}/{number}")
        if number in (4, 7):  # the second run goes on from the checkpoint of the first
            before = shuffles()
            stream = file_stream(spark, f"{path}/*", spark.createDataFrame([], REPORTS).schema, 1)
            appointments.workflow_stream(stream, target, checkpoint, "3 days").awaitTermination()
            for _ in range(50):  # files go in the background
                if not shuffles() - before:
                    break
                clock.sleep(0.2)
            assert not shuffles() - before
    assert len([name for name in os.listdir(f"{checkpoint}/commits".removeprefix("file:")) if name.isdigit()]) <= 3
    expected = {r["appointment_id"]: r for r in workflow.workflow_states(spark.createDataFrame(reports, REPORTS)).collect()}
    assert {r["appointment_id"]: r for r in appointments.stored_workflow_states(spark, target).collect()} == expected


def test_files_and_micro_batches_of_a_stream_are_bounded():
    for rows in (0, 5, 300_000, 9_000_000, 54_000_000):
        files, taken = files_of(rows)
        assert files >= 3 and -(-rows // files) <= FILE_ROWS and taken <= BATCH_FILES and 3 * taken <= files + 2


def test_snapshots_survive_an_end_between_their_steps(spark, monkeypatch):
    rows = numbered_elements(spark, 6000).withColumn("g", (F.col("index") % 2).cast("string"))
    path, stream = as_stream(spark, rows, files=4)
    target, checkpoint = scratch_path(spark, "hll"), scratch_path(spark, "ck")
    order = ["g", "precision", "hash", "bucket", "rank"]
    stored = lambda: sorted(map(tuple, flows.stored_registers(spark, target, "g string").select(order).collect()))
    direct = lambda df: sorted(map(tuple, hll_build(df, "element", 10, ["g"], "sha256_64").select(order).collect()))
    assert flows.compact_registers(spark, target, "g string") is None
    flows.incremental_hll(stream, "element", target, checkpoint, 10, ["g"], "sha256_64").awaitTermination()
    with monkeypatch.context() as patched:
        patched.setattr(spark, "createDataFrame", lambda *_: 1 / 0)  # the end comes before the manifest
        with pytest.raises(ZeroDivisionError):
            flows.compact_registers(spark, target, "g string")
    assert flows.snapshot_through(spark, target) is None and stored() == direct(rows)
    assert flows.compact_registers(spark, target, "g string") == 3 == flows.compact_registers(spark, target, "g string")
    assert stored() == direct(rows)
    more = numbered_elements(spark, 3000, start=3000).withColumn("g", F.lit("0"))
    more.coalesce(1).write.mode("append").parquet(path)
    flows.incremental_hll(stream, "element", target, checkpoint, 10, ["g"], "sha256_64").awaitTermination()
    assert stored() == direct(rows.unionByName(more)) and flows.snapshot_through(spark, target) == 3
    for number in range(4):  # these folders are not read any more
        shutil.rmtree(Path(target.removeprefix("file:")) / f"batch_id={number}")
    assert stored() == direct(rows.unionByName(more))
    # A replayed micro-batch that a snapshot holds changes nothing, and one that isn't finished is not taken.
    folder_writer(target)(hll_build(rows.where("index < 100"), "element", 10, ["g"], "sha256_64"), 2)
    (Path(target.removeprefix("file:")) / "batch_id=5").mkdir()
    assert flows.compact_registers(spark, target, "g string") == 4 and stored() == direct(rows.unionByName(more))


def test_repeats_within_the_watermark_and_late_ones(spark):
    time = lambda minute: NEW_YEAR + dt.timedelta(minutes=minute)
    path, target = scratch_path(spark, "twice"), scratch_path(spark, "once")
    for number, minutes in enumerate([range(0, 60), [*range(60, 120), *range(30, 60)], [*range(120, 180), *range(0, 20), 95, 95]]):
        frame = spark.createDataFrame([(m, time(m)) for m in minutes], "k int, t timestamp_ntz")
        frame.coalesce(1).write.parquet(f"{path}/{number}")
    stream = file_stream(spark, f"{path}/*", frame.schema, 1)
    query = flows.register_first_stream(stream, "k", "t", target, scratch_path(spark, "ck"), "40 minutes")
    query.awaitTermination()
    assert sorted(r["k"] for r in spark.read.parquet(target).collect()) == list(range(180))
    assert late_rows(query.recentProgress) == 20


@pytest.mark.parametrize("within", [None, "30 days"])
def test_first_record_wins(spark, within):
    rows = spark.range(300).select(
        (F.col("id") % 20).alias("k"),
        (F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("t"),
        F.col("id").alias("v"),
    )
    path, stream = as_stream(spark, rows, files=3)
    target = scratch_path(spark, "first")
    flows.register_first_stream(stream, "k", "t", target, scratch_path(spark, "ck"), within).awaitTermination()
    if within is None:
        kept = latest_rows(read_batches(spark, target, rows.select("k", "t", "v").schema), ["k"]).collect()
        assert sorted((r["k"], r["v"]) for r in kept) == [(k, k) for k in range(20)]
    else:
        kept = spark.read.parquet(target).collect()
        assert sorted(r["k"] for r in kept) == list(range(20))


@pytest.mark.parametrize("files", [1, 2])
def test_buffers_of_ten(spark, files):
    rows = spark.range(25).select(F.col("id").alias("item"))
    _, stream = as_stream(spark, rows, files)
    target = scratch_path(spark, "ten")
    flows.micro_batches(stream, "item", ["item"], target, scratch_path(spark, "ck")).awaitTermination()
    buffers = flows.stored_buffers(spark, target, "bigint", 10).orderBy("batch").collect()
    assert [(r["batch"], r["batch_size"]) for r in buffers] == [(0, 10), (1, 10), (2, 5)]
    assert sorted(item for r in buffers for item in r["items"]) == list(range(25))


def test_progress_and_status(spark):
    path, stream = as_stream(spark, spark.range(1000), files=4, max_files=2)
    target, progress, checkpoint = (scratch_path(spark, name) for name in ("p", "progress", "ck"))
    run = lambda: StreamJob("good", lambda: write_batches(stream, progress_writer(target, progress), checkpoint))
    job = run()
    assert job.await_end() == "Completed"
    feed = progress_feed(spark, progress, "good", "Completed", 1000).orderBy("batch_id").collect()
    assert [r["status"] for r in feed] == ["Running", "Completed"] and feed[-1]["processed_items"] == 1000
    assert '"job_id":"good"' in progress_messages(progress_feed(spark, progress, "good")).first()["message"]
    assert [r["status"] for r in job.statuses(spark).collect()] == ["Running", "Completed"]
    spark.range(50).coalesce(1).write.mode("append").parquet(path)
    assert run().await_end() == "Completed"
    assert progress_feed(spark, progress, "good", "Cancelled").where("status = 'Cancelled'").first()["processed_items"] == 1050


def test_etl_in_bounded_micro_batches_goes_on_after_a_failure(spark, monkeypatch):
    rows = spark.range(400).select(
        F.concat(F.lit("r"), "id").alias("id"),
        F.when(F.col("id") % 50 > 0, F.struct(F.lit("string").alias("kind"), F.concat(F.lit(" a"), "id").alias("s"), F.lit(None).cast("int").alias("i"), F.lit(None).cast("timestamp_ntz").alias("ts"))).alias("value"),
    )
    _, stream = as_stream(spark, rows, files=4)
    stores, log, checkpoint = (scratch_path(spark, name) for name in ("stores", "log", "ck"))
    turns, audit_rows = [], flows.load_result_log

    def fails_once(batch):
        turns.append(1)
        return audit_rows(batch.where(F.raise_error(F.lit("no store")).isNull())) if len(turns) == 3 else audit_rows(batch)

    monkeypatch.setattr(flows, "load_result_log", fails_once)  # its stores are written, its audit rows are not
    first = flows.streaming_etl(stream, stores, log, checkpoint)
    with pytest.raises(Exception, match="no store"):
        first.awaitTermination()
    second = flows.streaming_etl(stream, stores, log, checkpoint)
    second.awaitTermination()
    assert all(p["numInputRows"] <= 110 for p in [*first.recentProgress, *second.recentProgress])
    assert sorted(r["id"] for r in spark.read.parquet(stores).collect()) == sorted(f"r{i}" for i in range(400) if i % 50)
    audit = spark.read.parquet(log)
    assert audit.count() == 400 and audit.where("not success").count() == 8


def test_a_log_tells_what_became_of_jobs(spark):
    _, stream = as_stream(spark, spark.range(10))
    path = scratch_path(spark, "jobs")
    assert JobLog(spark, path).rows().count() == 0

    def fail(batch, batch_id):
        raise ValueError("no store")

    done = StreamJob("good", lambda: write_batches(stream, folder_writer(scratch_path(spark, "t")), scratch_path(spark, "ck")), JobLog(spark, path))
    done.await_end()
    bad = StreamJob("bad", lambda: write_batches(stream, fail, scratch_path(spark, "ck")), JobLog(spark, path))
    bad.await_end()
    rate = spark.readStream.format("rate").load().writeStream.format("noop").option("checkpointLocation", scratch_path(spark, "ck"))
    StreamJob("endless", rate.start, JobLog(spark, path)).cancel()
    with pytest.raises(ValueError):
        StreamJob("never", lambda: int("x"), JobLog(spark, path))
    later = JobLog(spark, path)  # as another driver would read it
    assert {r["job_id"]: r["status"] for r in later.latest().collect()} == {"good": "Completed", "bad": "Failed", "endless": "Cancelled", "never": "Failed"}
    assert later.rows().count() == 8 and later.latest().where("job_id = 'bad'").first()["message"]


def test_failed_and_cancelled_jobs(spark):
    _, stream = as_stream(spark, spark.range(10))

    def fail(batch, batch_id):
        batch.select(F.raise_error(F.lit("no store"))).write.format("noop").mode("overwrite").save()

    bad = StreamJob("bad", lambda: write_batches(stream, fail, scratch_path(spark, "ck")))
    assert bad.await_end() == "Failed"
    assert bad.statuses(spark).where("status = 'Failed'").first()["message"]
    rate = spark.readStream.format("rate").load()
    endless = StreamJob(
        "endless",
        lambda: rate.writeStream.format("noop").option("checkpointLocation", scratch_path(spark, "ck")).start(),
    )
    assert endless.history[-1][1] == "Running"
    endless.cancel()
    assert endless.history[-1][1] == "Cancelled"
