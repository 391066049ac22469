"""Records, transforms, loads and counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyloom.functions.values import (
    map_default,
    tag_datetime,
    tag_int,
    tag_other,
    tag_string,
    temperature_f,
    to_utc,
    trim_whitespace,
    upper_invariant,
    value_text,
)
from tallyloom.operators import etl
from tallyloom.plans.etl import load_lineage_of_records
from tallyloom.session import scratch_path
from tallyloom.sources import records, sinks
from tallyloom.sources.files import FORECAST_SCHEMA, read_json_array


def typed(spark):
    base = spark.createDataFrame(
        [("s", "  ab ß \n", None, None, None), ("i", None, 21, None, None), ("big", None, 2_000_000_000, None, None),
         ("d", None, None, dt.datetime(2025, 7, 1, 12), None), ("o", None, None, None, "1.5"), ("n", None, None, None, None)],
        "id string, s string, i int, ts timestamp_ntz, o string",
    )
    return base.select("id", F.coalesce(tag_string("s"), tag_int("i"), tag_datetime("ts"), tag_other("o")).alias("value"))


def results(spark, zone="Europe/Berlin"):
    return etl.transform_or_keep(etl.validate_not_null(typed(spark)), zone=zone)


def test_transform_by_payload_type(spark):
    got = {r["id"]: r for r in results(spark).withColumn("text", value_text("transformed_data")).collect()}
    assert got["s"]["text"] == "AB ß"
    assert got["i"]["transformed_data"]["i"] == 42
    assert got["d"]["transformed_data"]["ts"] == dt.datetime(2025, 7, 1, 10)
    assert got["o"]["text"] == "1.5"
    assert got["big"]["transformed_data"]["i"] == 2_000_000_000
    assert got["big"]["validation_errors"] == ["Transformation error: number out of range"]
    assert got["n"]["transformed_data"] is None and got["n"]["validation_errors"] == ["Data cannot be null"]
    assert all(not got[k]["validation_errors"] for k in "sido")


def test_routing_log_and_lineage(spark):
    rows = results(spark)
    target = sinks.route_by_type_sink(rows, scratch_path(spark, "t"))
    stores = {r["id"]: r["store"] for r in spark.read.parquet(target).collect()}
    assert stores == {"s": "string_store", "i": "number_store", "d": "datetime_store", "o": "default_store"}
    log = etl.load_result_log(rows)
    by_id = {r["transformation_id"]: r for r in log.collect()}
    assert by_id["s"]["success"] and by_id["s"]["storage_location"].startswith("string_store/")
    assert not by_id["n"]["success"] and by_id["n"]["error_message"] == "Validation errors present"
    assert by_id["n"]["storage_location"] is None
    joined = etl.load_lineage(rows, log.where("success"))
    assert {r["id"] for r in joined.where("load_id is null").collect()} == {"n", "big"}


def test_batch_load_takes_everything(spark):
    target = scratch_path(spark, "batch")
    sinks.load_batch(typed(spark), target)
    path = sinks.load_batch(typed(spark), target)
    assert path.endswith("default_store") and spark.read.parquet(path).count() == 12


def test_job_stats(spark):
    job = etl.EtlJob(source=lambda: typed(spark), load=sinks.noop_sink)
    stats = etl.run_with_stats(job)
    assert stats.first()["start_time"] is not None
    assert stats.drop("start_time").first().asDict() == {
        "extracted_count": 6, "transformed_count": 4, "loaded_count": 4, "error_count": 2, "status": "Completed",
    }


def test_sources(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 500 != 0, F.concat(F.lit("t"), "id")).alias("t"))
    raw = records.raw_records(rows.where("id < 250"), "id", "t", "table t", 100)
    assert {r["batch"]: r["count"] for r in raw.groupBy("batch").count().collect()} == {0: 100, 1: 100, 2: 50}
    first = raw.where("id = '7'").first()
    assert first["raw_content"] == "t7" and first["metadata"]["source"] == "table t"
    assert records.flat_records(rows, "id", "t", "table t").where("data = 't9'").count() == 1
    safe = records.with_error_fallback(records.raw_records(rows, "id", "t", "s"), F.col("raw_content").isNull(), "no content")
    failed = safe.where(F.col("metadata")["isError"] == "true").collect()
    assert sorted(r["raw_content"] for r in failed) == ["Error_0", "Error_500"]
    assert all(r["metadata"]["error"] == "no content" for r in failed)
    assert safe.where(F.col("metadata")["isRetry"] == "false").count() == 998


def test_seeded_ints_do_not_depend_on_partitions(spark):
    one = records.random_ints(spark.range(5000).repartition(1), "id")
    many = records.random_ints(spark.range(5000).repartition(17), "id")
    assert one.exceptAll(many).isEmpty()
    low, high, kinds = one.agg(F.min("value"), F.max("value"), F.count_distinct("value")).first()
    assert (low, high, kinds) == (1, 99, 99)


def test_forecasts(spark):
    rows = records.forecast_source(spark, 5, today=F.to_date(F.lit("2025-01-01"))).collect()
    assert sorted(str(r["date"]) for r in rows)[0] == "2025-01-02" and len(rows) == 5
    assert all(-20 <= r["temperature_c"] < 55 and r["summary"] in records.SUMMARIES for r in rows)
    f = spark.createDataFrame([(-20,), (0,), (54,)], "c int").select(temperature_f("c").alias("f"))
    assert [r["f"] for r in f.collect()] == [-3, 32, 129]


def test_preprocess_and_drop(spark):
    raw = spark.createDataFrame([("1", "x"), ("2", None)], "id string, raw_content string")
    assert [r["processed_data"] for r in etl.preprocess(raw).orderBy("id").collect()] == ["x", ""]
    kept = etl.drop_failed(raw, F.try_divide(F.lit(1), F.expr("try_cast(id as int) - 1")), "out")
    assert [r["id"] for r in kept.collect()] == ["2"]


def test_text_rules(spark):
    rows = spark.createDataFrame([("  Straße ﬁx ıſ ᾳ　\t",)], "t string").select(
        upper_invariant(trim_whitespace("t")).alias("u")
    )
    assert rows.first()["u"] == "STRAßE ﬁX ıſ ᾼ"


def test_zones_follow_daylight_saving(spark):
    rows = spark.createDataFrame(
        [(dt.datetime(2025, 1, 1, 12),), (dt.datetime(2025, 7, 1, 12),)], "t timestamp_ntz"
    ).select(to_utc("t", "America/New_York").alias("u"))
    assert [r["u"].hour for r in rows.collect()] == [17, 16]


def test_map_default(spark):
    rows = spark.sql("SELECT map('a', 1, 'b', CAST(NULL AS INT)) AS m").select(
        map_default("m", "a", F.lit(9)), map_default("m", "b", F.lit(9)), map_default("m", "c", F.lit(9)), map_default("m", "c")
    )
    assert tuple(rows.first()) == (1, 9, 9, None)


def test_json_arrays_skip_nulls(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '[null,\n {"date": "2025-01-01", "temperature_c": 3, "summary": null},\n {"date": "2025-01-02"}, null]'
    )
    rows = read_json_array(spark, str(tmp_path), FORECAST_SCHEMA).orderBy("date").collect()
    assert [(str(r["date"]), r["temperature_c"]) for r in rows] == [("2025-01-01", 3), ("2025-01-02", None)]


def test_lineage_joins_stored_buckets_without_a_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = load_lineage_of_records(spark, "/root/testdata/sf0.001")
        assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
        assert frame.count() > 0 and not [t for t in spark.catalog.listTables() if t.name.startswith("tallyloom_") and not t.isTemporary]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
