"""Record sources, transforms, loads and their bookkeeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.functions.values import (
    progress_json,
    stable_id,
    to_utc,
    trim_whitespace,
    upper_invariant,
    value_text,
)
from tallyloom.operators import etl
from tallyloom.plans.inputs import RESULTS_SQL, TYPED_RECORDS_SQL, typed_records
from tallyloom.plans.registry import query
from tallyloom.session import materialize_by, scratch_path
from tallyloom.sources import records, sinks
from tallyloom.sources.files import read_table
from tallyloom.sources.plugins import register_stores

_NOW = "2025-01-01 00:00:00"
BUCKET_ROWS = 200_000  #: about so many in a bucket of a stored table


def _now() -> Column:
    return F.to_timestamp_ntz(F.lit(_NOW))


@query("""
select p_partkey::varchar as id, p_name as raw_content, p_partkey // 100 as batch,
       'part' as source, (p_partkey // 100)::varchar as batch_text
from part
""")
def raw_records_of_parts(spark: SparkSession, folder: str) -> DataFrame:
    rows = records.raw_records(read_table(spark, folder, "part"), "p_partkey", "p_name", "part")
    return rows.select(
        "id",
        "raw_content",
        "batch",
        F.col("metadata")["source"].alias("source"),
        F.col("metadata")["batch"].alias("batch_text"),
    )


@query("""
select o_orderkey as id, o_orderpriority as data, 'orders' as source from orders
""")
def flat_records_of_orders(spark: SparkSession, folder: str) -> DataFrame:
    rows = records.flat_records(read_table(spark, folder, "orders"), "o_orderkey", "o_orderpriority", "orders")
    return rows.select("id", "data", "source")


@query("""
select event_id::varchar as id, case when k is null then 'Error_' || event_id else props end as raw_content,
       case when k is null then 'no such day' end as error,
       case when k is null then 'true' end as is_error, case when k is not null then 'false' end as is_retry
from (select *, try_cast('2024-01-' || lpad(json_extract_string(props, '$.k'), 2, '0') as date) as k from events)
""")
def records_with_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """Every event's properties as a record; those whose number can't be read as a day of January are replaced."""
    rows = records.raw_records(read_table(spark, folder, "events"), "event_id", "props", "events")
    day = F.concat(F.lit("2024-01-"), F.lpad(F.get_json_object("raw_content", "$.k"), 2, "0")).try_cast("date")
    safe = records.with_error_fallback(rows, day.isNull(), "no such day")
    meta = F.col("metadata")
    return safe.select(
        "id",
        "raw_content",
        meta["error"].alias("error"),
        meta["isError"].alias("is_error"),
        meta["isRetry"].alias("is_retry"),
    )


@query("""
select id, coalesce(raw, '') as processed_data, timestamp '2025-01-01' as processed_at
from (select doc_id::varchar as id, text as raw from documents
      union all select 'label-' || doc_id, text from labels left join (select doc_id, text from documents where lang = 'en') using (doc_id))
""")
def preprocess_documents(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, and the labelled ones joined to their English texts, which some don't have."""
    documents = read_table(spark, folder, "documents").select("doc_id", "lang", F.col("text").alias("raw_content"))
    labelled = read_table(spark, folder, "labels").select("doc_id").join(documents.where("lang = 'en'"), "doc_id", "left")
    named = labelled.select(F.concat(F.lit("label-"), "doc_id").alias("id"), "raw_content")
    return etl.preprocess(documents.select(F.col("doc_id").cast("string").alias("id"), "raw_content").unionByName(named), _now())


@query("""
select doc_id,
       replace(upper(replace(trim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(160)), 'ß', chr(57344))),
               chr(57344), 'ß') as normalized
from documents
""")
def normalize_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts, padded with white space, trimmed and upper-cased."""
    padded = F.concat(F.lit(" \n"), F.col("text"), F.lit(" \t"))
    trimmed = read_table(spark, folder, "documents").select("doc_id", trim_whitespace(padded).alias("text"))
    return trimmed.select("doc_id", upper_invariant("text").alias("normalized"))


def _results(spark: SparkSession, folder: str) -> DataFrame:
    return etl.transform_or_keep(etl.validate_not_null(typed_records(spark, folder)), now=_now())


@query(f"""
select id, kind, new_s as s, new_i as i, new_ts as ts, coalesce(error, '') as errors from ({RESULTS_SQL})
""")
def transform_typed_records(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("transformed_data")
    return _results(spark, folder).select(
        "id",
        value["kind"].alias("kind"),
        value["s"].alias("s"),
        value["i"].alias("i"),
        value["ts"].alias("ts"),
        F.array_join("validation_errors", ";").alias("errors"),
    )


@query("""
select o_orderkey, (o_custkey * 2000000)::integer as scaled from orders where o_custkey * 2000000 <= 2147483647
""")
def drop_overflowing_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    attempt = F.try_multiply(F.col("o_custkey").cast("int"), F.lit(2_000_000))
    return etl.drop_failed(orders, attempt, "scaled").select("o_orderkey", "scaled")


@query(f"select id, kind from ({RESULTS_SQL}) where error is null")
def loadable_records(spark: SparkSession, folder: str) -> DataFrame:
    return etl.is_loadable(_results(spark, folder)).select("id", F.col("transformed_data.kind").alias("kind"))


STORE_SQL = (
    "case kind when 'string' then 'string_store' when 'int' then 'number_store'"
    " when 'datetime' then 'datetime_store' else 'default_store' end"
)
TEXT_SQL = "coalesce(new_s, new_i::varchar, strftime(new_ts, '%Y-%m-%dT%H:%M:%S'))"


@query(f"select id, coalesce(s, i::varchar, strftime(ts, '%Y-%m-%dT%H:%M:%S')) as text from ({TYPED_RECORDS_SQL})")
def load_batch_to_default_store(spark: SparkSession, folder: str) -> DataFrame:
    """All rows, whatever their payload, written to the default store and read back."""
    path = sinks.load_batch(typed_records(spark, folder), scratch_path(spark, "batch"))
    return spark.read.parquet(path).select("id", value_text("value").alias("text"))


@query(f"select id, {STORE_SQL} as store, {TEXT_SQL} as text from ({RESULTS_SQL}) where error is null")
def route_records_by_type(spark: SparkSession, folder: str) -> DataFrame:
    """Loadable rows written to one store per payload type and read back."""
    path = sinks.route_by_type_sink(_results(spark, folder), scratch_path(spark, "stores"))
    return spark.read.parquet(path).select("id", "store", value_text("transformed_data").alias("text"))


@query(f"select id, {TEXT_SQL} as text from ({RESULTS_SQL}) where error is null")
def records_loaded_by_plug_in(spark: SparkSession, folder: str) -> DataFrame:
    """Loadable records through a registered loader and back through its source; a second load breaks off in a task and leaves nothing."""
    register_stores(spark)
    path = scratch_path(spark, "committed")

    def load(rows: DataFrame, name: str) -> None:
        kept = etl.is_loadable(rows).select("id", "transformed_data")
        kept.write.format("committed").option("load", name).mode("append").save(path)

    def break_off(rows: DataFrame) -> None:
        """A loader that meets a date it refuses."""
        refused = F.raise_error(F.lit("no dates here"))
        load(rows.where(F.when(F.col("id").startswith("date-"), refused).otherwise(F.lit(True))), "broken")

    for loader in (lambda rows: load(rows, "whole"), break_off):
        etl.run_with_stats(etl.EtlJob(source=lambda: typed_records(spark, folder), load=loader))
    return spark.read.format("committed").load(path).select("id", value_text("transformed_data").alias("text"))


LOG_SQL = f"""
  select sha256('load' || chr(31) || id) as id, id as transformation_id, error is null as success,
         case when error is null then {STORE_SQL} || '/' || sha256(id) end as storage_location,
         case when error is not null then 'Validation errors present' end as error_message
  from ({RESULTS_SQL})
"""


@query(LOG_SQL)
def load_log_of_records(spark: SparkSession, folder: str) -> DataFrame:
    """The audit rows, appended to a log table and read back."""
    path = sinks.append_log(etl.load_result_log(_results(spark, folder), now=_now()), scratch_path(spark, "log"))
    return spark.read.parquet(path).drop("loaded_at")


@query(f"""
select r.id, {TEXT_SQL} as text, l.id as load_id, success, storage_location
from ({RESULTS_SQL}) r left join ({LOG_SQL}) l on l.transformation_id = r.id and l.success
""")
def load_lineage_of_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every transformation with its successful load, both from stored tables in the same buckets of ids."""
    buckets = -(-typed_records(spark, folder).count() // BUCKET_ROWS) or 1
    results = materialize_by(_results(spark, folder).repartition(buckets, "id"), "results", "id", buckets)
    log = etl.load_result_log(results, now=_now()).where("success")
    loads = materialize_by(log, "load-log", "transformation_id", buckets)
    return etl.load_lineage(results, loads).select(
        "id", value_text("transformed_data").alias("text"), "load_id", "success", "storage_location"
    )


@query(f"""
select count(*) as extracted_count, count_if(error is null and kind is not null)::bigint as transformed_count, count_if(error is null)::bigint as loaded_count,
       count_if(error is not null)::bigint as error_count, 'Completed' as status
from ({RESULTS_SQL})
""")
def etl_job_stats(spark: SparkSession, folder: str) -> DataFrame:
    """A job of pluggable steps into a store that keeps nothing, with its counts."""
    job = etl.EtlJob(source=lambda: typed_records(spark, folder), load=sinks.noop_sink)
    return etl.run_with_stats(job).drop("start_time")


@query(f"""
select 'Completed' as status, count(*) as extracted_count, count_if(error is null)::bigint as loaded_count from ({RESULTS_SQL})
union all select 'Failed', null, null union all select 'Cancelled', null, null
""")
def etl_job_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """The same job ending in its three ways: whole, with a load that breaks off, and called off before it began."""
    def refuse(rows: DataFrame) -> None:
        raise OSError("no store")

    whole, failed = (etl.EtlJob(source=lambda: typed_records(spark, folder), load=load) for load in (sinks.noop_sink, refuse))
    outcomes = etl.run_with_stats(whole).unionByName(etl.run_with_stats(failed)).unionByName(etl.run_with_stats(whole, lambda: True))
    return outcomes.select("status", "extracted_count", "loaded_count")


@query("select o_orderkey, o_orderdate - interval 330 minute as utc from orders")
def orders_to_utc(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").select("o_orderkey", to_utc("o_orderdate", "+05:30").alias("utc"))


@query("select p_partkey, sha256(p_partkey || chr(31) || p_name) as key from part")
def stable_part_ids(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select("p_partkey", stable_id("p_partkey", "p_name").alias("key"))


@query("""
select o_orderkey, '{"job_id":"' || o_orderkey || '","stage":"' || o_orderpriority || '","processed_items":' || o_custkey
       || ',"total_items":null,"status":"' || o_orderstatus || '"}' as message
from orders
""")
def progress_messages_of_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in the shape of progress rows, as JSON text."""
    rows = read_table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("job_id"),
        F.col("o_orderpriority").alias("stage"),
        F.col("o_custkey").alias("processed_items"),
        F.lit(None).cast("bigint").alias("total_items"),
        F.col("o_orderstatus").alias("status"),
    )
    fields = ["job_id", "stage", "processed_items", "total_items", "status"]
    return rows.select("o_orderkey", progress_json(fields).alias("message"))
