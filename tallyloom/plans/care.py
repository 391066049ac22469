"""Care plans, forecasts and small column functions over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions.values import map_default, temperature_f
from tallyloom.operators import care, scheduling
from tallyloom.plans.inputs import PREFERENCES_SQL, preferences
from tallyloom.plans.registry import query
from tallyloom.session import scratch_path
from tallyloom.sources.files import FORECAST_SCHEMA, read_json_array, read_json_array_stream, read_table
from tallyloom.sources.json_arrays import read_json_array_ranges
from tallyloom.sources.records import forecasts


def _patients(spark: SparkSession, folder: str) -> DataFrame:
    parsed = F.from_json("body", care.PREFERENCES_SCHEMA)
    return preferences(spark, folder).select("patient_id", parsed.alias("preferences"))


@query(f"""
select patient_id, approach as primary_treatment, comfort as comfort_measures, scheduling as schedule_flexibility
from ({PREFERENCES_SQL})
""")
def care_plans(spark: SparkSession, folder: str) -> DataFrame:
    plan = F.col("treatment_plan")
    return care.care_plan(_patients(spark, folder)).select(
        "patient_id",
        plan["primary_treatment"].alias("primary_treatment"),
        F.array_join(plan["comfort_measures"], "|").alias("comfort_measures"),
        plan["schedule_flexibility"].alias("schedule_flexibility"),
    )


@query(f"""
select patient_id, case when not coalesce(interested, false) then 'None - patient preference' end as participation,
       case when interested then 'Available at any time' end as opt_out_protocol
from ({PREFERENCES_SQL})
""")
def research_participation_of_customers(spark: SparkSession, folder: str) -> DataFrame:
    chosen = care.research_participation("preferences.interested_in_research")
    return _patients(spark, folder).select("patient_id", chosen.alias("_chosen")).select("patient_id", "_chosen.*")


def _examined(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as patients with the needs an examination found."""
    s = F.col("s_acctbal")
    return read_table(spark, folder, "supplier").select(
        "s_suppkey",
        F.struct(
            F.when(s > 0, F.array(F.lit("crown"), F.concat(F.lit("tooth "), F.col("s_nationkey")))).alias("restorative_needs"),
            F.when(s > 5000, F.array(F.lit("endodontics"), F.lit("orthodontics")))
            .when(s > 2000, F.array(F.lit("oral_surgery")))
            .alias("referral_needs"),
            F.when(s < 0, F.array(F.lit("extraction"))).alias("priority_treatments"),
        ).alias("examination"),
    )


@query("""
select s_suppkey, '6 months' as cleaning_frequency, 'yearly' as x_rays, 'as needed' as fluoride,
       case when s_acctbal > 0 then 'crown|tooth ' || s_nationkey else '' end as restorative_care,
       case when s_acctbal > 5000 then 'endodontics|orthodontics' when s_acctbal > 2000 then 'oral_surgery'
            else '' end as specialist_referrals,
       '12 months' as estimated_timeline, case when s_acctbal < 0 then 'extraction' else '' end as priority_procedures
from supplier
""")
def treatment_plans(spark: SparkSession, folder: str) -> DataFrame:
    plan = F.col("treatment_plan")
    return care.treatment_plan(_examined(spark, folder)).select(
        "s_suppkey",
        "treatment_plan.preventive_care.*",
        F.array_join(plan["restorative_care"], "|").alias("restorative_care"),
        F.array_join(plan["specialist_referrals"], "|").alias("specialist_referrals"),
        plan["estimated_timeline"].alias("estimated_timeline"),
        F.array_join(plan["priority_procedures"], "|").alias("priority_procedures"),
    )


@query("""
select s_suppkey, referral, 'referral visit' as task, 'imaging|surgery' as required
from (select s_suppkey, unnest(case when s_acctbal > 5000 then ['endodontics', 'orthodontics']
                                    when s_acctbal > 2000 then ['oral_surgery'] else [] end) as referral from supplier)
""")
def specialist_tasks(spark: SparkSession, folder: str) -> DataFrame:
    plans = care.treatment_plan(_examined(spark, folder)).select("s_suppkey", "treatment_plan.specialist_referrals")
    return scheduling.referral_tasks(plans, "referral visit", ["imaging", "surgery"]).select(
        "s_suppkey", "referral", "task", F.array_join("required_expertise", "|").alias("required")
    )


@query("""
select event_id, coalesce(json_extract_string(props, '$.k'), 'none') as k, 'none' as missing,
       case when json_extract_string(props, '$.absent') is null then true end as absent_is_null
from events
""")
def event_property_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Event properties as a map, with defaults for missing keys."""
    parsed = read_table(spark, folder, "events").select(
        "event_id", F.from_json("props", "map<string,string>").alias("props")
    )
    return parsed.select(
        "event_id",
        map_default("props", "k", F.lit("none")).alias("k"),
        map_default("props", "absent", F.lit("none")).alias("missing"),
        map_default("props", "absent").isNull().alias("absent_is_null"),
    )


@query("select p_partkey, p_size - 20 as c, 32 + trunc((p_size - 20) / 0.5556e0)::integer as f from part")
def part_temperatures(spark: SparkSession, folder: str) -> DataFrame:
    celsius = F.col("p_size") - 20
    return read_table(spark, folder, "part").select(
        "p_partkey", celsius.alias("c"), temperature_f(celsius).alias("f")
    )


def _seeded_sql(day: str, seed: int, low: int, high: int) -> str:
    text = f"'{seed}:' || {day}"
    word = f"('0x' || substr(md5(unhex(regexp_replace(hex({text}), '(..)', '\\100', 'g'))), 1, 8))::bigint"
    return f"({word} % {high - low} + {low})::integer"


_SUMMARIES = "['Freezing','Bracing','Chilly','Cool','Mild','Warm','Balmy','Hot','Sweltering','Scorching']"
FORECASTS_SQL = f"""
  select date, {_seeded_sql('date', 42, -20, 55)} as temperature_c, {_SUMMARIES}[{_seeded_sql('date', 43, 1, 11)}] as summary
  from (select distinct o_orderdate::date as date from orders)
"""


def _forecasts(spark: SparkSession, folder: str) -> DataFrame:
    days = read_table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    return forecasts(days, "day")


@query(f"""
select *, 32 + trunc(temperature_c / 0.5556e0)::integer as temperature_f from ({FORECASTS_SQL})
""")
def forecasts_of_order_days(spark: SparkSession, folder: str) -> DataFrame:
    return _forecasts(spark, folder).withColumn("temperature_f", temperature_f("temperature_c"))


def _forecast_files(spark: SparkSession, folder: str) -> str:
    """Forecasts written as JSON arrays, one per month, with null items among them."""
    rows = _forecasts(spark, folder)
    item = F.to_json(F.struct("date", "temperature_c", "summary"))
    arrays = rows.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    path = scratch_path(spark, "forecasts")
    text = F.concat(F.lit("[null,"), F.array_join("items", ","), F.lit(",null]"))
    # A text partition per month gives one array per file.
    arrays.select("month", text.alias("value")).write.partitionBy("month").text(path)
    return path


@query(FORECASTS_SQL)
def forecast_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Forecasts read back from JSON arrays without their null items."""
    return read_json_array(spark, _forecast_files(spark, folder), FORECAST_SCHEMA)


@query("""
select o_orderdate::date as date, count(*) as orders, max(o_totalprice) as largest, min(o_orderpriority) as first_priority
from orders group by all
""")
def order_days_of_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Days of the orders, written as a JSON array a year with null items among them, and read back by ranges of a few days."""
    days = read_table(spark, folder, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("largest"), F.min("o_orderpriority").alias("first_priority")
    )
    item = F.to_json(F.struct("date", "orders", "largest", "first_priority"))
    arrays = days.groupBy(F.year("date").alias("year")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    path = scratch_path(spark, "order-days")
    text = F.concat(F.lit("[null,"), F.array_join("items", ", "), F.lit(",null]"))
    arrays.select("year", text.alias("value")).write.partitionBy("year").text(path)
    schema = "date date, orders bigint, largest double, first_priority string"
    return read_json_array_ranges(spark, path, schema, range_bytes=2048)


@query(f"select * from ({FORECASTS_SQL}) order by date limit 10")
def first_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    return read_json_array_stream(spark, _forecast_files(spark, folder), FORECAST_SCHEMA, 10, ["date"])


@query("""
select o_orderkey, month(o_orderdate)::integer as month, o_orderdate::date + 5 as due, o_orderkey & 255 as low_bits,
       o_orderkey >> 4 as shifted, (o_custkey << 3) as widened, round(ln(o_totalprice), 6) as log_price,
       floor(o_totalprice)::bigint as whole, round(o_totalprice, 0) as rounded, abs(5000 - o_custkey) as distance,
       greatest(o_orderkey, o_custkey) as larger, pow(2e0, o_custkey % 10) as power
from orders
""")
def order_arithmetic(spark: SparkSession, folder: str) -> DataFrame:
    """Bit, rounding and date arithmetic."""
    key, customer, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    return read_table(spark, folder, "orders").select(
        "o_orderkey",
        F.month("o_orderdate").alias("month"),
        F.date_add("o_orderdate", 5).alias("due"),
        key.bitwiseAND(255).alias("low_bits"),
        F.shiftright(key, 4).alias("shifted"),
        F.shiftleft(customer, 3).alias("widened"),
        F.round(F.ln(price), 6).alias("log_price"),
        F.floor(price).alias("whole"),
        F.round(price, 0).alias("rounded"),
        F.abs(F.lit(5000) - customer).alias("distance"),
        F.greatest(key, customer).alias("larger"),
        F.pow(F.lit(2.0), customer % 10).alias("power"),
    )
