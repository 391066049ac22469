"""The operators' inputs, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.functions.values import tag_datetime, tag_int, tag_other, tag_string
from tallyloom.operators.batching import merge_streams
from tallyloom.sources.files import read_table

# Frequencies by the last digit of the part key, half of them well-formed.
FREQUENCIES = [
    "twice daily", "3 times per day", "every 8 hours", "as needed", "often",
    "Once Daily", "with meals", "four times daily", "now and then", "1 time daily",
]


def user_events(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as ``event_id, user_id, event_timestamp`` and their status as ``kind``."""
    return read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("event_id"),
        F.concat(F.lit("user_"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.col("o_orderdate").alias("event_timestamp"),
        F.col("o_orderstatus").alias("kind"),
    )


def _record(prefix: str, key: str, value: Column) -> list[Column]:
    return [F.concat(F.lit(prefix), F.col(key).cast("string")).alias("id"), value.alias("value")]


def order_records(orders: DataFrame) -> DataFrame:
    """Int, datetime, decimal and out-of-range int payloads of orders; batch or stream."""
    near_limit = F.when(
        F.col("o_orderpriority") == "1-URGENT", F.lit((1 << 31) - 1) - F.col("o_custkey")
    ).otherwise(F.col("o_custkey") - 1)
    return orders.select(
        F.explode(
            F.array(
                F.struct(*_record("customer-", "o_orderkey", tag_int("o_custkey"))),
                F.struct(*_record("limit-", "o_orderkey", tag_int(near_limit))),
                F.struct(*_record("date-", "o_orderkey", tag_datetime("o_orderdate"))),
                F.struct(
                    *_record("price-", "o_orderkey", tag_other(F.col("o_totalprice").cast("decimal(18,2)").cast("string")))
                ),
            )
        ).alias("_record")
    ).select("_record.*")


def part_records(part: DataFrame) -> DataFrame:
    """Text payloads with white space around them."""
    padded = F.concat(F.lit(" \t"), F.col("p_name"), F.lit("\u00a0\n"))
    return part.select(*_record("part-", "p_partkey", tag_string(padded)))


def customer_records(customer: DataFrame) -> DataFrame:
    """Text payloads that are null for customers in debt."""
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    return customer.select(*_record("segment-", "c_custkey", tag_string(segment)))


def typed_records(spark: SparkSession, folder: str) -> DataFrame:
    """``id, value`` rows of every payload kind."""
    return merge_streams(
        part_records(read_table(spark, folder, "part")),
        order_records(read_table(spark, folder, "orders")),
        customer_records(read_table(spark, folder, "customer")),
    )


TYPED_RECORDS_SQL = """
  select 'part-' || p_partkey as id, 'string' as kind, ' ' || chr(9) || p_name || chr(160) || chr(10) as s,
         null::integer as i, null::timestamp as ts, p_name as clean from part
  union all select 'customer-' || o_orderkey, 'int', null, o_custkey::integer, null, null from orders
  union all select 'limit-' || o_orderkey, 'int', null,
         (case when o_orderpriority = '1-URGENT' then 2147483647 - o_custkey else o_custkey - 1 end)::integer,
         null, null from orders
  union all select 'date-' || o_orderkey, 'datetime', null, null, o_orderdate, null from orders
  union all select 'price-' || o_orderkey, 'other', o_totalprice::decimal(18,2)::varchar, null, null, null from orders
  union all select 'segment-' || c_custkey, case when c_acctbal >= 0 then 'string' end,
         case when c_acctbal >= 0 then c_mktsegment end, null, null, c_mktsegment from customer
"""
"""The same rows in SQL, with the trimmed text of string payloads as ``clean``."""

RESULTS_SQL = f"""
  select id, kind, s, i, ts,
         case when kind = 'string' then upper(clean) else s end as new_s,
         case when kind = 'int' then coalesce(try_cast(i::bigint * 2 as integer), i) end as new_i,
         ts as new_ts,
         case when kind is null then 'Data cannot be null'
              when kind = 'int' and try_cast(i::bigint * 2 as integer) is null
              then 'Transformation error: number out of range' end as error
  from ({TYPED_RECORDS_SQL})
"""
"""The transformed records in SQL; the zone of the check is UTC."""


def dosages(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as dosage rows, some with bad codes, strengths and frequencies."""
    key = F.col("p_partkey")
    unit = (
        F.when(F.col("p_type") == "ECONOMY", " mg")
        .when(F.col("p_type") == "STANDARD", "MCG")
        .when(F.col("p_type") == "PROMO", "%")
        .otherwise(" pieces")
    )
    code = F.lpad((key * 7919).cast("string"), 11, "0")
    return read_table(spark, folder, "part").select(
        F.when(F.col("p_size") > 48, F.concat(code, F.lit("0")))
        .when(F.col("p_size") > 46, F.concat(F.lit("X"), F.substring(code, 2, 10)))
        .otherwise(code)
        .alias("ndc11"),
        F.col("p_name").alias("drug_name"),
        F.concat(F.col("p_size").cast("string"), unit).alias("strength"),
        F.col("p_type").alias("dosage_form"),
        F.col("p_brand").alias("route"),
        F.col("p_size").cast("float").alias("quantity"),
        F.lit("tablets").alias("unit"),
        F.element_at(F.array(*[F.lit(text) for text in FREQUENCIES]), (F.pmod(key, F.lit(10)) + 1).cast("int")).alias(
            "frequency"
        ),
    )


_FREQUENCY_LIST = ", ".join(f"'{text}'" for text in FREQUENCIES)
DOSAGES_SQL = f"""
  select case when p_size > 48 then lpad((p_partkey * 7919)::varchar, 11, '0') || '0'
              when p_size > 46 then 'X' || substr(lpad((p_partkey * 7919)::varchar, 11, '0'), 2, 10)
              else lpad((p_partkey * 7919)::varchar, 11, '0') end as ndc11,
         p_name as drug_name,
         p_size || case p_type when 'ECONOMY' then ' mg' when 'STANDARD' then 'MCG' when 'PROMO' then '%'
                   else ' pieces' end as strength,
         p_type as dosage_form, p_brand as route, p_size::float as quantity, 'tablets' as unit,
         ([{_FREQUENCY_LIST}])[p_partkey % 10 + 1] as frequency
  from part
"""


def labelers(spark: SparkSession, folder: str) -> DataFrame:
    """Known labelers: the even numbers below twice the supplier count."""
    return read_table(spark, folder, "supplier").select(
        F.lpad((F.col("s_suppkey") * 2).cast("string"), 5, "0").alias("labeler")
    )


LABELERS_SQL = "select lpad((s_suppkey * 2)::varchar, 5, '0') as labeler from supplier"

_REGION, _NATION, _SUPPLIER, _CUSTOMER = range(4)
_KINDS = 4
_EDGE_KINDS = 8


def _node_id(kind: int, key: str) -> Column:
    return F.col(key).cast("bigint") * _KINDS + kind


def care_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Regions, nations, suppliers and customers as labelled nodes."""

    def rows(table: str, kind: int, key: str, name: str, label: str) -> DataFrame:
        return read_table(spark, folder, table).select(
            _node_id(kind, key).alias("id"),
            F.array(F.lit(label)).alias("labels"),
            F.create_map(F.lit("name"), F.col(name)).alias("props"),
        )

    return merge_streams(
        rows("region", _REGION, "r_regionkey", "r_name", "IDN"),
        rows("nation", _NATION, "n_nationkey", "n_name", "Hospital"),
        rows("supplier", _SUPPLIER, "s_suppkey", "s_name", "PhysicianGroup"),
        rows("customer", _CUSTOMER, "c_custkey", "c_name", "Clinic"),
    )


def care_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Typed edges between them, with unique ids."""
    nation = read_table(spark, folder, "nation")
    supplier = read_table(spark, folder, "supplier")
    customer = read_table(spark, folder, "customer")
    region_of = nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    nations = nation.count()

    def edge(kind: int, key: str, src: Column, edge_type: str, dst: Column) -> Column:
        return F.struct(
            (F.col(key).cast("bigint") * _EDGE_KINDS + kind).alias("edge_id"),
            src.alias("src"),
            dst.alias("dst"),
            F.lit(edge_type).alias("type"),
        )

    def rows(df: DataFrame, *edges: Column) -> DataFrame:
        return df.select(F.explode(F.array(*edges)).alias("_edge")).select("_edge.*")

    here, clinic = _node_id(_NATION, "n_nationkey"), _node_id(_CUSTOMER, "c_custkey")
    region, group = _node_id(_REGION, "n_regionkey"), _node_id(_SUPPLIER, "s_suppkey")
    neighbour = F.pmod(F.col("n_nationkey").cast("bigint") + 1, F.lit(nations)) * _KINDS + _NATION
    return merge_streams(
        rows(
            nation,
            edge(0, "n_nationkey", region, "OPERATES", here),
            edge(1, "n_nationkey", here, "PRIVILEGES_AT", region),
            edge(2, "n_nationkey", here, "CONTRACTS_WITH", region),
            edge(3, "n_nationkey", here, "REFERS_TO", neighbour),
        ),
        customer.select(edge(4, "c_custkey", _node_id(_NATION, "c_nationkey"), "OPERATES", clinic).alias("_edge")).select(
            "_edge.*"
        ),
        rows(
            supplier.join(region_of, "s_nationkey"),
            edge(5, "s_suppkey", group, "MEMBER_OF", _node_id(_NATION, "s_nationkey")),
            edge(6, "s_suppkey", group, "PURCHASES_FROM", region),
        ),
    )


NODES_SQL = """
  select r_regionkey::bigint * 4 as id, 'IDN' as label, r_name as name from region
  union all select n_nationkey::bigint * 4 + 1, 'Hospital', n_name from nation
  union all select s_suppkey * 4 + 2, 'PhysicianGroup', s_name from supplier
  union all select c_custkey * 4 + 3, 'Clinic', c_name from customer
"""
EDGES_SQL = """
  select n_nationkey::bigint * 8 as edge_id, n_regionkey::bigint * 4 as src, n_nationkey::bigint * 4 + 1 as dst,
         'OPERATES' as type from nation
  union all select n_nationkey::bigint * 8 + 1, n_nationkey::bigint * 4 + 1, n_regionkey::bigint * 4,
         'PRIVILEGES_AT' from nation
  union all select n_nationkey::bigint * 8 + 2, n_nationkey::bigint * 4 + 1, n_regionkey::bigint * 4,
         'CONTRACTS_WITH' from nation
  union all select n_nationkey::bigint * 8 + 3, n_nationkey::bigint * 4 + 1,
         (n_nationkey::bigint + 1) % (select count(*) from nation) * 4 + 1, 'REFERS_TO' from nation
  union all select c_custkey * 8 + 4, c_nationkey::bigint * 4 + 1, c_custkey * 4 + 3, 'OPERATES' from customer
  union all select s_suppkey * 8 + 5, s_suppkey * 4 + 2, s_nationkey::bigint * 4 + 1, 'MEMBER_OF' from supplier
  union all select s_suppkey * 8 + 6, s_suppkey * 4 + 2, n_regionkey::bigint * 4, 'PURCHASES_FROM'
         from supplier join nation on s_nationkey = n_nationkey
"""
GRAPH_SQL = f"with nodes as ({NODES_SQL}), edges as ({EDGES_SQL})"


def appointments(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as appointments."""
    status = (
        F.when(F.col("o_orderstatus") == "F", "Completed").when(F.col("o_orderstatus") == "O", "Scheduled")
    ).otherwise("CheckedIn")
    return read_table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("patient_id"),
        F.col("o_orderdate").alias("date_time"),
        F.col("o_orderpriority").alias("procedure_type"),
        F.pmod("o_orderkey", F.lit(5)).cast("string").alias("dentist_id"),
        status.alias("status"),
    )


APPOINTMENTS_SQL = """
  select o_orderkey::varchar as id, o_custkey::varchar as patient_id, o_orderdate as date_time,
         o_orderpriority as procedure_type, (o_orderkey % 5)::varchar as dentist_id,
         case o_orderstatus when 'F' then 'Completed' when 'O' then 'Scheduled' else 'CheckedIn' end as status
  from orders
"""

STAGE_BY_LINE = [
    "CheckedIn", "InsuranceVerified", "AssessmentCompleted", "TreatmentCompleted",
    "FollowUpScheduled", "Completed", "Cancelled",
]


def stage_events(lineitem: DataFrame) -> DataFrame:
    """Line items as stage reports of the appointment with their order key; batch or stream."""
    stages = F.array(*[F.lit(stage) for stage in STAGE_BY_LINE])
    return lineitem.select(
        F.col("l_orderkey").cast("string").alias("appointment_id"),
        F.col("l_suppkey").cast("string").alias("patient_id"),
        F.element_at(stages, F.col("l_linenumber")).alias("status"),
        F.col("l_shipdate").alias("event_time"),
    )


_STAGE_LIST = ", ".join(f"'{stage}'" for stage in STAGE_BY_LINE)
STAGE_EVENTS_SQL = f"""
  select l_orderkey::varchar as appointment_id, l_suppkey::varchar as patient_id,
         ([{_STAGE_LIST}])[l_linenumber] as status, l_shipdate as event_time from lineitem
"""


def bookings(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as 45-minute bookings of five rooms, on a half-hour grid from midnight."""
    key = F.col("o_orderkey")
    slot = F.call_function("div", key, F.lit(5).cast("bigint")) % 16
    start = F.col("o_orderdate") + F.make_dt_interval(mins=(slot * 30).cast("int"))
    return read_table(spark, folder, "orders").select(
        key.alias("id"),
        F.pmod(key, F.lit(5)).cast("string").alias("room_id"),
        F.pmod(key, F.lit(5)).cast("string").alias("dentist_id"),
        start.alias("start"),
        (start + F.expr("INTERVAL '45' MINUTE")).alias("end"),
    )


BOOKINGS_SQL = """
  select o_orderkey as id, (o_orderkey % 5)::varchar as room_id, (o_orderkey % 5)::varchar as dentist_id,
         o_orderdate + to_minutes((o_orderkey // 5) % 16 * 30) as "start",
         o_orderdate + to_minutes((o_orderkey // 5) % 16 * 30 + 45) as "end"
  from orders
"""


def preferences(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their preferences as JSON text; keys are left out, not null."""
    fields = {
        "preferred_treatment_approach": F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")),
        "comfort_priorities": F.when(F.col("c_nationkey") < 20, F.array(F.lit("Home care"), F.col("c_mktsegment"))),
        "scheduling_needs": F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit("slot "), F.col("c_nationkey"))),
        "interested_in_research": F.when(F.col("c_acctbal") > 1000, F.col("c_nationkey") > 10),
    }
    return read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("patient_id"),
        F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()])).alias("body"),
    )


PREFERENCES_SQL = """
  select c_custkey as patient_id, case when c_acctbal >= 0 then c_mktsegment end as approach,
         case when c_nationkey < 20 then 'Home care|' || c_mktsegment end as comfort,
         case when c_mktsegment <> 'BUILDING' then 'slot ' || c_nationkey end as scheduling,
         case when c_acctbal > 1000 then c_nationkey > 10 end as interested
  from customer
"""
