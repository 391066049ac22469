"""Distinct-count queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.functions.cardinality import register_hll_functions
from tallyloom.functions.hashing import hash31_poly, hash32_md5, hash32_sha256
from tallyloom.functions.values import day_filter, month_filter
from tallyloom.operators import sketch, sketch_state
from tallyloom.plans.inputs import user_events
from tallyloom.plans.registry import query
from tallyloom.session import materialize, scratch_path
from tallyloom.sources.files import (
    ESTIMATE_REQUEST_SCHEMA,
    USER_EVENTS_SCHEMA,
    event_table_scan,
    parse_json_requests,
    read_table,
)


def sql_hash(element: str) -> str:
    """The sketch's hash of a text expression, in SQL."""
    digest = f"sha256({element})"
    swapped = " || ".join(f"substr({digest}, {at}, 2)" for at in (7, 5, 3, 1))
    return f"('0x' || {swapped})::bigint"


def sql_hash64(element: str) -> str:
    """The 64-bit hash of a text expression, in SQL."""
    digest = f"sha256({element})"
    swapped = " || ".join(f"substr({digest}, {at}, 2)" for at in (15, 13, 11, 9, 7, 5, 3, 1))
    return f"('0x' || {swapped})::ubigint"


def sql_registers(source: str, element: str, precision: int, by: str = "", wide: bool = False) -> str:
    """Registers in SQL: ``by, bucket, rank`` of ``source``; ``wide`` takes the 64-bit hash."""
    keys = f"{by}, " if by else ""
    window = (64 if wide else 32) - precision
    return f"""
      select {keys}h & {(1 << precision) - 1} as bucket,
             max(case when h >> {precision} = 0 then {window + 1}
                      else {window} - length(bin(h >> {precision})) + 1 end)::integer as rank
      from (select {keys}{(sql_hash64 if wide else sql_hash)(element)} as h from {source} where {element} is not null)
      group by all"""


def sql_estimate(registers: str, precision: int, by: str = "", wide: bool = False) -> str:
    """``by, zeros, raw, estimate`` in SQL, from registers; those of the 64-bit hash have no upper range."""
    upper = "" if wide else "when raw > 4294967296e0 / 30 then -4294967296e0 * ln(1 - raw / 4294967296e0)"
    m = 1 << precision
    keys = f"{by}, " if by else ""
    alpha = f"(0.7213e0 / (1.0e0 + 1.079e0 / {m}) * {m}e0 * {m}e0)"
    return f"""
      select {keys}zeros, raw,
             trunc(case when raw <= 2.5 * {m} and zeros > 0 then {m}e0 * ln({m}e0 / zeros)
                        {upper}
                        when raw is null then 0 else raw end)::bigint as estimate
      from (select {keys}{m} - count(*) as zeros,
                   {alpha} / (sum(pow(2e0, -rank)) + {m} - count(*)) as raw
            from ({registers}) group by all)"""


EVENTS = "(select 'user_' || o_custkey as user_id, o_orderstatus as kind, o_orderdate as ts from orders)"


@query(f"select kind, bucket::integer as bucket, rank from ({sql_registers(EVENTS, 'user_id', 12, 'kind')})")
def hll_registers_by_kind(spark: SparkSession, folder: str) -> DataFrame:
    built = sketch.hll_build(user_events(spark, folder), "user_id", 12, ["kind"])
    return built.select("kind", "bucket", "rank")


@query("""
select l_returnflag, bucket::integer as bucket, max(case when above = 0 then 51 else 51 - length(bin(above)) end)::integer as rank
from (select l_returnflag, h & 16383 as bucket, h >> 14 as above
      from (select l_returnflag, """ + sql_hash64("l_orderkey::varchar") + """ as h from lineitem))
group by all
""")
def hll_registers_of_64_bits(spark: SparkSession, folder: str) -> DataFrame:
    """Registers of the 64-bit hash, which has no upper range, for the orders behind each return flag."""
    lines = read_table(spark, folder, "lineitem")
    built = sketch.hll_build(lines, "l_orderkey", 14, ["l_returnflag"], "sha256_64")
    return built.select("l_returnflag", "bucket", "rank")


@query(f"""
with registers as (
    select bucket, max(rank) as rank from (
        select h & 16383 as bucket, case when h >> 14 = 0 then 51 else 51 - length(bin(h >> 14)) end as rank
        from (select {sql_hash64("l_orderkey::varchar")} as h from lineitem)) group by 1),
sums as (select 16384 - count(*) as zeros,
                (0.7213e0 / (1.0e0 + 1.079e0 / 16384) * 16384e0 * 16384e0) / (sum(pow(2e0, -rank)) + 16384 - count(*)) as raw from registers)
select zeros, trunc(case when raw <= 2.5 * 16384 and zeros > 0 then 16384e0 * ln(16384e0 / zeros) else raw end)::bigint as estimate from sums
""")
def hll_estimate_of_64_bits(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct orders over all line items, from the sketches per return flag, merged on the way."""
    built = sketch.hll_build(read_table(spark, folder, "lineitem"), "l_orderkey", 14, ["l_returnflag"], "sha256_64")
    return sketch.hll_estimate(built, hash_name="sha256_64").select("zeros", "estimate")


@query("""
select o_orderstatus, bucket::integer as bucket, max(case when above = 0 then 21 else 21 - length(bin(above)) end)::integer as rank
from (select o_orderstatus, h & 4095 as bucket, h >> 12 as above
      from (select o_orderstatus, ('0x' || substr(md5(from_hex(array_to_string(
                list_transform(string_split(o_custkey::varchar, ''), lambda c: '3' || c || '00'), ''))), 1, 8))::bigint as h from orders))
group by all
""")
def hll_registers_of_md5(spark: SparkSession, folder: str) -> DataFrame:
    """Registers of the MD5 hash, for sketches that are stored with it; digits in UTF-16 are 3x00."""
    built = sketch.hll_build(read_table(spark, folder, "orders"), "o_custkey", 12, ["o_orderstatus"], "md5")
    return built.select("o_orderstatus", "bucket", "rank")


STATUS_EVENTS = "(select o_custkey::varchar as user_id, o_orderstatus from orders)"


@query(f"""
select e.o_orderstatus, 12 as precision, zeros, round(raw, 6) as raw, estimate, exact
from ({sql_estimate(sql_registers(STATUS_EVENTS, 'user_id', 12, 'o_orderstatus'), 12, 'o_orderstatus')}) e
join (select o_orderstatus, count(distinct o_custkey) as exact from orders group by 1) x using (o_orderstatus)
""")
def hll_estimate_by_status(spark: SparkSession, folder: str) -> DataFrame:
    by = ["o_orderstatus"]
    customers = sketch.distinct_elements(read_table(spark, folder, "orders"), "o_custkey", by)
    return sketch.exact_and_estimate(customers, 12, by).select(
        *by, F.lit(12).alias("precision"), "zeros", F.round("raw", 6).alias("raw"), "estimate", "exact"
    )


PART_EVENTS = "(select l_partkey::varchar as user_id, l_returnflag from lineitem)"


@query(sql_estimate(sql_registers(PART_EVENTS, "user_id", 14), 14).replace("zeros, raw,", "", 1))
def hll_estimate_whole_table(spark: SparkSession, folder: str) -> DataFrame:
    built = sketch.hll_build(read_table(spark, folder, "lineitem"), "l_partkey", 14)
    return sketch.hll_estimate(built).select("estimate")


@query(sql_estimate(sql_registers(EVENTS, "user_id", 12), 12).replace("zeros, raw,", "zeros,", 1))
def hll_merge_kinds(spark: SparkSession, folder: str) -> DataFrame:
    by_kind = sketch.hll_build(user_events(spark, folder), "user_id", 12, ["kind"])
    return sketch.hll_estimate(sketch.hll_merge([by_kind])).select("zeros", "estimate")


QUARTER_EVENTS = (
    "(select 'user_' || o_custkey as user_id, date_trunc('quarter', o_orderdate)::date as quarter from orders)"
)


@query(sql_estimate(sql_registers(QUARTER_EVENTS, "user_id", 12, "quarter"), 12, "quarter").replace("zeros, raw,", "", 1))
def hll_rollup_quarters(spark: SparkSession, folder: str) -> DataFrame:
    months = sketch.visitor_sketches(user_events(spark, folder), "user_id", "event_timestamp", "month", 12)
    quarter = F.date_trunc("quarter", "period").cast("date")
    quarters = sketch.hll_rollup(months, {"quarter": quarter})
    return sketch.hll_estimate(quarters, ["quarter"]).select("quarter", "estimate")


@query(f"""
select kind, case when kind = 'F' then 4096 else zeros end as zeros,
       case when kind = 'F' then 0 else estimate end as estimate
from ({sql_estimate(sql_registers(EVENTS, 'user_id', 12, 'kind'), 12, 'kind')})
""")
def hll_clear_kind(spark: SparkSession, folder: str) -> DataFrame:
    events = user_events(spark, folder)
    by_kind = materialize(sketch.hll_build(events, "user_id", 12, ["kind"]), "registers")
    done = events.where(F.col("kind") == "F").select("kind")
    cleared = sketch.hll_clear(by_kind, ["kind"], done)
    return sketch.hll_estimate(cleared, ["kind"]).select("kind", "zeros", "estimate")


@query(f"""
select kind, 12 as precision, exact as actual_unique_count, estimate as estimated_count,
       round(abs(exact - estimate) * 100.0e0 / exact, 6) as error_percentage, 4096::bigint as memory_used_bytes
from ({sql_estimate(sql_registers(EVENTS, 'user_id', 12, 'kind'), 12, 'kind')})
join (select kind, count(distinct user_id) as exact from {EVENTS} group by 1) using (kind)
""")
def exact_vs_estimate_by_kind(spark: SparkSession, folder: str) -> DataFrame:
    compared = sketch.exact_vs_estimate(user_events(spark, folder), "user_id", 12, ["kind"])
    return compared.withColumn("error_percentage", F.round("error_percentage", 6))


@query(f"""
select kind, exact as exact_count, estimate as custom_estimate, true as native_close, true as datasketches_close
from ({sql_estimate(sql_registers(EVENTS, 'user_id', 14, 'kind'), 14, 'kind')})
join (select kind, count(distinct user_id) as exact from {EVENTS} group by 1) using (kind)
""")
def compare_counts_by_kind(spark: SparkSession, folder: str) -> DataFrame:
    """Spark's own sketches have other registers; they are held to three standard errors."""
    counts = sketch.compare_counts(user_events(spark, folder), "user_id", 14, ["kind"])

    def close(estimate: str) -> Column:
        return F.abs(F.col(estimate) - F.col("exact_count")) <= F.lit(0.15) * F.col("exact_count")

    return counts.select(
        "kind",
        "exact_count",
        "custom_estimate",
        close("native_estimate").alias("native_close"),
        close("datasketches_estimate").alias("datasketches_close"),
    )


def _sweep_sql(precision: int, wide: bool = False) -> str:
    registers = sql_registers(PART_EVENTS, "user_id", precision, "l_returnflag", wide)
    return f"""
      select l_returnflag, {precision} as precision, {1 << precision}::bigint as buckets,
             {(1 << precision) / 1024}::double as memory_kb, exact_count, estimate,
             round(abs(exact_count - estimate) * 100.0e0 / exact_count, 6) as error_percentage
      from ({sql_estimate(registers, precision, 'l_returnflag', wide)})
      join (select l_returnflag, count(distinct l_partkey) as exact_count from lineitem group by 1)
      using (l_returnflag)"""


@query(" union all ".join(_sweep_sql(p) for p in (8, 10, 12, 14, 16)))
def precision_sweep_parts(spark: SparkSession, folder: str) -> DataFrame:
    swept = sketch.precision_sweep(read_table(spark, folder, "lineitem"), "l_partkey", by=["l_returnflag"])
    return swept.withColumn("error_percentage", F.round("error_percentage", 6))


@query(" union all ".join(_sweep_sql(p, True) for p in (8, 10, 12, 14, 16)))
def precision_sweep_of_64_bits(spark: SparkSession, folder: str) -> DataFrame:
    """The same at 64 bits: all precisions folded from the finest."""
    lines = read_table(spark, folder, "lineitem")
    swept = sketch.precision_sweep(lines, "l_partkey", by=["l_returnflag"], hash_name="sha256_64")
    return swept.withColumn("error_percentage", F.round("error_percentage", 6))


@query(f"""
select kind, 12 as precision, exact as actual_unique_count, estimate as estimated_count,
       round(abs(exact - estimate) * 100.0e0 / exact, 6) as error_percentage, 4096::bigint as memory_used_bytes
from ({sql_estimate(sql_registers(EVENTS, 'user_id', 12, 'kind', True), 12, 'kind', True)})
join (select kind, count(distinct user_id) as exact from {EVENTS} group by 1) using (kind)
""")
def exact_vs_estimate_of_64_bits(spark: SparkSession, folder: str) -> DataFrame:
    compared = sketch.exact_vs_estimate(user_events(spark, folder), "user_id", 12, ["kind"], "sha256_64")
    return compared.withColumn("error_percentage", F.round("error_percentage", 6))


def _size_sql(share: int) -> str:
    total = "(select count(*) from orders)"
    source = f"(select 'user_' || o_orderkey as element from orders where o_orderkey < {total} // {share})"
    return f"""
      select {total} // {share} as size, estimate,
             round(abs({total} // {share} - estimate) * 100.0e0 / ({total} // {share}), 6) as error_percentage
      from ({sql_estimate(sql_registers(source, 'element', 14), 14)})"""


@query(" union all ".join(_size_sql(share) for share in (1, 10, 100)))
def size_sweep_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The first hundredth, tenth and whole of the orders, from one scan."""
    orders = read_table(spark, folder, "orders")
    total = orders.count()
    element = F.concat(F.lit("user_"), F.col("o_orderkey").cast("string"))
    swept = sketch.size_sweep(orders, element, "o_orderkey", [total, total // 10, total // 100])
    return swept.withColumn("error_percentage", F.round("error_percentage", 6))


@query("""
select l_returnflag, n as elements, n * 48 as exact_bytes, 16384::bigint as sketch_bytes,
       round((1 - 16384e0 / (n * 48)) * 100, 6) as saving_percentage
from (select l_returnflag, count(distinct l_partkey) as n from lineitem group by 1)
""")
def memory_comparison_parts(spark: SparkSession, folder: str) -> DataFrame:
    compared = sketch.memory_comparison(read_table(spark, folder, "lineitem"), "l_partkey", by=["l_returnflag"])
    return compared.withColumn("saving_percentage", F.round("saving_percentage", 6))


DAY_EVENTS = "(select 'user_' || o_custkey as user_id, o_orderdate::date as period from orders)"


@query(
    sql_estimate(sql_registers(DAY_EVENTS, "user_id", 12, "period"), 12, "period")
    .replace("zeros, raw,", "", 1)
    .replace("as estimate", "as unique_visitors")
)
def unique_visitors_by_day(spark: SparkSession, folder: str) -> DataFrame:
    return sketch.unique_visitors(user_events(spark, folder), "user_id", "event_timestamp", "day", 12)


WEEKS = """(select 'user_' || o_custkey as user_id, date_trunc('week', o_orderdate)::date as week from orders)"""
WEEK_PAIRS = f"""(
  select user_id, week as period from {WEEKS}
  union all select user_id, week - 7 from {WEEKS} where week - 7 in (select week from {WEEKS}))"""


@query(
    sql_estimate(sql_registers(WEEK_PAIRS, "user_id", 12, "period"), 12, "period")
    .replace("zeros, raw,", "", 1)
    .replace("as estimate", "as unique_visitors")
)
def unique_visitors_two_weeks(spark: SparkSession, folder: str) -> DataFrame:
    """Each week merged with the one after it."""
    weeks = materialize(sketch.visitor_sketches(user_events(spark, folder), "user_id", "event_timestamp", "week", 12), "weeks")
    return sketch.next_period_union(weeks, "period", F.expr("INTERVAL 7 DAY"))


MONTH_EVENTS = """(select 'user_' || o_custkey as user_id,
  case when month(o_orderdate) = 1 then 'January' else 'February' end as period
  from orders where month(o_orderdate) in (1, 2))"""


@query(sql_estimate(sql_registers(MONTH_EVENTS, "user_id", 12, "period"), 12, "period").replace("zeros, raw,", "", 1))
def visitors_in_two_months(spark: SparkSession, folder: str) -> DataFrame:
    events = user_events(spark, folder)
    named = events.withColumn(
        "period",
        F.when(month_filter("event_timestamp", 1), "January").when(month_filter("event_timestamp", 2), "February"),
    ).where("period is not null")
    return sketch.hll_estimate(sketch.hll_build(named, "user_id", 12, ["period"]), ["period"]).select(
        "period", "estimate"
    )


ONE_DAY = "(select 'user_' || o_custkey as user_id from orders where o_orderdate::date = date '1998-07-01')"


@query(sql_estimate(sql_registers(ONE_DAY, "user_id", 14), 14).replace("zeros, raw,", "", 1))
def visitors_on_one_day(spark: SparkSession, folder: str) -> DataFrame:
    events = user_events(spark, folder).where(day_filter("event_timestamp", "1998-07-01"))
    return sketch.hll_estimate(sketch.hll_build(events, "user_id", 14)).select("estimate")


@query(sql_estimate(sql_registers(EVENTS, "user_id", 14), 14).replace("zeros, raw,", "", 1))
def event_table_estimate(spark: SparkSession, folder: str) -> DataFrame:
    """Estimate over an event table written to and read from Parquet."""
    path = scratch_path(spark, "user_events")
    columns = [part.split()[0] for part in USER_EVENTS_SCHEMA.split(",")]
    user_events(spark, folder).select(*columns).write.parquet(path)
    return sketch.hll_estimate(sketch.hll_build(event_table_scan(spark, path), "user_id", 14)).select("estimate")


def _kind_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Events with their kind as a sketch id: the letter's code."""
    return user_events(spark, folder).select(F.ascii("kind").alias("hll_id"), "user_id")


def _stored_state(spark: SparkSession, folder: str) -> DataFrame:
    """A state table with a sketch per kind and an untouched one, written and read back."""
    events = _kind_ids(spark, folder)
    ids = events.select("hll_id").unionByName(events.select((F.col("hll_id") + 100).alias("hll_id")))
    first = F.to_timestamp_ntz(F.lit("2025-01-01 00:00:00"))
    second = F.to_timestamp_ntz(F.lit("2025-01-02 00:00:00"))
    state = sketch_state.init_sketch(sketch_state.empty_state(spark), ids, 12, first)
    delta = sketch.hll_build(events, "user_id", 12, ["hll_id"])
    path = scratch_path(spark, "hll_state")
    sketch_state.upsert_sketch(state, delta, second).write.parquet(path)
    return spark.read.schema(sketch_state.STATE_SCHEMA).parquet(path)


@query(f"""
select ascii(kind) as hll_id, bucket::integer as bucket, rank
from ({sql_registers(EVENTS, 'user_id', 12, 'kind')})
""")
def sketch_state_registers(spark: SparkSession, folder: str) -> DataFrame:
    """Registers after initialising, upserting, packing, writing, reading and unpacking."""
    unpacked = sketch.unpack_registers(_stored_state(spark, folder), ["hll_id"])
    return unpacked.where("rank > 0").select("hll_id", "bucket", "rank")


@query("""
select distinct ascii(o_orderstatus) + d as hll_id, 4096 as bytes, timestamp '2025-01-01' as created_date,
       case when d = 0 then timestamp '2025-01-02' else timestamp '2025-01-01' end as last_updated_date
from orders, (values (0), (100)) v(d)
""")
def sketch_state_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Only sketches with a grown register get a new update date."""
    return _stored_state(spark, folder).select(
        "hll_id", F.length("buckets").alias("bytes"), "created_date", "last_updated_date"
    )


@query(f"""
select o_custkey, coalesce(estimate, 0) as estimate
from (select distinct o_custkey from orders)
left join (select ascii(kind) as hll_id, estimate
           from ({sql_estimate(sql_registers(EVENTS, 'user_id', 12, 'kind'), 12, 'kind')})) on hll_id = o_custkey
""")
def estimate_cardinality_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Stored estimates looked up by id; most ids have no sketch."""
    wanted = read_table(spark, folder, "orders").select(F.col("o_custkey").alias("hll_id")).distinct()
    found = sketch_state.estimate_cardinality(materialize(_stored_state(spark, folder), "state"), wanted)
    return found.select(F.col("hll_id").alias("o_custkey"), "estimate")


@query(f"""
select ascii(kind) as hll_id, estimate
from ({sql_estimate(sql_registers(EVENTS, 'user_id', 12, 'kind'), 12, 'kind')})
""")
def estimates_view(spark: SparkSession, folder: str) -> DataFrame:
    """Stored estimates read through SQL."""
    view = sketch_state.register_estimates_view(_stored_state(spark, folder))
    return spark.sql(f"SELECT hll_id, estimate FROM {view} WHERE estimate > 0")


_WIDE_STATE = sql_registers("(select l_partkey::varchar as user_id, ascii(l_returnflag) as hll_id from lineitem)", "user_id", 14, "hll_id", True)


@query(f"""
select hll_id, 'sha256_64' as hash, case when 3 * n < 16384 then 'sparse' else 'dense' end as encoding,
       (case when 3 * n < 16384 then 3 * n else 16384 end)::integer as bytes, estimate
from (select hll_id, count(*) as n from ({_WIDE_STATE}) group by 1) join ({sql_estimate(_WIDE_STATE, 14, "hll_id", True)}) using (hll_id)
""")
def stored_sketches_of_64_bits(spark: SparkSession, folder: str) -> DataFrame:
    """Sketches that were stored sparse where that is shorter, filled in two steps, written, read and estimated as what they say they are."""
    parts = read_table(spark, folder, "lineitem").select(F.ascii("l_returnflag").alias("hll_id"), F.col("l_partkey").alias("part"))
    state = sketch_state.init_sketch(sketch_state.empty_state(spark), parts, 14, hash_name="sha256_64", encoding=sketch.SPARSE)
    for rest in (0, 1):
        delta = sketch.hll_build(parts.where(F.col("part") % 2 == rest), "part", 14, ["hll_id"], "sha256_64")
        state = materialize(sketch_state.upsert_sketch(state, delta), "state_of_64_bits")
    estimates = sketch_state.hll_estimates(state)
    return state.select("hll_id", "hash", "encoding", F.length("buckets").alias("bytes")).join(estimates, "hll_id")


_MERGED = EVENTS.replace("o_orderstatus as kind", "case when o_orderstatus = 'P' then 'O' else o_orderstatus end as kind")


@query(f"""
select ascii(kind) as hll_id, estimate from ({sql_estimate(sql_registers(_MERGED, 'user_id', 12, 'kind'), 12, 'kind')})
union all
select ascii(kind), estimate from ({sql_estimate(sql_registers(EVENTS, 'user_id', 12, 'kind'), 12, 'kind')}) where kind = 'P'
""")
def stored_merge_of_kinds(spark: SparkSession, folder: str) -> DataFrame:
    """One stored sketch merged into another; the source stays."""
    merged = sketch_state.merge_into(_stored_state(spark, folder), ord("O"), ord("P"))
    return sketch_state.hll_estimates(materialize(merged, "merged_state")).where("estimate > 0")


@query(f"""
select o_orderkey, h as hash, case when h >> 12 = 0 then 20 else 20 - length(bin(h >> 12)) end as zeros,
       round(0.7213e0 / (1 + 1.079e0 / 4096) * 4096e0 * 4096e0, 3) as alpha
from (select o_orderkey, {sql_hash("o_custkey::varchar")} as h from orders)
""")
def sql_functions_on_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The SQL-callable functions."""
    register_hll_functions(spark)
    read_table(spark, folder, "orders").createOrReplaceTempView("tallyloom_orders")
    return spark.sql("""
        SELECT o_orderkey, hash, count_leading_zeros(hash >> 12, 20) AS zeros,
               round(get_alpha_constant(4096), 3) AS alpha
        FROM (SELECT o_orderkey, compute_hash(CAST(o_custkey AS STRING)) AS hash FROM tallyloom_orders)
    """)


POLY_SQL = (
    "list_reduce(list_transform(string_split(text, ''), lambda x: unicode(x)::bigint),"
    " lambda a, b: (a * 31 + b) & 4294967295, 0::bigint)"
)


@query(f"""
select doc_id, {sql_hash("text")} as sha, abs(case when p >= 2147483648 then p - 4294967296 else p end) as poly
from (select doc_id, text, {POLY_SQL} as p from documents)
""")
def text_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """Hashes of whole document texts."""
    return read_table(spark, folder, "documents").select(
        "doc_id", hash32_sha256("text").alias("sha"), hash31_poly("text").alias("poly")
    )


@query("""
select c_custkey, case when h >= 2147483648 then h - 4294967296 else h end as hash
from (select c_custkey,
             ('0x' || substr(md5(unhex(regexp_replace(hex(c_name), '(..)', '\\100', 'g'))), 1, 8))::bigint as h
      from customer)
""")
def md5_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """The MD5 hash over two-byte text of customer names."""
    return read_table(spark, folder, "customer").select("c_custkey", hash32_md5("c_name").alias("hash"))


REQUEST_PRECISION = {"de": 10, "en": 12, "es": 3}
WORDS = """(select 'doc-' || doc_id as request_id, lang, unnest(string_split(text, ' ')) as word from documents)"""


def _request_sql(lang: str, precision: int) -> str:
    picked = f"(select request_id, word from {WORDS} where lang = '{lang}')"
    return f"""
      select request_id, {precision} as precision, null::varchar as error, exact as actual_unique_count,
             estimate as estimated_count, round(abs(exact - estimate) * 100.0e0 / exact, 6) as error_percentage,
             {1 << precision}::bigint as memory_used_bytes
      from ({sql_estimate(sql_registers(picked, 'word', precision, 'request_id'), precision, 'request_id')})
      join (select request_id, count(distinct word) as exact from {picked} group by 1) using (request_id)"""


@query(f"""
{_request_sql('de', 10)} union all {_request_sql('en', 12)} union all {_request_sql('fr', 14)}
union all select 'doc-' || doc_id, 3, 'Precision must be between 4 and 16', null, null, null, null
from documents where lang = 'es'
""")
def estimate_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's words as a JSON request; precision by language, one of them not allowed."""
    precision = F.lit(None).cast("int")
    for lang, value in REQUEST_PRECISION.items():
        precision = F.when(F.col("lang") == lang, F.lit(value)).otherwise(precision)
    bodies = read_table(spark, folder, "documents").select(
        F.to_json(
            F.struct(
                F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("request_id"),
                F.split("text", " ").alias("elements"),
                precision.alias("precision"),
            )
        ).alias("body")
    )
    answers = sketch.answer_requests(parse_json_requests(bodies, "body", ESTIMATE_REQUEST_SCHEMA))
    return answers.withColumn("error_percentage", F.round("error_percentage", 6))
