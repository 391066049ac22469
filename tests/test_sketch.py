"""Distinct-count sketches: the known answers and the laws of merging."""

from __future__ import annotations

import hashlib
import math
import time

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.cardinality import (
    alpha_mm,
    check_precision,
    checked_precision,
    corrected_estimate,
    error_pct,
    register_hll_functions,
)
from tallyloom.functions.hashing import count_leading_zeros, hash31_poly, hash32_md5, hash32_sha256
from tallyloom.operators import sketch, sketch_state
from tallyloom.session import materialize
from tallyloom.sources.records import numbered_elements


def estimate(df, precision, element="element"):
    return sketch.hll_estimate(sketch.hll_build(df, element, precision)).first()["estimate"]


def registers(df):
    return {tuple(row) for row in df.where("rank > 0").select("precision", "bucket", "rank").collect()}


@pytest.mark.parametrize(
    ("prefix", "count", "precision", "expected"),
    [
        ("user_", 10_000, 14, 9965),
        ("user_", 100_000, 14, 99402),
        ("user_", 1_000_000, 14, 992654),
        ("user_", 10_000, 12, 9803),
        ("user_", 1_000, 12, 1029),
        ("element_", 10_000, 14, 9981),
        ("element_", 1_000, 14, 996),
        ("element_", 10_000, 12, 10382),
        ("element_", 100_000, 14, 99417),
        ("element_", 0, 12, 0),
    ],
)
def test_known_estimates(spark, prefix, count, precision, expected):
    assert estimate(numbered_elements(spark, count, prefix), precision) == expected


def test_repeats_change_nothing(spark):
    once = numbered_elements(spark, 1000, "element_")
    repeated = once.crossJoin(spark.range(10)).select("element")
    assert estimate(repeated, 14) == 996
    rows = spark.range(100_000).select(F.concat(F.lit("user_"), (F.col("id") % 1000).cast("string")).alias("element"))
    assert estimate(rows, 12) == 1029


def test_merge_of_overlapping_and_disjoint(spark):
    left = sketch.hll_build(numbered_elements(spark, 5000), "element", 12)
    right = sketch.hll_build(numbered_elements(spark, 5000, start=2500), "element", 12)
    merged = sketch.hll_merge([left, right])
    assert sketch.hll_estimate(merged).first()["estimate"] == 7452
    first = sketch.hll_build(numbered_elements(spark, 5000, "element_"), "element", 12)
    second = sketch.hll_build(numbered_elements(spark, 5000, "element_", 5000), "element", 12)
    assert sketch.hll_estimate(sketch.hll_merge([first, second])).first()["estimate"] == 10382


def test_merge_laws(spark):
    a = sketch.hll_build(numbered_elements(spark, 3000), "element", 10)
    b = sketch.hll_build(numbered_elements(spark, 3000, start=2000), "element", 10)
    c = sketch.hll_build(numbered_elements(spark, 500, "other_"), "element", 10)
    both = registers(sketch.hll_merge([a, b]))
    assert both == registers(sketch.hll_merge([b, a]))
    assert registers(sketch.hll_merge([a, a])) == registers(a)
    assert registers(sketch.hll_merge([sketch.hll_merge([a, b]), c])) == registers(
        sketch.hll_merge([a, sketch.hll_merge([b, c])])
    )
    assert both == registers(sketch.hll_build(numbered_elements(spark, 5000), "element", 10))


@pytest.mark.parametrize("partitions", [1, 4, 50])
def test_partitioning_changes_nothing(spark, partitions):
    rows = numbered_elements(spark, 20_000).repartition(partitions)
    assert estimate(rows, 12) == estimate(numbered_elements(spark, 20_000), 12)


def test_merge_refuses_unequal_precision(spark):
    a = sketch.hll_build(numbered_elements(spark, 10), "element", 10)
    b = sketch.hll_build(numbered_elements(spark, 10, "far_"), "element", 12)
    with pytest.raises(Exception, match="different precisions"):
        sketch.hll_merge([a, b]).collect()


@pytest.mark.parametrize(("precision", "ok"), [(3, False), (17, False), (10, True), (4, True), (16, True)])
def test_precision_range(spark, precision, ok):
    frame = spark.createDataFrame([(precision,)], "precision int").select(checked_precision("precision"))
    if ok:
        assert check_precision(precision) == precision
        frame.collect()
    else:
        with pytest.raises(ValueError):
            check_precision(precision)
        with pytest.raises(Exception, match="between 4 and 16"):
            frame.collect()
        with pytest.raises(ValueError):
            sketch.hll_build(numbered_elements(spark, 1), "element", precision)


def test_clear_keeps_the_sketch(spark):
    rows = numbered_elements(spark, 2000).withColumn("id", F.col("index") % 2)
    built = sketch.hll_build(rows, "element", 12, ["id"])
    cleared = sketch.hll_clear(built, ["id"], spark.createDataFrame([(1,)], "id bigint"))
    found = {row["id"]: row for row in sketch.hll_estimate(cleared, ["id"]).collect()}
    assert found[1]["estimate"] == 0 and found[1]["precision"] == 12
    assert found[0]["estimate"] == sketch.hll_estimate(built, ["id"]).where("id = 0").first()["estimate"]


@pytest.mark.parametrize("low", [4, 8, 11, 15, 16])
def test_folding_equals_building(spark, low):
    rows = numbered_elements(spark, 300_000)
    folded = sketch.hll_fold(sketch.hll_build(rows, "element", 16), [low], 16)
    assert registers(folded) == registers(sketch.hll_build(rows, "element", low))


def test_precision_sweep_known_answers(spark):
    rows = sketch.precision_sweep(numbered_elements(spark, 100_000), "element").collect()
    assert {row["precision"]: row["estimate"] for row in rows} == {
        8: 100598, 10: 98433, 12: 101824, 14: 99402, 16: 100551,
    }
    for row in rows:
        assert row["exact_count"] == 100_000
        assert row["error_percentage"] <= 3 * 104 / math.sqrt(row["buckets"])


def test_size_sweep_known_answers(spark):
    rows = sketch.size_sweep(numbered_elements(spark, 100_000), "element", "index", [10_000, 100_000]).collect()
    assert {row["size"]: row["estimate"] for row in rows} == {10_000: 9965, 100_000: 99402}


def test_memory_comparison(spark):
    row = sketch.memory_comparison(numbered_elements(spark, 1_000_000), "element").first()
    assert row["exact_bytes"] == 48_000_000 and row["sketch_bytes"] == 16_384
    assert round(row["saving_percentage"], 2) == 99.97


def test_requests(spark):
    asked = spark.createDataFrame(
        [("a", ["user1", "user2", "user3", "user1"], 12), ("b", ["x"], None), ("c", [], 12), ("d", ["x"], 17), ("e", None, 5)],
        "request_id string, elements array<string>, precision int",
    )
    answers = {row["request_id"]: row for row in sketch.answer_requests(asked).collect()}
    assert (answers["a"]["actual_unique_count"], answers["a"]["estimated_count"]) == (3, 3)
    assert (answers["a"]["error_percentage"], answers["a"]["memory_used_bytes"]) == (0.0, 4096)
    assert answers["b"]["precision"] == 14 and answers["b"]["memory_used_bytes"] == 16384
    assert "empty" in answers["c"]["error"] and "empty" in answers["e"]["error"]
    assert "between" in answers["d"]["error"]


def test_hashes_match_their_definitions(spark):
    texts = ["", "a", "user_1", "zürich", "日本語", "emoji 😀", "x" * 500]
    rows = spark.createDataFrame([(text,) for text in texts], "t string").select(
        "t", hash32_sha256("t").alias("sha"), hash32_md5("t").alias("md5"), hash31_poly("t").alias("poly")
    )
    for row in rows.collect():
        text = row["t"]
        assert row["sha"] == int.from_bytes(hashlib.sha256(text.encode()).digest()[:4], "little")
        wide = text.encode("utf-16-le")
        assert row["md5"] == int.from_bytes(hashlib.md5(wide).digest()[:4], "big", signed=True)
        value = 0
        for at in range(0, len(wide), 2):
            value = (value * 31 + int.from_bytes(wide[at : at + 2], "little")) & 0xFFFFFFFF
        assert row["poly"] == abs(value - (1 << 32) if value >= 1 << 31 else value)


def test_leading_zeros_at_every_edge(spark):
    values = [0, 1] + [v for k in range(1, 32) for v in ((1 << k) - 1, 1 << k, (1 << k) + 1)] + [(1 << 32) - 1]
    rows = spark.createDataFrame([(v,) for v in values], "v bigint")
    for row in rows.select("v", count_leading_zeros("v", 32).alias("z")).collect():
        assert row["z"] == 32 - row["v"].bit_length()


def test_alpha_and_error(spark):
    rows = spark.createDataFrame([(16,), (32,), (64,), (128,)], "m int").select("m", alpha_mm("m").alias("a"))
    found = {row["m"]: row["a"] for row in rows.collect()}
    assert found[16] == pytest.approx(0.673 * 256) and found[32] == pytest.approx(0.697 * 1024)
    assert found[64] == pytest.approx(0.709 * 4096) and found[128] == pytest.approx(0.7213 / (1 + 1.079 / 128) * 128 * 128)
    errors = spark.createDataFrame([(100, 98), (0, 5)], "a bigint, e bigint").select(error_pct("a", "e").alias("p"))
    assert [row["p"] for row in errors.collect()] == [2.0, None]


def test_corrections_in_all_ranges(spark):
    rows = spark.createDataFrame(
        [(16384, 100.0, 16284), (16384, 40000.0, 0), (16384, 1e6, 0), (65536, 2e8, 0)], "m bigint, raw double, zeros bigint"
    )
    got = [r[0] for r in rows.select(corrected_estimate(F.col("m"), F.col("raw"), F.col("zeros"))).collect()]
    top = float(1 << 32)
    assert got == [int(16384 * math.log(16384 / 16284)), 40000, 1_000_000, int(-top * math.log(1 - 2e8 / top))]


@pytest.mark.parametrize("precision", [4, 12, 16])
def test_pack_round_trip(spark, precision):
    rows = numbered_elements(spark, 3000).withColumn("id", F.col("index") % 3)
    built = sketch.hll_build(rows, "element", precision, ["id"])
    packed = sketch.pack_registers(built, ["id"])
    assert {row[0] for row in packed.select(F.length("buckets")).collect()} == {1 << precision}
    unpacked = sketch.unpack_registers(packed, ["id"])
    columns = ["id", "precision", "bucket", "rank"]
    assert {tuple(r) for r in unpacked.where("rank > 0").select(columns).collect()} == {
        tuple(r) for r in built.select(columns).collect()
    }


def test_state_life_cycle(spark):
    now = [F.to_timestamp_ntz(F.lit(f"2025-01-0{day} 00:00:00")) for day in range(1, 5)]
    ids = spark.createDataFrame([(1,), (2,), (3,)], "hll_id int")
    state = sketch_state.init_sketch(sketch_state.empty_state(spark), ids, 12, now[0])
    users = numbered_elements(spark, 5000).withColumn("hll_id", F.lit(1))
    others = numbered_elements(spark, 5000, start=2500).withColumn("hll_id", F.lit(2))
    delta = sketch.hll_build(users.unionByName(others), "element", 12, ["hll_id"])
    state = materialize(sketch_state.upsert_sketch(state, delta, now[1]), "state")
    again = {r["hll_id"]: r for r in sketch_state.upsert_sketch(state, delta, now[2]).collect()}
    assert str(again[1]["last_updated_date"]) == "2025-01-02 00:00:00"
    assert str(again[3]["last_updated_date"]) == "2025-01-01 00:00:00"
    merged = materialize(sketch_state.merge_into(state, 1, 2, now[3]), "state")
    wanted = spark.createDataFrame([(1,), (3,), (99,)], "hll_id int")
    found = {r["hll_id"]: r["estimate"] for r in sketch_state.estimate_cardinality(merged, wanted).collect()}
    assert found == {1: 7452, 3: 0, 99: 0}
    source = {r["hll_id"]: r["estimate"] for r in sketch_state.hll_estimates(state).collect()}[2]
    assert {r["hll_id"]: r["estimate"] for r in sketch_state.hll_estimates(merged).collect()}[2] == source
    reset = sketch_state.init_sketch(merged, spark.createDataFrame([(1,)], "hll_id int"), 10, now[3])
    assert {r["hll_id"]: (r["precision"], len(r["buckets"])) for r in reset.collect()}[1] == (10, 1024)


def test_unknown_sketch_is_an_error(spark):
    delta = sketch.hll_build(numbered_elements(spark, 5).withColumn("hll_id", F.lit(7)), "element", 12, ["hll_id"])
    with pytest.raises(Exception, match="not found"):
        sketch_state.upsert_sketch(sketch_state.empty_state(spark), delta).collect()


def test_sql_functions(spark):
    assert register_hll_functions(spark) == ["compute_hash", "count_leading_zeros", "get_alpha_constant"]
    row = spark.sql("SELECT compute_hash('user_1') h, count_leading_zeros(5L, 10) z, get_alpha_constant(16) a").first()
    assert row["h"] == int.from_bytes(hashlib.sha256(b"user_1").digest()[:4], "little")
    assert row["z"] == 7 and row["a"] == pytest.approx(0.673 * 256)


def test_nulls_are_not_elements(spark):
    rows = spark.createDataFrame([("a",), (None,), ("b",)], "element string")
    assert estimate(rows, 12) == 2
    assert sketch.exact_vs_estimate(rows, "element", 12).first()["actual_unique_count"] == 2


def test_compared_counts(spark):
    rows = numbered_elements(spark, 20_000).withColumn("g", F.when(F.col("index") % 3 == 0, "a"))
    whole = sketch.compare_counts(rows, "element", 14)
    assert "NestedLoop" not in whole._jdf.queryExecution().executedPlan().toString()
    row = whole.first()
    assert row["exact_count"] == 20_000
    for name in ("native_estimate", "datasketches_estimate", "custom_estimate"):
        assert abs(row[name] - 20_000) < 3_000
    by_group = {r["g"]: r["exact_count"] for r in sketch.compare_counts(rows, "element", 14, ["g"]).collect()}
    assert by_group == {"a": 6667, None: 13_333}


def test_empty_input(spark):
    row = sketch.exact_vs_estimate(numbered_elements(spark, 0), "element", 12).first()
    assert (row["actual_unique_count"], row["estimated_count"], row["error_percentage"]) == (0, 0, None)


def test_hot_group_ships_registers_not_rows(spark):
    """A group with most rows is combined before the shuffle."""
    rows = spark.range(50_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("g"), F.col("id").cast("string").alias("element")
    )
    plan = sketch.hll_build(rows, "element", 6, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange") and "BatchEvalPython" not in plan


def long_form(spark, rows):
    return spark.createDataFrame(rows, "g string, precision int, bucket int, rank int")


def test_a_saturated_sketch_is_refused_and_not_empty(spark):
    full = long_form(spark, [("a", 4, bucket, 29) for bucket in range(16)])
    with pytest.raises(Exception, match="beyond the range"):
        sketch.hll_estimate(full, ["g"]).collect()
    assert sketch.hll_estimate(full, ["g"], "sha256_64").first()["estimate"] > 4e9
    higher = long_form(spark, [("a", 4, bucket, 57) for bucket in range(16)])
    assert sketch.hll_estimate(higher, ["g"], "sha256_64").first()["estimate"] > 1e18


def test_an_estimate_over_all_groups_merges_first(spark):
    rows = numbered_elements(spark, 3000).withColumn("g", (F.col("index") % 3).cast("string"))
    grouped = sketch.hll_build(rows, "element", 14, ["g"])
    whole = sketch.hll_build(rows, "element", 14)
    assert sketch.hll_estimate(grouped).first()["estimate"] == sketch.hll_estimate(whole).first()["estimate"]


def test_mixed_precisions_are_refused(spark):
    mixed = long_form(spark, [("a", 4, 0, 1), ("b", 5, 0, 1)])
    for run in (
        lambda: sketch.hll_estimate(mixed).collect(),
        lambda: sketch.hll_estimate(mixed.withColumn("g", F.lit("x")), ["g"]).collect(),
        lambda: sketch.hll_rollup(mixed, {"all": F.lit(1)}).collect(),
    ):
        with pytest.raises(Exception, match="different precisions"):
            run()
    assert sketch.hll_estimate(mixed, ["g"]).count() == 2
    with pytest.raises(ValueError):
        sketch.hll_build(mixed, "g", 4, hash_name="crc")


def test_hash_of_64_bits(spark):
    from tallyloom.functions.hashing import bit_length64, hash64_sha256

    texts = ["", "a", "user_1", "zürich"]
    got = [row[0] for row in spark.createDataFrame([(text,) for text in texts], "t string").select(hash64_sha256("t")).collect()]
    assert got == [int.from_bytes(hashlib.sha256(text.encode()).digest()[:8], "little", signed=True) for text in texts]
    values = [0, 1, 2, (1 << 31) - 1, 1 << 31, (1 << 32) - 1, 1 << 32, (1 << 53) + 1, (1 << 63) - 1, -1, -(1 << 63)]
    found = spark.createDataFrame([(v,) for v in values], "v bigint").select(bit_length64(F.col("v"))).collect()
    assert [row[0] for row in found] == [(v & ((1 << 64) - 1)).bit_length() for v in values]
    rows = numbered_elements(spark, 100_000)
    estimate = sketch.hll_estimate(sketch.hll_build(rows, "element", 14, hash_name="sha256_64"), hash_name="sha256_64").first()["estimate"]
    assert abs(estimate - 100_000) < 2_000


@pytest.mark.parametrize("low", [4, 8, 10, 13])
def test_folding_equals_building_at_64_bits(spark, low):
    rows = numbered_elements(spark, 60_000)
    built = sketch.hll_build(rows, "element", 14, hash_name="sha256_64")
    # High ranks are rare among real hashes, so some are set by hand: past the 32-bit window and past the whole window.
    made = spark.createDataFrame([(14, "sha256_64", 5, 25), (14, "sha256_64", 16383, 51), (14, "sha256_64", 16384 - (1 << low), 51), (14, "sha256_64", 0, 51)], built.schema)
    direct = sketch.hll_build(rows, "element", low, hash_name="sha256_64")
    order = ["precision", "hash", "bucket", "rank"]
    assert sorted(map(tuple, sketch.hll_fold(built, [low], 14).select(order).collect())) == sorted(map(tuple, direct.select(order).collect()))
    found = {r["bucket"]: r["rank"] for r in sketch.hll_fold(made, [low], 14).collect()}
    assert found[5 % (1 << low)] == (25 if low > 4 or 5 < 16 else None)
    assert found[(1 << low) - 1] == 51 and found[0] == 51 + (14 - low)
    swept = {r["precision"]: r["estimate"] for r in sketch.precision_sweep(rows, "element", [low, 14], hash_name="sha256_64").collect()}
    assert swept[low] == sketch.hll_estimate(direct).first()["estimate"]


def test_sketches_of_different_hashes_never_meet(spark):
    rows = numbered_elements(spark, 500).withColumn("hll_id", F.lit(1))
    by_hash = {name: sketch.hll_build(rows, "element", 8, ["hll_id"], name) for name in sketch.HASHES}
    both = by_hash["sha256"].unionByName(by_hash["md5"])
    state = sketch_state.init_sketch(sketch_state.empty_state(spark), rows, 8, hash_name="md5")
    other = sketch_state.init_sketch(state, spark.createDataFrame([(2,)], "hll_id int"), 8)
    for run in (
        lambda: sketch.hll_merge([by_hash["sha256"], by_hash["sha256_64"]], ["hll_id"]).collect(),
        lambda: sketch.hll_estimate(both, ["hll_id"]).collect(),
        lambda: sketch.hll_estimate(both).collect(),
        lambda: sketch.hll_rollup(both, {"all": F.lit(1)}).collect(),
        lambda: sketch_state.upsert_sketch(state, by_hash["sha256"]).collect(),
        lambda: sketch_state.merge_into(other, 2, 1).collect(),
    ):
        with pytest.raises(Exception, match="different hashes: (md5, sha256|sha256, md5|sha256, sha256_64)"):
            run()
    with pytest.raises(Exception, match="Unknown hash crc"):
        sketch.hll_estimate(by_hash["md5"].withColumn("hash", F.lit("crc"))).collect()
    # Rows of before hashes were named.
    unnamed = by_hash["sha256"].drop("hash")
    assert sketch.hll_estimate(unnamed).first() == sketch.hll_estimate(by_hash["sha256"]).first()
    assert sketch.hll_merge([unnamed, by_hash["sha256"]]).count() == unnamed.count()
    kept = sketch.hll_clear(by_hash["md5"], ["hll_id"], rows)
    assert [tuple(r) for r in kept.collect()] == [(1, 8, "md5", None, 0)]


@pytest.mark.parametrize("hash_name", ["sha256", "sha256_64"])
def test_stored_sketches_in_both_encodings(spark, hash_name):
    few, many = numbered_elements(spark, 40), numbered_elements(spark, 9000)
    rows = few.withColumn("hll_id", F.lit(1)).unionByName(many.withColumn("hll_id", F.lit(2)))
    built = sketch.hll_build(rows, "element", 10, ["hll_id"], hash_name)
    packed = sketch.pack_registers(built, ["hll_id"], sketch.SPARSE)
    found = {r["hll_id"]: (r["hash"], r["encoding"], len(r["buckets"])) for r in packed.collect()}
    assert found[2] == (hash_name, "dense", 1024) and found[1][1] == "sparse" and found[1][2] <= 120
    columns = built.columns
    unpacked = sketch.unpack_registers(packed, ["hll_id"]).where("rank > 0").select(columns)
    assert sorted(map(tuple, unpacked.collect())) == sorted(map(tuple, built.collect()))
    now = [F.to_timestamp_ntz(F.lit(f"2025-01-0{day} 00:00:00")) for day in range(1, 4)]
    states = {}
    for encoding in (sketch.DENSE, sketch.SPARSE):
        ids = spark.createDataFrame([(1,), (2,), (3,)], "hll_id int")
        state = sketch_state.init_sketch(sketch_state.empty_state(spark), ids, 10, now[0], hash_name, encoding)
        for half in (0, 1):
            delta = sketch.hll_build(rows.where(F.col("index") % 2 == half), "element", 10, ["hll_id"], hash_name)
            state = materialize(sketch_state.upsert_sketch(state, delta, now[1]), "state")
        again = sketch_state.upsert_sketch(state, delta, now[2])
        assert {str(r["last_updated_date"])[:10] for r in again.where("hll_id < 3").collect()} == {"2025-01-02"}
        states[encoding] = {r["hll_id"]: r["estimate"] for r in sketch_state.hll_estimates(state).collect()}
        lengths = {r["hll_id"]: (r["encoding"], len(r["buckets"])) for r in state.collect()}
        assert lengths[2] == ("dense", 1024) and lengths[3] == ((encoding, 0) if encoding == "sparse" else (encoding, 1024))
    assert states["dense"] == states["sparse"] and states["dense"][3] == 0
    assert states["dense"] == {3: 0} | {r["hll_id"]: r["estimate"] for r in sketch.hll_estimate(built, ["hll_id"]).collect()}


def test_full_sketches_are_stored_in_time_linear_in_their_registers(spark):
    """Every register of 2^14 filled: minutes where packed registers are computed again for each of them."""
    rows = spark.range(200_000).select(F.lit(1).alias("hll_id"), F.col("id").alias("part"))
    state = sketch_state.init_sketch(sketch_state.empty_state(spark), rows, 14, hash_name="sha256_64", encoding=sketch.SPARSE)
    started = time.monotonic()
    for rest in (0, 1):
        delta = sketch.hll_build(rows.where(F.col("part") % 2 == rest), "part", 14, ["hll_id"], "sha256_64")
        state = materialize(sketch_state.upsert_sketch(state, delta), "full_state")
    taken = time.monotonic() - started
    whole = sketch.hll_build(rows, "part", 14, ["hll_id"], "sha256_64").where("rank > 0")
    columns = ["hll_id", "bucket", "rank"]
    stored = sketch.unpack_registers(state, ["hll_id"]).where("rank > 0").select(*columns)
    assert stored.exceptAll(whole.select(*columns)).count() == 0 and stored.count() == whole.count()
    assert taken < 60
