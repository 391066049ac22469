"""Mergeable distinct-count sketches in long form.

A sketch is a set of rows ``(*by, precision, hash, bucket, rank)``: one row per
non-empty register, so small groups cost few rows and no group costs more than
``2^precision``. A row with a null bucket marks a sketch that may be empty.
``hash`` names the hash that the registers were made with, and so its width; rows
without that column count as ``sha256``. Sketches that differ in hash or precision
are never merged.
Building is one partial and one final ``max``: whatever the skew of a group, a
task ships at most ``2^precision`` of its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.functions.cardinality import (
    DEFAULT_PRECISION,
    EXACT_BYTES_PER_ELEMENT,
    MAX_PRECISION,
    MIN_PRECISION,
    check_precision,
    corrected_estimate,
    error_pct,
    raw_estimate,
    registers_of,
)
from tallyloom.functions.columns import as_column, empty_strings
from tallyloom.functions.hashing import (
    bucket_of,
    count_leading_zeros,
    hash32_md5,
    hash32_sha256,
    hash64_sha256,
    rank_of,
)

#: Hashes of sketches, each with its bits.
HASHES = {
    "sha256": (hash32_sha256, 32),
    "sha256_64": (hash64_sha256, 64),
    "md5": (lambda value: hash32_md5(value, signed=False), 32),
}


def hash_bits_of(hash_name: str) -> int:
    """Bits of a hash of :data:`HASHES`."""
    if hash_name not in HASHES:
        raise ValueError(f"hash must be one of {sorted(HASHES)}")
    return HASHES[hash_name][1]


def hash_bits_column(hash_name: Column | str) -> Column:
    """Bits of the hash that a column names; an unknown name fails the job."""
    name = as_column(hash_name)
    bits = F.raise_error(F.concat(F.lit("Unknown hash "), F.coalesce(name, F.lit("null")))).cast("int")
    for known, (_, width) in HASHES.items():
        bits = F.when(name == known, F.lit(width)).otherwise(bits)
    return bits


REGISTER = ("precision", "hash", "bucket", "rank")
DEFAULT_HASH = "sha256"


def described(sketch: DataFrame, hash_name: str | None = None) -> DataFrame:
    """The sketch with its ``hash``: its own, or else ``hash_name``, by default ``sha256``."""
    if "hash" in sketch.columns:
        return sketch
    hash_bits_of(hash_name or DEFAULT_HASH)
    return sketch.withColumn("hash", F.lit(hash_name or DEFAULT_HASH))


def hll_build(
    df: DataFrame,
    element: Column | str,
    precision: int = DEFAULT_PRECISION,
    by: Sequence[str] = (),
    hash_name: str = DEFAULT_HASH,
) -> DataFrame:
    """Registers of the distinct non-null ``element`` values, per ``by`` group.

    ``hash_name`` is one of :data:`HASHES`: 32-bit hashes answer up to about four billion distinct values,
    ``sha256_64`` is the choice for larger tables. The sketch carries the name.
    """
    check_precision(precision)
    bits = hash_bits_of(hash_name)
    # The null test comes before the hash: a test on the hash would be pushed
    # below the projection and compute it again.
    elements = df.select(*by, as_column(element).alias("_element")).where(F.col("_element").isNotNull())
    hashed = elements.select(*by, HASHES[hash_name][0]("_element").alias("_hash"))
    registers = hashed.select(
        *by, bucket_of(F.col("_hash"), precision).alias("bucket"), rank_of(F.col("_hash"), precision, bits).cast("int").alias("rank")
    )
    largest = registers.groupBy(*by, "bucket").agg(F.max("rank").alias("rank"))
    return largest.select(*by, F.lit(precision).alias("precision"), F.lit(hash_name).alias("hash"), "bucket", "rank")


def _max_registers(registers: DataFrame, by: Sequence[str]) -> DataFrame:
    return registers.groupBy(*by, "precision", "hash", "bucket").agg(F.max("rank").alias("rank"))


MIXED_MESSAGE = "Cannot merge sketches with different precisions"
MIXED_HASHES = "Cannot merge sketches with different hashes"


def _the_one(name: str, message: str) -> Column:
    """The one value of ``name`` in a group, null if it has none; different ones fail the job and are named."""
    ends = F.min(name), F.max(name)
    told = F.concat(F.lit(f"{message}: "), ends[0].cast("string"), F.lit(", "), ends[1].cast("string"))
    return F.when(ends[0].eqNullSafe(ends[1]), ends[1]).otherwise(F.raise_error(told).cast("int" if name == "precision" else "string"))


def hll_estimate(sketch: DataFrame, by: Sequence[str] = (), hash_name: str | None = None) -> DataFrame:
    """``(*by, precision, zeros, raw, estimate)`` of every sketch.

    Where the sketch is grouped more finely than ``by``, its registers are merged first. Groups of mixed precision or hash
    fail the job. Without ``by`` there is one row even when the sketch has none, with estimate 0. ``hash_name`` is the hash of a sketch
    that doesn't carry it.
    """
    finer = set(sketch.columns) - {*by, *REGISTER}
    sketch = described(sketch, hash_name).select(*by, *REGISTER)
    if finer:
        sketch = _max_registers(sketch, by)
    filled = F.col("rank") > 0
    tail = F.sum(F.when(filled, F.pow(F.lit(2.0), -F.col("rank"))).otherwise(F.lit(0.0))).alias("_tail")
    one_hash = _the_one("hash", MIXED_HASHES).alias("_hash")
    m = registers_of("precision")
    bits = F.when(F.col("_hash").isNotNull(), hash_bits_column("_hash"))
    known = F.col("_hash").isNull() | F.col("_hash").isin(list(HASHES))
    unknown = F.raise_error(F.concat(F.lit("Unknown hash "), F.col("_hash"))).cast("int")
    return (
        sketch.groupBy(*by)
        .agg(F.count_if(filled).alias("_filled"), tail, _the_one("precision", MIXED_MESSAGE).alias("precision"), one_hash)
        .withColumn("zeros", m - F.col("_filled"))
        .withColumn("raw", raw_estimate(m, F.col("_tail") + F.col("zeros")))
        .select(
            *by,
            F.when(known, F.col("precision")).otherwise(unknown).alias("precision"),
            "zeros",
            "raw",
            F.coalesce(corrected_estimate(m, F.col("raw"), F.col("zeros"), bits), F.lit(0)).alias("estimate"),
        )
    )


def hll_merge(sketches: Sequence[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """Register-wise maximum; a group whose inputs differ in precision or hash fails the job."""
    columns = [*by, *REGISTER]
    merged = _max_registers(reduce(DataFrame.unionByName, [described(sketch).select(*columns) for sketch in sketches]), by)
    # At most 2^precision rows per group, precision and hash reach this window.
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))

    def same(name: str, message: str) -> Column:
        ends = F.min(name).over(group), F.max(name).over(group)
        told = F.concat(F.lit(f"{message}: "), ends[0].cast("string"), F.lit(", "), ends[1].cast("string"))
        return F.when(ends[0] == ends[1], F.col(name)).otherwise(F.raise_error(told).cast("int" if name == "precision" else "string"))

    return merged.withColumns({"precision": same("precision", MIXED_MESSAGE), "hash": same("hash", MIXED_HASHES)}).select(*columns)


def hll_rollup(sketch: DataFrame, to: Mapping[str, Column]) -> DataFrame:
    """Sketches of coarser groups from finer ones, without rescanning the events.

    ``to`` maps each coarse grouping column to an expression over the fine ones. A coarse group whose sketches
    differ in precision or hash fails the job.
    """
    coarse = described(sketch).select(*[expr.alias(name) for name, expr in to.items()], *REGISTER)
    return hll_merge([coarse], list(to))


def hll_clear(sketch: DataFrame, by: Sequence[str], cleared: DataFrame) -> DataFrame:
    """Empty the sketches whose keys are in ``cleared``; their precision and hash stay."""
    keys = cleared.select(*by).distinct().withColumn("_cleared", F.lit(True))
    marked = described(sketch).join(keys, list(by), "left")
    is_cleared = F.col("_cleared").isNotNull()
    emptied = (
        marked.where(is_cleared)
        .select(*by, "precision", "hash")
        .distinct()
        .select(*by, "precision", "hash", F.lit(None).cast("int").alias("bucket"), F.lit(0).alias("rank"))
    )
    return marked.where(~is_cleared).select(*by, *REGISTER).unionByName(emptied)


def _folded_rank(built_at: int, bits: Column) -> Column:
    """The rank at the lower precision ``_to`` of a register of precision ``built_at``.

    The bits a finer sketch spends on its bucket are the low bits of the rank
    window of a coarser one. A rank inside the finer window is therefore also
    the coarser rank; past it, counting goes on in the bucket's upper bits.
    """
    window = bits - built_at
    upper_bits = F.expr("shiftright(bucket, _to)").cast("bigint")
    beyond = window + 1 + count_leading_zeros(upper_bits, F.lit(built_at) - F.col("_to"))
    return F.when(F.col("rank") <= window, F.col("rank")).otherwise(beyond)


def hll_fold(sketch: DataFrame, precisions: Sequence[int], built_at: int, by: Sequence[str] = ()) -> DataFrame:
    """The sketches at lower precisions, exactly as if built there with the same hash."""
    for precision in precisions:
        if check_precision(precision) > built_at:
            raise ValueError("a sketch can only be folded to a lower precision")
    exploded = described(sketch).where(F.col("bucket").isNotNull()).withColumn(
        "_to", F.explode(F.array(*[F.lit(p) for p in precisions]))
    )
    return _max_registers(
        exploded.select(
            *by,
            F.col("_to").alias("precision"),
            "hash",
            F.expr("bucket & (shiftleft(1, _to) - 1)").alias("bucket"),
            _folded_rank(built_at, hash_bits_column("hash")).alias("rank"),
        ),
        by,
    )


def distinct_elements(df: DataFrame, element: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct non-null ``(*by, element)`` rows, spread by element and not by group."""
    return df.select(*by, as_column(element).cast("string").alias("element")).where(
        F.col("element").isNotNull()
    ).distinct()


def exact_vs_estimate(
    df: DataFrame,
    element: Column | str,
    precision: int = DEFAULT_PRECISION,
    by: Sequence[str] = (),
    hash_name: str = DEFAULT_HASH,
) -> DataFrame:
    """Exact distinct count beside the estimate, with error and sketch size.

    One scan and one wide shuffle: the de-duplicated elements give the exact
    count per bucket as well as the registers.
    """
    check_precision(precision)
    return exact_and_estimate(distinct_elements(df, element, by), precision, by, hash_name).select(
        *by,
        F.lit(precision).alias("precision"),
        F.col("exact").alias("actual_unique_count"),
        F.col("estimate").alias("estimated_count"),
        error_pct("exact", "estimate").alias("error_percentage"),
        F.lit(1 << precision).cast("bigint").alias("memory_used_bytes"),
    )


def exact_and_estimate(distinct: DataFrame, precision: int, by: Sequence[str] = (), hash_name: str = DEFAULT_HASH) -> DataFrame:
    """``(*by, exact, zeros, raw, estimate)`` of de-duplicated ``(*by, element)`` rows."""
    check_precision(precision)
    bits = hash_bits_of(hash_name)
    hashed = distinct.select(*by, HASHES[hash_name][0]("element").alias("_hash"))
    buckets = hashed.groupBy(*by, bucket_of(F.col("_hash"), precision).alias("bucket")).agg(
        F.max(rank_of(F.col("_hash"), precision, bits)).alias("rank"), F.count(F.lit(1)).alias("elements")
    )
    m = F.lit(1 << precision).cast("bigint")
    return (
        buckets.groupBy(*by)
        .agg(
            F.coalesce(F.sum("elements"), F.lit(0)).alias("exact"),
            F.count(F.lit(1)).alias("_filled"),
            F.coalesce(F.sum(F.pow(F.lit(2.0), -F.col("rank"))), F.lit(0.0)).alias("_tail"),
        )
        .withColumn("zeros", m - F.col("_filled"))
        .withColumn("raw", raw_estimate(m, F.col("_tail") + F.col("zeros")))
        .withColumn("estimate", corrected_estimate(m, F.col("raw"), F.col("zeros"), bits))
        .select(*by, "exact", "zeros", "raw", "estimate")
    )


def answer_requests(requests: DataFrame, default_precision: int = DEFAULT_PRECISION, hash_name: str = DEFAULT_HASH) -> DataFrame:
    """Answer estimate requests ``request_id, elements, precision``.

    A request is one row with an id of its own, so its repeated elements are
    dropped inside the row and nothing but registers is shuffled. Every request
    has its own precision, the default where it names none.
    Requests without elements or with a precision out of range are answered by
    ``error`` alone.
    """
    check_precision(default_precision)
    bits = hash_bits_of(hash_name)
    asked = requests.select(
        "request_id",
        F.array_distinct(F.array_compact(F.coalesce("elements", empty_strings()))).alias("elements"),
        F.coalesce("precision", F.lit(default_precision)).alias("precision"),
    ).withColumn(
        "error",
        F.when(F.size("elements") == 0, F.lit("Elements array cannot be empty")).when(
            ~F.col("precision").between(MIN_PRECISION, MAX_PRECISION),
            F.lit(f"Precision must be between {MIN_PRECISION} and {MAX_PRECISION}"),
        ),
    )
    by = ["request_id", "precision", "error"]
    # Refused requests go along with no element, so the input is read once.
    answered = F.when(F.col("error").isNull(), F.col("elements")).otherwise(empty_strings())
    hashed = asked.select(*by, F.explode_outer(answered).alias("element")).select(
        *by, HASHES[hash_name][0]("element").alias("_hash")
    )
    precision = F.col("precision")
    buckets = hashed.groupBy(*by, bucket_of(F.col("_hash"), precision).alias("bucket")).agg(
        F.max(rank_of(F.col("_hash"), precision, bits)).alias("rank"), F.count("_hash").alias("elements")
    )
    m = registers_of(precision)
    ok = F.col("error").isNull()
    return (
        buckets.groupBy(*by)
        .agg(
            F.sum("elements").alias("exact"),
            F.count("bucket").alias("_filled"),
            F.coalesce(F.sum(F.pow(F.lit(2.0), -F.col("rank"))), F.lit(0.0)).alias("_tail"),
        )
        .withColumn("zeros", m - F.col("_filled"))
        .withColumn("raw", raw_estimate(m, F.col("_tail") + F.col("zeros")))
        .withColumn("estimate", corrected_estimate(m, F.col("raw"), F.col("zeros"), bits))
        .select(
            *by,
            F.when(ok, F.col("exact")).alias("actual_unique_count"),
            F.when(ok, F.col("estimate")).alias("estimated_count"),
            F.when(ok, error_pct("exact", "estimate")).alias("error_percentage"),
            F.when(ok, m).alias("memory_used_bytes"),
        )
    )


def compare_counts(
    df: DataFrame,
    element: Column | str,
    precision: int = DEFAULT_PRECISION,
    by: Sequence[str] = (),
    hash_name: str = DEFAULT_HASH,
) -> DataFrame:
    """Exact count, Spark's two approximate counts and this sketch, side by side."""
    check_precision(precision)
    distinct = distinct_elements(df, element, by)
    custom = exact_and_estimate(distinct, precision, by, hash_name)
    # Both approximate counts ignore repeats, so they may read the same
    # de-duplicated shuffle (Spark reuses the exchange).
    native = distinct.groupBy(*by).agg(
        F.approx_count_distinct("element").alias("native_estimate"),
        F.hll_sketch_estimate(F.hll_sketch_agg("element", F.lit(precision))).alias("datasketches_estimate"),
    )
    counts = custom.select(*by, F.col("exact").alias("exact_count"), F.col("estimate").alias("custom_estimate"))
    names = ["exact_count", "native_estimate", "datasketches_estimate", "custom_estimate"]
    return (
        counts.unionByName(native, allowMissingColumns=True)
        .groupBy(*by)
        .agg(*[F.max(name).alias(name) for name in names])
    )


def precision_sweep(
    df: DataFrame,
    element: Column | str,
    precisions: Sequence[int] = (8, 10, 12, 14, 16),
    by: Sequence[str] = (),
    hash_name: str = DEFAULT_HASH,
) -> DataFrame:
    """Estimate, error and size at several precisions from one build at the finest."""
    finest = max(check_precision(p) for p in precisions)
    bits = hash_bits_of(hash_name)
    distinct = distinct_elements(df, element, by)
    hashed = distinct.select(*by, HASHES[hash_name][0]("element").alias("_hash"))
    finest_registers = hashed.groupBy(
        *by, F.lit(finest).alias("precision"), bucket_of(F.col("_hash"), finest).alias("bucket")
    ).agg(F.max(rank_of(F.col("_hash"), finest, bits)).alias("rank"), F.count(F.lit(1)).alias("elements"))
    exploded = finest_registers.withColumn("_to", F.explode(F.array(*[F.lit(p) for p in precisions])))
    folded = exploded.groupBy(
        *by, F.col("_to").alias("precision"), F.expr("bucket & (shiftleft(1, _to) - 1)").alias("bucket")
    ).agg(F.max(_folded_rank(finest, F.lit(bits))).alias("rank"), F.sum("elements").alias("elements"))
    m = registers_of("precision")
    return (
        folded.groupBy(*by, "precision")
        .agg(
            F.sum("elements").alias("exact_count"),
            F.count(F.lit(1)).alias("_filled"),
            F.sum(F.pow(F.lit(2.0), -F.col("rank"))).alias("_tail"),
        )
        .withColumn("zeros", m - F.col("_filled"))
        .withColumn("raw", raw_estimate(m, F.col("_tail") + F.col("zeros")))
        .withColumn("estimate", corrected_estimate(m, F.col("raw"), F.col("zeros"), bits))
        .select(
            *by,
            "precision",
            m.alias("buckets"),
            (m / F.lit(1024.0)).alias("memory_kb"),
            "exact_count",
            "estimate",
            error_pct("exact_count", "estimate").alias("error_percentage"),
        )
    )


def size_sweep(
    df: DataFrame,
    element: Column | str,
    index: Column | str,
    sizes: Sequence[int],
    precision: int = DEFAULT_PRECISION,
    hash_name: str = DEFAULT_HASH,
) -> DataFrame:
    """Estimate and error over the first ``n`` elements, for each ``n`` in ``sizes``.

    Rows are hashed once into the smallest size that holds them; larger sizes
    are merged from those sketches and not from the rows.
    """
    check_precision(precision)
    ordered = sorted(set(sizes))
    position = as_column(index)
    size_class = F.lit(None).cast("bigint")
    for size in reversed(ordered):
        size_class = F.when(position < size, F.lit(size)).otherwise(size_class)
    sized = df.select(as_column(element).cast("string").alias("element"), size_class.alias("_class")).where(
        F.col("_class").isNotNull()
    )
    classes = hll_build(sized, "element", precision, ["_class"], hash_name)
    all_sizes = F.array(*[F.lit(size).cast("bigint") for size in ordered])
    merged = _max_registers(
        classes.withColumn("size", F.explode(F.filter(all_sizes, lambda s: s >= F.col("_class")))), ["size"]
    )
    return hll_estimate(merged, ["size"]).select(
        "size", "estimate", error_pct("size", "estimate").alias("error_percentage")
    )


def memory_comparison(
    df: DataFrame, element: Column | str, precision: int = DEFAULT_PRECISION, by: Sequence[str] = ()
) -> DataFrame:
    """Bytes of an exact set against bytes of the sketch, and the saving in percent."""
    check_precision(precision)
    sketch_bytes = F.lit(1 << precision).cast("bigint")
    counted = df.select(*by, as_column(element).alias("_element")).groupBy(*by).agg(
        F.count_distinct("_element").alias("elements")
    )
    exact_bytes = F.col("elements") * F.lit(EXACT_BYTES_PER_ELEMENT)
    return counted.select(
        *by,
        "elements",
        exact_bytes.alias("exact_bytes"),
        sketch_bytes.alias("sketch_bytes"),
        ((F.lit(1.0) - F.try_divide(sketch_bytes, exact_bytes)) * 100).alias("saving_percentage"),
    )


def visitor_sketches(
    df: DataFrame,
    visitor: Column | str,
    timestamp: Column | str,
    unit: str = "day",
    precision: int = DEFAULT_PRECISION,
    hash_name: str = DEFAULT_HASH,
) -> DataFrame:
    """One sketch per period (``day``, ``week``, ``month``, ...) of ``timestamp``."""
    period = F.date_trunc(unit, as_column(timestamp)).cast("date").alias("period")
    return hll_build(df.select(period, as_column(visitor).alias("_visitor")), "_visitor", precision, ["period"], hash_name)


def unique_visitors(
    df: DataFrame,
    visitor: Column | str,
    timestamp: Column | str,
    unit: str = "day",
    precision: int = DEFAULT_PRECISION,
    hash_name: str = DEFAULT_HASH,
) -> DataFrame:
    """Estimated distinct visitors per period."""
    return hll_estimate(visitor_sketches(df, visitor, timestamp, unit, precision, hash_name), ["period"]).select(
        "period", F.col("estimate").alias("unique_visitors")
    )


def next_period_union(sketches: DataFrame, period: str, step: Column) -> DataFrame:
    """Estimated distinct visitors of each period together with the one after it.

    Every sketch is offered to its own pair and to the pair that began one
    ``step`` earlier, so the merge is one grouping and needs no join.
    """
    starts = F.array(F.col(period), (F.col(period) - step).cast("date"))
    paired = sketches.withColumn("_start", F.explode(starts))
    both = hll_estimate(hll_merge([paired], ["_start"]), ["_start"])
    own = sketches.select(F.col(period).alias("_start")).distinct()
    return both.join(own, "_start", "left_semi").select(
        F.col("_start").alias(period), F.col("estimate").alias("unique_visitors")
    )


DENSE, SPARSE = "dense", "sparse"
SPARSE_BYTES = 3  #: of one register: two of its bucket, one of its rank


def pack_registers(sketch: DataFrame, by: Sequence[str], encoding: str = DENSE) -> DataFrame:
    """``(*by, precision, hash, encoding, buckets)``, one row per sketch that names its own hash and encoding.

    ``dense`` has one byte per register. ``sparse`` has three bytes for each register that isn't zero, by bucket; where that would
    be longer, the row is dense all the same. A group holds at most ``2^precision`` entries.
    """
    if encoding not in (DENSE, SPARSE):
        raise ValueError(f"encoding must be {DENSE} or {SPARSE}")
    entries = F.array_sort(F.collect_list(F.when(F.col("rank") > 0, F.struct("bucket", "rank")))).alias("_entries")
    grouped = described(sketch).groupBy(*by, "precision", "hash").agg(entries)
    found = encoded_registers(F.col("_entries"), F.col("precision"), F.lit(encoding))
    return grouped.select(*by, "precision", "hash", found["encoding"].alias("encoding"), found["buckets"].alias("buckets"))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it, inside its loops too."""
    return F.element_at(F.transform(F.array(value), use), 1)


def encoded_registers(entries: Column, precision: Column, encoding: Column) -> Column:
    """Struct ``encoding, buckets`` from sorted ``bucket, rank`` entries; sparse only where that is shorter than dense."""
    return _bound(entries, lambda found: _encoded(found, precision, encoding))


def _encoded(entries: Column, precision: Column, encoding: Column) -> Column:
    hex_rank = lambda entry: F.lpad(F.hex(entry["rank"]), 2, "0")

    def cell(entry: Column, i: Column) -> Column:
        after_previous = F.when(i == 0, F.lit(0)).otherwise(F.get(entries, i - 1)["bucket"] + 1)
        return F.concat(F.repeat(F.lit("00"), entry["bucket"] - after_previous), hex_rank(entry))

    dense = F.rpad(F.array_join(F.transform(entries, cell), ""), (registers_of(precision) * 2).cast("int"), F.lit("0"))
    sparse = F.array_join(F.transform(entries, lambda entry: F.concat(F.lpad(F.hex(entry["bucket"]), 4, "0"), hex_rank(entry))), "")
    short = (encoding == SPARSE) & (F.size(entries) * SPARSE_BYTES < registers_of(precision))
    return F.struct(
        F.when(short, F.lit(SPARSE)).otherwise(F.lit(DENSE)).alias("encoding"), F.unhex(F.when(short, sparse).otherwise(dense)).alias("buckets")
    )


def larger_registers(one: Column, other: Column) -> Column:
    """Of two dense byte arrays the larger register, byte by byte."""

    def cells(packed: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(packed)), lambda i: F.substring(packed, i, F.lit(1)))

    both = lambda a, b: F.zip_with(cells(a), cells(b), lambda x, y: F.hex(F.greatest(x, y)))
    return F.unhex(F.array_join(_bound(one, lambda a: _bound(other, lambda b: both(a, b))), ""))


def stored_entries(buckets: Column, encoding: Column) -> Column:
    """The sorted ``bucket, rank`` entries of packed registers, zero ranks left out."""
    return _bound(buckets, lambda packed: _entries_of(packed, encoding))


def _entries_of(buckets: Column, encoding: Column) -> Column:
    number = lambda start, size: F.conv(F.hex(F.substring(buckets, start, F.lit(size))), 16, 10).cast("int")
    count = F.length(buckets)
    places = lambda n: F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    dense = F.transform(places(count), lambda i: F.struct(i.alias("bucket"), number(i + 1, 1).alias("rank")))
    dense = F.filter(dense, lambda entry: entry["rank"] > 0)
    at = lambda i: i * SPARSE_BYTES + 1
    sparse = F.transform(places(F.floor(count / SPARSE_BYTES)), lambda i: F.struct(number(at(i), 2).alias("bucket"), number(at(i) + 2, 1).alias("rank")))
    return F.when(encoding == SPARSE, sparse).otherwise(dense)


def unpack_registers(packed: DataFrame, by: Sequence[str]) -> DataFrame:
    """Long form of packed sketches, with one null-bucket row per sketch. Rows without ``hash`` or ``encoding`` are ``sha256`` and dense."""
    packed = described(packed)
    encoding = F.col("encoding") if "encoding" in packed.columns else F.lit(DENSE)
    entries = packed.select(*by, "precision", "hash", F.explode(stored_entries(F.col("buckets"), encoding)).alias("_entry"))
    header = packed.select(*by, "precision", "hash", F.lit(None).cast("int").alias("bucket"), F.lit(0).alias("rank"))
    return entries.select(*by, "precision", "hash", "_entry.bucket", "_entry.rank").unionByName(header)
