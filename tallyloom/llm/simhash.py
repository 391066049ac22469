"""Near duplicates by SimHash fingerprints with multi-index hashing over their segments."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import whole_texts
from tallyloom.llm.components import connected_components
from tallyloom.session import materialize

WIDTH = 64


def fingerprint(text: str, words: int = 5, seed: int = 42) -> int:
    """The fingerprint of a whole text as an unsigned integer, bit 0 the lowest.

    Letters A-Z are lowered, words end at ASCII white space, shingles of ``words`` words are joined by a space and counted as often as they
    occur; fewer words are one shingle, none give zero. A bit is set if it is set in over half the XXH64 hashes.
    """
    tokens = text.encode().lower().split()
    n = len(tokens)
    if not n:
        return 0
    joined = b" ".join(tokens)
    digest = xxhash.xxh64_intdigest
    if n <= words:
        return digest(joined, seed)
    sizes = np.fromiter(map(len, tokens), np.int64, n)
    stops = np.cumsum(sizes + 1) - 1
    starts = (stops - sizes)[: n - words + 1].tolist()
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops[words - 1 :].tolist())], "<u8")
    set_bits = np.zeros(WIDTH, np.int64)
    for at in range(0, len(hashes), 4096):
        set_bits += np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 5, seed: int = 42, key: str = "doc_id", text: str = "text", mark: str | None = None) -> DataFrame:
    """Rows ``key, fingerprint`` (the 64 bits as a signed long) of every text, with the column ``mark`` between them if one is named."""
    slim = whole_texts(docs, key, text, *([mark] if mark else []))
    names = [key, *([mark] if mark else [])]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(value.as_py(), words, seed) for value in batch.column(1)), np.uint64, batch.num_rows)
            kept = [column for i, column in enumerate(batch.columns) if i != 1]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(values.view(np.int64))], names=[*names, "fingerprint"])

    kinds = ", ".join(f"`{name}` {slim.schema[name].dataType.simpleString()}" for name in names)
    return slim.mapInArrow(of, f"{kinds}, fingerprint long")


def segment_bounds(segments: int) -> list[tuple[int, int]]:
    """Lowest bit and width of nearly equal segments of the fingerprint."""
    edges = [WIDTH * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _segment(column: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(column, low).bitwiseAND(F.lit((1 << width) - 1))


def _entries(rows: DataFrame, segments: int, radius: int | None = None) -> DataFrame:
    """A row per segment, or per element of the Hamming ball around each segment."""

    def ball(number: int, low: int, width: int) -> Column:
        masks = [0] if radius is None else [sum(1 << bit for bit in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]
        value = _segment(F.col("fingerprint"), low, width)
        masks = F.array(*[F.lit(mask).cast("long") for mask in masks])
        return F.transform(masks, lambda mask: F.struct(F.lit(number).alias("segment"), value.bitwiseXOR(mask).alias("value")))

    balls = [ball(number, low, width) for number, (low, width) in enumerate(segment_bounds(segments))]
    return rows.select("*", F.explode(F.flatten(F.array(*balls))).alias("entry")).select(*rows.columns, "entry.segment", "entry.value")


def link_fingerprints(distinct: DataFrame, distance: int = 4, segments: int = 3) -> DataFrame:
    """Rows ``node, component`` of those fingerprints in ``distinct`` that link with another one at ``distance`` or fewer bits.

    Of two such fingerprints at least one segment differs in ``distance // segments`` bits at most, so the ball of that radius around it
    holds the other's. First every fingerprint is tried against the smallest of its own table slots, which joins large groups of near
    copies in few links. Then all balls are looked up; a match counts if it is from another component so far and the whole distance is
    within the bound. So pairs within a group aren't listed, and no link between groups is lost.
    """
    distance_of = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b)))
    slots = _entries(distinct.select("fingerprint"), segments)
    first = slots.groupBy("segment", "value").agg(F.min("fingerprint").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    tried = slots.join(first, ["segment", "value"]).where((F.col("fingerprint") != F.col("first")) & (distance_of("fingerprint", "first") <= distance))
    begun = connected_components(tried.select(F.col("fingerprint").alias("a"), F.col("first").alias("b")), "simhash-begun")
    begun = begun.withColumnRenamed("node", "fingerprint")
    labelled = distinct.select("fingerprint").join(begun, "fingerprint", "left")
    labelled = materialize(labelled.withColumn("component", F.coalesce("component", "fingerprint")), "simhash-labelled")
    table = _entries(labelled.select(F.col("fingerprint"), F.col("component")), segments)
    balls = _entries(labelled, segments, distance // segments)
    table = table.withColumnsRenamed({"fingerprint": "other", "component": "other_component"})
    found = balls.join(table, ["segment", "value"]).where(
        (F.col("fingerprint") < F.col("other")) & (F.col("component") != F.col("other_component")) & (distance_of("fingerprint", "other") <= distance)
    )
    links = found.select(F.col("component").alias("a"), F.col("other_component").alias("b")).distinct()
    known = labelled.where("fingerprint <> component").select(F.col("fingerprint").alias("a"), F.col("component").alias("b"))
    return connected_components(links.unionByName(known), "simhash")


def fingerprint_groups(
    docs: DataFrame, words: int = 5, distance: int = 4, segments: int = 3, seed: int = 42, key: str = "doc_id", text: str = "text", mark: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The written rows of :func:`fingerprints`, and ``fingerprint, smallest, component`` of every distinct one.

    Here a component is named by its smallest fingerprint, so that groups without any key are told apart; ``smallest`` is the smallest key of
    the fingerprint, null if it has none.
    """
    prints = materialize(fingerprints(docs, words, seed, key, text, mark), "simhash-prints")
    distinct = materialize(prints.groupBy("fingerprint").agg(F.min(key).alias("smallest")), "simhash-distinct")
    linked = link_fingerprints(distinct, distance, segments).withColumnRenamed("node", "fingerprint")
    return prints, distinct.join(linked, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))


def near_duplicates(docs: DataFrame, words: int = 5, distance: int = 4, segments: int = 3, seed: int = 42, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``key, fingerprint, component``: a component is the smallest key that links reach.

    Equal texts share a fingerprint, so copies cost one row each and are never paired. Null and empty texts have fingerprint zero and link like any
    other. A row without a key has the smallest key of its component, null if there is none. Repeated rows come out repeated, an empty table
    gives no rows, other columns are not read.
    """
    prints, groups = fingerprint_groups(docs, words, distance, segments, seed, key, text)
    names = groups.groupBy("component").agg(F.min("smallest").alias("name"))
    named = groups.join(names, "component").select("fingerprint", F.col("name").alias("component"))
    return prints.join(named, "fingerprint").select(key, "fingerprint", "component")


def one_of_each_group(docs: DataFrame, words: int = 5, distance: int = 4, segments: int = 3, seed: int = 42, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each group of near duplicates one whole row: that with the smallest key, without a key only if no row of the group has one.

    Of rows that differ in text alone under that key one stays, and rows that agree in key and text are one row. An empty table gives no rows.
    """
    mark = "_row_of_key_and_text"
    row = F.sha2(F.concat_ws("\x00", F.col(key).isNull().cast("string"), F.col(key).cast("string"), F.col(text).isNull().cast("string"), F.col(text)), 256)
    marked = docs.withColumn(mark, row)
    prints, groups = fingerprint_groups(marked, words, distance, segments, seed, key, text, mark)
    member = prints.select(F.col(key).isNull().alias("keyless"), F.col(key).alias("of"), mark, "fingerprint")
    first = F.min(F.struct("keyless", "of", mark)).alias("first")
    # Copies are combined by fingerprint before they meet their groups.
    firsts = member.groupBy("fingerprint").agg(first).join(groups.select("fingerprint", "component"), "fingerprint")
    kept = firsts.groupBy("component").agg(F.min("first").alias("first")).select(F.col(f"first.{mark}").alias(mark))
    return marked.join(kept, mark, "left_semi").dropDuplicates([mark]).select(*docs.columns)
