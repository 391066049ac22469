"""Best-fit packing by exact complements: combinations of lengths that fill a sequence to its end go first, then the best fit."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import tokenizer_path, whole_texts
from tallyloom.llm.encoders import library_encoder
from tallyloom.session import materialize

#: Sequences of one make: how many, and the length and copies of what each of them holds, in order.
Pattern = tuple[int, tuple[tuple[int, int], ...]]


class SumIndex:
    """Which sums of one, two and three lengths can be made of those that are left; every sum is a bit of an integer.

    A sum that is marked may still ask for a length more often than it is left, so what is found is checked against the counts.
    """

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self._lengths: list[int] | None = None
        self._sums = (0, 0, 0)

    def take(self, parts: Counter, times: int) -> None:
        for length, copies in parts.items():
            self.counts[length] -= copies * times
            if not self.counts[length]:
                self._lengths = None

    def enough(self, parts: Counter) -> int:
        """How often the counts suffice for these parts."""
        return min(int(self.counts[length]) // copies for length, copies in parts.items())

    def _refresh(self) -> None:
        if self._lengths is None:
            self._lengths = np.flatnonzero(self.counts)[::-1].tolist()
            mask = (1 << len(self.counts)) - 1
            single = sum(1 << length for length in self._lengths)
            pair = triple = 0
            for length in self._lengths:
                pair |= single << length & mask
            for length in self._lengths:
                triple |= pair << length & mask
            self._sums = (single, pair, triple)

    def complement(self, length: int, most: int = 3) -> Counter | None:
        """``length`` and one, two or three more, ``most`` at the most, that fill the gap exactly, the largest first; None if there is no such combination."""
        self._refresh()
        gap = len(self.counts) - 1 - length
        for others in range(most):
            if self._sums[others] >> gap & 1 and (found := self._search(Counter([length]), gap, others, length)):
                return found
        return None

    def _search(self, parts: Counter, gap: int, others: int, most: int) -> Counter | None:
        """``parts`` and ``others + 1`` lengths up to ``most`` that make ``gap``."""
        if not others:
            found = parts + Counter([gap])
            return found if gap <= most and self.enough(found) else None
        for length in self._lengths:
            if length * (others + 1) < gap:
                break
            if length <= most and length < gap and self._sums[others - 1] >> (gap - length) & 1:
                more = parts + Counter([length])
                if self.enough(more) and (found := self._search(more, gap - length, others - 1, length)):
                    return found
        return None


def plan_sequences(counts: Mapping[int, int], limit: int) -> list[Pattern]:
    """Sequences of at most ``limit`` for ``counts`` items of each length.

    From the longest on, a length and one, two or three shorter ones that fill the sequence to its end are used as often as the
    counts allow. Of the residuals, again from the longest on, each goes where the least room that is enough for it is left. Combinations of
    several may use up what long lengths need to themselves, so plans with combinations up to each size are made, and the shortest one is
    taken. Work and size depend on the number of lengths and hardly on the counts.
    """
    return min((_plan(counts, limit, most) for most in (3, 2, 1)), key=lambda patterns: sum(times for times, _ in patterns))


def _plan(counts: Mapping[int, int], limit: int, most: int) -> list[Pattern]:
    left = np.zeros(limit + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    index = SumIndex(left)
    patterns: list[Pattern] = [(int(left[limit]), ((limit, 1),))] if left[limit] else []
    left[limit] = 0
    for length in range(limit - 1, 0, -1):
        while left[length] and (parts := index.complement(length, most)):
            times = index.enough(parts)
            index.take(parts, times)
            patterns.append((times, tuple(sorted(parts.items(), reverse=True))))
    return patterns + _best_fit(left, limit)


def _best_fit(left: np.ndarray, limit: int) -> list[Pattern]:
    """Best fit in decreasing order; equal sequences are kept together, by the room that is left in them."""
    rooms: list[int] = []
    made: dict[int, list[Pattern]] = {}

    def put(room: int, times: int, parts: tuple) -> None:
        if times:
            if room not in made:
                insort(rooms, room)
            made.setdefault(room, []).append((times, parts))

    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            place = bisect_left(rooms, length)
            room, times, parts = limit, n, ()
            if place < len(rooms):
                room = rooms[place]
                times, parts = made[room].pop()
                if not made[room]:
                    del made[room], rooms[place]
            copies = room // length
            whole = min(times, n // copies)
            put(room - copies * length, whole, (*parts, (length, copies)))
            n -= whole * copies
            times -= whole
            if times and n and n < copies:
                put(room - n * length, 1, (*parts, (length, n)))
                times -= 1
                n = 0
            if parts:
                put(room, times, parts)
    return [pattern for group in made.values() for pattern in group]


class Placement:
    """Where the item of a length and rank goes, looked up in the plan."""

    _RANKS = 44  #: bits of a rank

    def __init__(self, patterns: list[Pattern]):
        used: Counter = Counter()
        rows, base = [], 0
        for times, parts in patterns:
            offset = 0
            for length, copies in parts:
                rows.append((length << self._RANKS | used[length], copies, base, offset))
                used[length] += copies * times
                offset += copies * length
            base += times
        self._rows = np.array(sorted(rows), np.int64).reshape(-1, 4).T

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequences and offsets."""
        asked = length << self._RANKS | rank
        keys, copies, base, offset = self._rows
        row = np.searchsorted(keys, asked, "right") - 1
        nth = asked - keys[row]
        return base[row] + nth // copies[row], offset[row] + nth % copies[row] * length


def pack_best_fit(items: DataFrame, limit: int, length: str = "length") -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset`` in sequences of at most ``limit``, all items in one plan.

    The items are written once with the task that wrote them, so an executor may be lost. The counts by length, ``limit`` rows at most, give
    the plan; the items of one length and task are numbered together, the counts by length and task make that a rank among all of the
    length, and the rank has its place in the plan. So a length that a third of all rows share is dealt out by tasks, and what the driver holds depends on
    ``limit`` alone. Sequences are numbered from 0.

    A length that is null, below 1 or above ``limit`` fails the job. Repeated rows are packed each; an empty table gives no rows; other columns are
    kept, but those named ``sequence_id`` and ``offset`` are replaced.
    """
    names = [name for name in items.columns if name not in ("sequence_id", "offset")]
    valid = F.coalesce(F.col(length).cast("long").between(1, limit), F.lit(False))
    refused = F.raise_error(F.concat(F.lit("cannot pack the length "), F.coalesce(F.col(length).cast("string"), F.lit("null")))).cast("long")
    sized = items.select(*names, F.when(valid, F.col(length).cast("long")).otherwise(refused).alias("_size"), F.spark_partition_id().alias("_part"))
    written = materialize(sized, "exact-fill-items")
    counts = written.groupBy("_size", "_part").agg(F.count(F.lit(1)).alias("n"))
    totals = {row["_size"]: row["n"] for row in counts.groupBy("_size").agg(F.sum("n").alias("n")).collect()}
    placement = Placement(plan_sequences(totals, limit))
    before = Window.partitionBy("_size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("_size", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    # Rows of one length and task are few; any fixed order will do.
    own = Window.partitionBy("_size", "_part").orderBy(F.xxhash64(*names))
    numbered = written.withColumn("_nth", F.row_number().over(own) - 1)
    ranked = numbered.join(first, ["_size", "_part"]).select(*names, "_size", (F.col("_first") + F.col("_nth")).cast("long").alias("_rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = placement.place(batch.column(len(names)).to_numpy(), batch.column(len(names) + 1).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *map(pa.array, found)], names=[*names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{name}` {items.schema[name].dataType.simpleString()}" for name in names)
    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def token_pieces(docs: DataFrame, limit: int = 2048, vocabulary: str | None = None, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``key, piece, start, length, ids``: whole texts as identifiers, ended with ``end_id``, in pieces of at most ``limit``.

    Only texts with more are cut, all pieces but the first into ``limit`` each. Null and empty texts are the end identifier alone; repeated rows come out
    each; an empty table gives no rows; other columns are not read.
    """
    vocabulary = vocabulary or tokenizer_path("byte_bpe_50k.json")
    end = int(end_id).to_bytes(4, "little")
    slim = whole_texts(docs, key, text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(vocabulary)
        for batch in batches:
            owner, piece, start, length, ids = [], [], [], [], []

            def rows(owner=owner, piece=piece, start=start, length=length, ids=ids, batch=batch) -> pa.RecordBatch:
                columns = [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())]
                return pa.RecordBatch.from_arrays(columns, names=[key, "piece", "start", "length", "ids"])

            for i, value in enumerate(encoder.encode(batch.column(1))):
                value += end
                total = len(value) // 4
                at = 0
                for number, stop in enumerate(range((total - 1) % limit + 1, total + 1, limit)):
                    owner.append(i)
                    piece.append(number)
                    start.append(at)
                    length.append(stop - at)
                    ids.append(value[4 * at : 4 * stop])
                    at = stop
                if len(owner) >= 2000:
                    yield rows()
                    for column in (owner, piece, start, length, ids):
                        column.clear()
            if owner:
                yield rows()

    return slim.mapInArrow(cut, f"`{key}` {slim.schema[key].dataType.simpleString()}, piece int, start long, length long, ids binary")
