"""Pack token sequences under simultaneous limits by the dot-product heuristic of vector bin packing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import tokenizer_path, whole_texts
from tallyloom.llm.encoders import library_encoder

_FIELDS = "start long, length long, doc_tokens long, loss_tokens long, sequence_id long, offset long, ids binary"


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 1024
    segments: int = 256
    loss: int = 1024


@dataclass
class Piece:
    """Neighbouring identifiers of one example, from ``start`` to ``stop``; ``bears`` has the running number of those that bear loss, from 0 on.

    A cut shares the example's identifiers and running numbers, so a text of any length is cut in linear time.
    """

    key: object
    start: int
    stop: int
    all_ids: memoryview
    bears: np.ndarray

    @property
    def ids(self) -> bytes:
        return bytes(self.all_ids[4 * self.start : 4 * self.stop])

    @property
    def total(self) -> int:
        return len(self.all_ids) // 4

    def demand(self) -> tuple[int, int, int]:
        return self.stop - self.start, 1, int(self.bears[self.stop] - self.bears[self.start])

    def cut(self, tokens: int, loss: int) -> tuple[Piece, Piece] | None:
        """The longest beginning within both bounds, and the rest; None if not even one identifier fits."""
        reach = min(self.start + tokens, self.stop)
        bears = self.bears[self.start : reach + 1]
        at = self.start + int(np.searchsorted(bears, bears[0] + loss, "right")) - 1
        if at <= self.start:
            return None
        return Piece(self.key, self.start, at, self.all_ids, self.bears), Piece(self.key, at, self.stop, self.all_ids, self.bears)


class Packer:
    """Packs a stream of examples; at most ``pending`` pieces wait, so memory is bounded.

    A sequence is filled with the waiting piece whose demand has the largest dot product with what is left, both in
    shares of the limits, among those that fit whole. When none fits, the best one is cut to fill the rest. At the end of the stream less
    than a sequence is left; it goes into sequences of powers of two.
    """

    def __init__(self, limits: Limits, pending: int = 1024):
        if min(limits.tokens, limits.segments, limits.loss) < 1:
            raise ValueError("limits must be positive")
        self._limits, self._pending = limits, pending
        self._caps = np.array([limits.tokens, limits.segments, limits.loss], np.float64)
        self._pieces: list[Piece] = []
        self._demand = np.zeros((0, 3))

    def pack(self, examples: Iterable[tuple[object, bytes, np.ndarray]]) -> Iterator[list[Piece]]:
        """Sequences as lists of pieces."""
        fresh: list[Piece] = []
        for key, ids, mask in examples:
            rest = Piece(key, 0, len(mask), memoryview(ids), np.append(0, np.cumsum(mask, dtype=np.int64)))
            size, _, loss = rest.demand()
            while size >= self._limits.tokens or loss > self._limits.loss:
                first, rest = rest.cut(self._limits.tokens, self._limits.loss)
                if first.stop - first.start == self._limits.tokens:
                    yield [first]
                else:
                    fresh.append(first)
                size, _, loss = rest.demand()
            if size:
                fresh.append(rest)
            if len(fresh) >= self._pending:
                self._add(fresh)
                fresh = []
                while len(self._pieces) > self._pending // 4:
                    yield self._fill(self._limits.tokens)
        self._add(fresh)
        while self._pieces:
            left = int(self._demand[:, 0].sum())
            yield self._fill(self._limits.tokens if left >= self._limits.tokens else 1 << (left.bit_length() - 1))

    def _add(self, pieces: list[Piece]) -> None:
        if pieces:
            self._pieces += pieces
            self._demand = np.concatenate([self._demand, np.array([piece.demand() for piece in pieces], np.float64)])

    def _fill(self, tokens: int) -> list[Piece]:
        left = np.array([tokens, self._limits.segments, self._limits.loss], np.float64)
        taken: list[Piece] = []
        gone = np.zeros(len(self._pieces), bool)
        shares = self._demand / self._caps
        while left[0] and left[1]:
            score = shares @ (left / self._caps)
            fits = (self._demand <= left).all(axis=1) & ~gone
            if fits.any():
                best = int(np.argmax(np.where(fits, score, -1)))
                taken.append(self._pieces[best])
                left -= self._demand[best]
                gone[best] = True
                continue
            parts = None
            for best in np.argsort(np.where(gone, -1, score))[::-1].tolist():
                if gone[best]:
                    break
                if parts := self._pieces[best].cut(int(left[0]), int(left[2])):
                    break
            if not parts:
                break
            taken.append(parts[0])
            left -= parts[0].demand()
            self._pieces[best] = parts[1]
            self._demand[best] = parts[1].demand()
            shares[best] = self._demand[best] / self._caps
        kept = np.flatnonzero(~gone)
        self._pieces = [self._pieces[i] for i in kept.tolist()]
        self._demand = self._demand[kept]
        return taken


def _sequences(examples: Iterable[tuple[object, bytes, np.ndarray]], limits: Limits, key: str, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Record batches of pieces; a task numbers its sequences from its own base."""
    number = TaskContext.get().partitionId() << 33
    rows: list[tuple] = []
    names = [key, "start", "length", "doc_tokens", "loss_tokens", "sequence_id", "offset", "ids"]
    kinds = [kind, *[pa.int64()] * 6, pa.binary()]

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column, of) for column, of in zip(zip(*rows), kinds)], names=names)

    for sequence in Packer(limits).pack(examples):
        offset = 0
        for piece in sequence:
            length, _, loss = piece.demand()
            rows.append((piece.key, piece.start, length, piece.total, loss, number, offset, piece.ids))
            offset += length
        number += 1
        if len(rows) >= 4000:
            yield batch()
            rows = []
    if rows:
        yield batch()


def pack_documents(docs: DataFrame, limits: Limits = Limits(), vocabulary: str | None = None, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode whole texts, end each with ``end_id``, and pack them; a row per piece with its identifiers.

    Every task packs its own documents, so nothing is shuffled and a lost task is simply done again. All identifiers
    but a document's first bear loss. Null and empty texts are the end identifier alone; repeated rows are packed
    each; an empty table gives no rows; other columns are not read.
    """
    vocabulary = vocabulary or tokenizer_path("byte_bpe_50k.json")
    end = int(end_id).to_bytes(4, "little")
    slim = whole_texts(docs, key, text)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(vocabulary)
        first = next(batches, None)
        if first is None:
            return

        def rows():
            for batch in chain([first], batches):
                for name, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                    mask = np.ones(len(ids) // 4 + 1, np.uint8)
                    mask[0] = 0
                    yield name, ids + end, mask

        yield from _sequences(rows(), limits, key, first.column(0).type)

    return slim.mapInArrow(pack, f"`{key}` {slim.schema[key].dataType.simpleString()}, {_FIELDS}")


def pack_examples(examples: DataFrame, limits: Limits = Limits(), key: str = "example_id", ids: str = "ids", loss: str = "loss") -> DataFrame:
    """Pack instruction examples: ``ids`` is an array of identifiers, ``loss`` an array of booleans for those that bear loss.

    Examples that exceed a limit are cut. A null ``loss`` means that every identifier bears loss, a null in it or a missing end counts as
    false. Null and empty ``ids`` give no piece; null identifiers are refused by the cast of the task.
    """
    slim = examples.select(
        F.col(key), F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>")).alias("ids"), F.col(loss).cast("array<boolean>").alias("loss")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return

        def rows():
            for batch in chain([first], batches):
                for name, values, bears in zip(*(column.to_pylist() for column in batch.columns)):
                    mask = np.zeros(len(values), np.uint8)
                    flags = [True] * len(values) if bears is None else bears[: len(values)]
                    mask[: len(flags)] = [bool(flag) for flag in flags]
                    yield name, np.array(values, "<i4").tobytes(), mask

        yield from _sequences(rows(), limits, key, first.column(0).type)

    return slim.mapInArrow(pack, f"`{key}` {slim.schema[key].dataType.simpleString()}, {_FIELDS}")
