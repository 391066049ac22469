"""Periodic runs of words, caught online by dyadic blocks, and texts with those runs collapsed to one period."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tallyloom.llm.common import byte_blocks, whole_texts
from tallyloom.llm.pieces import gather


def _mixed(values: np.ndarray) -> np.ndarray:
    """64-bit integers spread over all bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class SquareCatcher:
    """Catches the squares of a growing sequence of word numbers and merges them into stretches of one period.

    Level ``k`` cuts the sequence into blocks of ``2 ** k`` words. Every completed block sets a catcher for the periods of that level, from
    ``2 ** k`` up to twice that. Each appended word completes one window of every level. If the window equals the block of the catcher that
    waits for it, a square is in the making: comparisons of ever shorter suffixes and prefixes give the whole stretch with that period, which
    is kept from two periods on. A stretch that reaches the last word is compared further when words are appended. Windows are compared by
    64-bit names, each made of the two halves' names.

    A stretch of three periods holds a whole block of its level with the window one period later, so none is missed, and however the sequence is cut into
    calls of :meth:`append`, those stretches are the same. Memory is eight bytes a word and level, and there are no more levels than
    stretches up to ``longest`` words ask for; time is that of a few numpy operations a word and level.
    """

    def __init__(self, min_exponent: float = 4, longest: int | None = None, seed: int = 0):
        if min_exponent < 3:
            raise ValueError("runs of less than three periods are not all caught")
        self._least, self._longest = min_exponent, longest
        self._seed = np.uint64(seed * 2 + 1)
        self._names: list[np.ndarray] = []
        self._filled: list[int] = []
        self._size = 0
        none = np.zeros(0, np.int64)
        self._start, self._end, self._period = none, none, none

    def append(self, words: np.ndarray) -> None:
        """Take the next words, given as integers."""
        if not len(words):
            return
        before, self._size = self._size, self._size + len(words)
        reach = self._size if self._longest is None else min(self._size, self._longest)
        levels = max(1, int(reach / self._least).bit_length())
        fresh: list[tuple[int, int]] = []
        for k in range(max(levels, len(self._names))):
            if k == len(self._names):
                self._names.append(np.zeros(0, np.uint64))
                self._filled.append(0)
            first, stop = self._filled[k], max(self._size - (1 << k) + 1, 0)
            fresh.append((first, stop))
            if stop > first:
                self._room(k, stop)
                if k:
                    below, half = self._names[k - 1], 1 << (k - 1)
                    left, right = below[first:stop], below[first + half : stop + half]
                    self._names[k][first:stop] = _mixed(left * np.uint64(0x9E3779B97F4A7C15) + _mixed(right + self._seed))
                else:
                    self._names[k][first:stop] = _mixed(words.astype(np.uint64) + self._seed)
                self._filled[k] = stop
        open_ = np.flatnonzero(self._end == before)
        self._end[open_] += self._forward(self._end[open_] - self._period[open_], self._end[open_])
        for k, (first, stop) in enumerate(fresh):
            self._catch(k, first, stop)

    def _room(self, k: int, size: int) -> None:
        if size > len(self._names[k]):
            grown = np.zeros(size if not len(self._names[k]) else max(size, 2 * len(self._names[k])), np.uint64)
            grown[: self._filled[k]] = self._names[k][: self._filled[k]]
            self._names[k] = grown

    def _catch(self, k: int, first: int, stop: int) -> None:
        """Compare the windows of one level that were completed last with the blocks before theirs, whose catchers wait for them."""
        names = self._names[k]
        at = np.arange(max(first, 1 << k), stop)
        block = ((at >> k) - 1) << k
        hit = names[at] == names[block]
        block, at = block[hit], at[hit]
        # Within a stretch of a smaller level the square has a smaller period, too.
        fresh = ~self._within(block, at + (1 << k), self._period < 1 << k)
        block, at = block[fresh], at[fresh]
        start = block - self._backward(block, at)
        end = at + self._forward(block, at)
        kept = (end - start >= 2 * (at - block)) | (end == self._size)
        self._add(start[kept], end[kept], (at - block)[kept])

    def _within(self, start: np.ndarray, end: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Which ranges lie within one of the chosen stretches."""
        firsts, lasts = self._start[chosen], self._end[chosen]
        if not len(firsts):
            return np.zeros(len(start), bool)
        order = np.argsort(firsts, kind="stable")
        firsts, lasts = firsts[order], np.maximum.accumulate(lasts[order])
        place = np.searchsorted(firsts, start, "right") - 1
        return (place >= 0) & (lasts[np.maximum(place, 0)] >= end)

    def _add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        if len(start):
            rows = np.stack([np.append(self._start, start), np.append(self._period, period), np.append(self._end, end)], axis=1)
            self._start, self._period, self._end = np.ascontiguousarray(np.unique(rows, axis=0).T)

    def _forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` and from the later ``b`` on agree."""
        got = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self._names))):
            names, going = self._names[k], np.arange(len(a))
            while len(going):
                going = going[b[going] + got[going] < self._filled[k]]
                going = going[names[a[going] + got[going]] == names[b[going] + got[going]]]
                got[going] += 1 << k
                if k + 1 < len(self._names):
                    break
        return got

    def _backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before ``a`` and before the later ``b`` agree."""
        got = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self._names))):
            names, going = self._names[k], np.arange(len(a))
            while len(going):
                going = going[a[going] - got[going] >= 1 << k]
                at = got[going] + (1 << k)
                going = going[names[a[going] - at] == names[b[going] - at]]
                got[going] += 1 << k
                if k + 1 < len(self._names):
                    break
        return got

    def stretches(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and smallest period of the stretches so far of ``min_exponent`` periods or more (shorter ones may be left out)."""
        return self._start, self._end, self._period


def find_runs(words: np.ndarray, min_exponent: float = 4, min_length: int = 6, longest: int | None = None) -> np.ndarray:
    """Rows ``start, length, period`` of all runs of a sequence of integers, by start, then period.

    A run is a stretch with smallest period ``period`` that no neighbouring word extends, of ``min_exponent`` periods and ``min_length``
    words at least. ``longest`` is a bound of the length of runs where one is known. Every stretch found by names is held against the words themselves; should two
    different windows ever share a name, the names are made anew.
    """
    for seed in count():
        catcher = SquareCatcher(min_exponent, longest, seed)
        catcher.append(words)
        start, end, period = catcher.stretches()
        size = end - start - period
        everything = np.arange(len(words))
        if np.array_equal(words[gather(everything, start, size)], words[gather(everything, start + period, size)]):
            break
    long = (end - start >= min_length) & (end - start >= min_exponent * period)
    runs = np.stack([start, end - start, period], axis=1)[long]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def periodic_runs(docs: DataFrame, min_exponent: float = 4, min_length: int = 6, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``key, n_words, runs, collapsed`` of every whole text.

    Words are what ASCII white space separates. ``runs`` is an array of ``start, length, period`` in words, by start, then period.
    ``collapsed`` joins by one space the words that no run contains after its first period. Null and empty texts have no words, no runs and an empty
    ``collapsed``; rows are independent of each other, so repeated rows and null keys come out as they are; an empty table gives no rows; other columns
    are not read. Memory is about eight bytes a word and level of the longest text of a block.
    """
    slim = whole_texts(docs, key, text)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in byte_blocks(batch.column(1), 6_000_000):
                columns = _block(batch.column(1).slice(start, stop - start), min_exponent, min_length)
                names = [key, "n_words", "runs", "collapsed"]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), *columns], names=names)

    kind = slim.schema[key].dataType.simpleString()
    return slim.mapInArrow(of, f"`{key}` {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def _block(texts: pa.Array, min_exponent: float, min_length: int) -> list[pa.Array]:
    """Numbers of words, runs and collapsed texts of some texts, in one sequence with a separator of its own behind each text."""
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy()
    cut = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    filled = pc.not_equal(pc.binary_length(cut), 0)  # the cut leaves empty strings at the ends of a text
    words = cut.filter(filled)
    bounds = np.append(0, np.cumsum(filled.to_numpy(zero_copy_only=False)))[offsets - offsets[0]]
    n_words = np.diff(bounds)
    numbers = words.dictionary_encode().indices.to_numpy()
    texts_of = np.repeat(np.arange(len(texts)), n_words)
    sequence = np.empty(len(words) + len(texts), np.int64)
    sequence[np.arange(len(words)) + texts_of] = numbers
    sequence[bounds[1:] + np.arange(len(texts))] = -1 - np.arange(len(texts))
    runs = find_runs(sequence, min_exponent, min_length, int(n_words.max(initial=0)))
    firsts = bounds[:-1] + np.arange(len(texts))
    owner = np.searchsorted(firsts, runs[:, 0], "right") - 1
    inside = np.zeros(len(sequence) + 1, np.int64)
    np.add.at(inside, runs[:, 0] + runs[:, 2], 1)
    np.add.at(inside, runs[:, 0] + runs[:, 1], -1)
    kept = (np.cumsum(inside)[:-1] == 0)[np.arange(len(words)) + texts_of]
    kept_bounds = np.append(0, np.cumsum(kept))[bounds]
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept_bounds.astype(np.int32)), words.filter(pa.array(kept))), " ")
    fields = [pa.array(runs[:, 0] - firsts[owner]), pa.array(runs[:, 1]), pa.array(runs[:, 2])]
    run_bounds = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
    listed = pa.ListArray.from_arrays(pa.array(run_bounds), pa.StructArray.from_arrays(fields, names=["start", "length", "period"]))
    return [pa.array(n_words), listed, collapsed]
