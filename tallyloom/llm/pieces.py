"""Encode whole texts by their space-separated pieces, with a bounded memory of pieces per Python worker.

Natural text repeats its words, and the encoders at hand never join symbols over a single space. So a text is cut
before single spaces and before line ends, each distinct piece is encoded once, and the results are put together.
A text that is not regular (two blanks in a row, a blank at its end and the like) is encoded whole: the result is
always that of the whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallyloom.llm.common import byte_blocks, text_blocks


class PieceCache:
    """Values of pieces by an encoder.

    ``encode`` maps strings to values and is called with the new pieces of a block of texts, each in the form that
    ``lead(piece, is_first)`` gives it, or None where the piece can't stand alone; ``whole`` gives the values of an irregular text.
    When ``limit`` pieces are known the memory starts afresh, so a worker never holds more.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], list[Any]],
        lead: Callable[[str, bool], str | None],
        whole: Callable[[str], list[Any]],
        limit: int = 500_000,
        longest: int = 48,
    ):
        self._encode, self._lead, self._whole = encode, lead, whole
        self._limit, self._longest = limit, longest
        self._known: dict[str, Any] = {}
        self._first: dict[str, Any] = {}

    def values(self, texts: list[str]) -> Iterator[list[Any]]:
        """For each text the values of its pieces in order."""
        for start, stop in text_blocks(texts):
            yield from self._block(texts[start:stop])

    def _block(self, texts: list[str]) -> Iterator[list[Any]]:
        rows = [text.replace("\n", " \n").split(" ") for text in texts]
        heads = self._learn({row[0] for row in rows}, self._first, True)
        found = []
        missing: set[str] = set()
        for row in rows:
            values = list(map(self._known.get, row))
            values[0] = heads.get(row[0])
            holes = [i for i, value in enumerate(values) if value is None] if None in values else []
            missing.update([row[i] for i in holes if i])
            found.append((values, holes))
        fresh = self._learn(missing, self._known, False) if missing else {}
        for text, row, (values, holes) in zip(texts, rows, found):
            for i in holes:
                if i and (value := fresh.get(row[i])) is not None:
                    values[i] = value
                else:
                    values = self._whole(text) if text else []
                    break
            yield values

    def _learn(self, pieces: set[str], known: dict[str, Any], first: bool) -> dict[str, Any]:
        fresh = {}
        ask = []
        for piece in pieces:
            if piece in known:
                fresh[piece] = known[piece]
            elif (form := self._lead(piece, first)) is not None:
                ask.append((piece, form))
        if ask:
            fresh.update(zip((piece for piece, _ in ask), self._encode([form for _, form in ask])))
            if len(known) + len(ask) > self._limit:
                known.clear()
            known.update((piece, fresh[piece]) for piece, _ in ask[: self._limit] if len(piece) <= self._longest)
        return fresh


def spaced(piece: str, first: bool) -> str | None:
    """The form of a piece for encoders that bind one space to the word after it.

    A text may be cut before a space that a non-blank follows, and around a line end that a non-blank follows.
    """
    if first:
        return piece
    if not piece or (piece[0].isspace() and (piece[0] != "\n" or len(piece) == 1 or piece[1].isspace())):
        return None
    return piece if piece[0] == "\n" else " " + piece


def gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``starts`` and hold ``counts`` values, one behind the other."""
    ends = np.cumsum(counts)
    return flat[np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)]


class Memory:
    """Distinct strings with the identifiers that ``encode`` gives them, in flat arrays that numpy can gather from.

    Arrow numbers the strings of a block together with those that are known, so no string is handled by Python. After a block that
    leaves more than ``limit`` strings, the half of the limit that was met most often stays.
    """

    def __init__(self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], limit: int):
        self._encode, self._limit = encode, limit
        self._known = pa.array([], pa.string())
        self._met = self.starts = self.counts = np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.uint32)

    def numbers(self, values: pa.Array) -> np.ndarray:
        """The number of every string; until the next call ``starts`` and ``counts`` have the place of its identifiers in ``flat``."""
        if len(self._known) > self._limit:
            self._keep(np.sort(np.argsort(-self._met, kind="stable")[: self._limit // 2]))
        held = len(self._known)
        numbered = pa.concat_arrays([self._known, values]).dictionary_encode()
        if len(numbered.dictionary) > held:
            flat, counts = self._encode(numbered.dictionary.slice(held))
            sizes = np.maximum(counts, 0)
            self.starts = np.append(self.starts, (len(self.flat) + np.cumsum(sizes) - sizes).astype(np.int32))
            self.counts = np.append(self.counts, counts.astype(np.int32))
            self.flat = np.append(self.flat, flat)
            self._known = numbered.dictionary
            self._met = np.append(self._met, np.zeros(len(counts), np.int32))
        which = numbered.indices.to_numpy()[held:]
        self._met += np.bincount(which, minlength=len(self._met)).astype(np.int32)
        return which

    def _keep(self, which: np.ndarray) -> None:
        sizes = np.maximum(self.counts[which], 0)
        self.flat = gather(self.flat, self.starts[which], sizes)
        self.counts, self._met = self.counts[which], self._met[which]
        self.starts = (np.cumsum(sizes) - sizes).astype(np.int32)
        self._known = self._known.take(pa.array(which))


class PieceTable:
    """Little-endian 32-bit identifiers of whole texts in Arrow arrays, by their distinct pieces.

    Texts are cut and their pieces numbered by Arrow; ``encode`` sees each new piece once, and numpy gathers the
    identifiers of a text from those of its pieces. ``encode`` gives the identifiers of pieces and their counts, -1 where a piece can't
    stand alone; texts with such a piece go to ``whole``.
    """

    FIRST = "\x02"  #: stands before the first piece of a text; a text that holds it itself is irregular

    def __init__(self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], whole: Callable[[list[str]], list[bytes]], limit: int = 800_000):
        self._pieces, self._whole = Memory(encode, limit), whole

    def encode(self, texts: pa.Array, block: int = 10_000_000) -> Iterator[bytes]:
        """The identifiers of every text; about ``block`` bytes are worked on at a time."""
        for start, stop in byte_blocks(texts, block):
            yield from self._block(texts.slice(start, stop - start))
            pa.default_memory_pool().release_unused()

    def _block(self, texts: pa.Array) -> list[bytes]:
        marked = pc.binary_join_element_wise(self.FIRST, pc.replace_substring(texts, "\n", " \n"), "")
        lists = pc.split_pattern(marked, " ")
        offsets = lists.offsets.to_numpy()
        which = self._pieces.numbers(lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0])))
        offsets = offsets - offsets[0]
        found: list[bytes] = []
        bad = np.zeros(len(texts), bool)
        for first in range(0, len(texts), 500):  # a bounded number of identifiers at a time
            edges = offsets[first : first + 501]
            here = which[edges[0] : edges[-1]]
            alone = self._pieces.counts[here]
            counts = np.maximum(alone, 0)
            ends = np.append(0, np.cumsum(counts))
            ids = memoryview(gather(self._pieces.flat, self._pieces.starts[here], counts)).cast("B")
            bounds = (4 * ends[edges - edges[0]]).tolist()
            found += [bytes(ids[a:b]) for a, b in zip(bounds, bounds[1:])]
            odd = np.append(0, np.cumsum(alone < 0))[edges - edges[0]]
            bad[first : first + 500] = odd[1:] > odd[:-1]
        marks = pc.match_substring(texts, self.FIRST).to_numpy(zero_copy_only=False)
        whole = np.flatnonzero(bad | marks).tolist()
        for i, value in zip(whole, self._whole([texts[i].as_py() for i in whole]) if whole else []):
            found[i] = value
        return found
