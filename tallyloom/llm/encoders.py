"""Encoders of the tokenizers library, one per vocabulary file and Python worker."""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a Spark task is one thread

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
import pyarrow.compute as pc  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from tallyloom.llm.pieces import Memory, PieceTable, gather, spaced  # noqa: E402

#: A word of plain letters, with a line end before and ASCII punctuation after it. The patterns of the vocabularies cut
#: between the three, so words and punctuation are encoded once for all the pieces that share them.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_PLAIN = rf"^\n?[{_LETTERS}]+[!-/:-@\[-`{{-~]*$"
_BEFORE_PUNCTUATION = rf"^\n?[{_LETTERS}]+"


class LibraryEncoder:
    """Identifiers of whole texts as the library gives them, without added special tokens, as little-endian 32-bit integers."""

    def __init__(self, path: str, limit: int = 800_000, together: int = 200):
        self._tokenizer = Tokenizer.from_file(path)
        self._pieces = PieceTable(self._encode, self._of_library, limit)
        self._words = Memory(self._of_words, limit)
        self._marks_after = Memory(lambda values: self._flat(self._of_library(values.to_pylist())), limit)
        self._together = together
        vocabulary = sorted(self._tokenizer.get_vocab().items(), key=lambda item: item[1])
        ends = any(token.endswith("</w>") for token, _ in vocabulary)
        #: Tokens with which a word and the space or line end before it begin, or, where the vocabulary marks the ends of words, end.
        self._marks = np.array([token.endswith("</w>") if ends else token.startswith(("Ġ", "Ċ")) for token, _ in vocabulary])
        self._marks_ends = ends
        self._folds = self._of_library([" ÀThe"]) == self._of_library(["àthe"])  # case and spaces don't matter to it

    def _of_library(self, forms: list[str]) -> list[bytes]:
        return [array("I", found.ids).tobytes() for found in self._tokenizer.encode_batch_fast(forms, add_special_tokens=False)]

    @staticmethod
    def _flat(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(values), "<u4"), np.fromiter(map(len, values), np.int64, len(values)) // 4

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of distinct words of plain letters, many in one text that is cut again where a word begins or ends."""
        cuts = np.append(np.arange(0, len(words), self._together), len(words)).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), words), " " if self._folds else "").to_pylist()
        found = []
        for text, first, stop in zip(joined, cuts[:-1].tolist(), cuts[1:].tolist()):
            ids = np.frombuffer(self._of_library([text])[0], "<u4")
            marks = np.flatnonzero(self._marks[ids])
            bounds = np.append(0, marks + 1) if self._marks_ends else np.append(marks, len(ids))
            if len(bounds) == stop - first + 1 and bounds[0] == 0 and bounds[-1] == len(ids):
                found.append((ids, np.diff(bounds)))
            else:
                found.append(self._flat(self._of_library(words.slice(first, stop - first).to_pylist())))
        return np.concatenate([ids for ids, _ in found]), np.concatenate([counts for _, counts in found])

    def _encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of new pieces and their counts, -1 for a piece that can't stand alone."""
        plain = pc.match_substring_regex(pieces, _PLAIN).to_numpy(zero_copy_only=False)
        counts = np.zeros(len(pieces), np.int64)
        chosen = pieces.filter(pa.array(plain))
        words = pc.ascii_rtrim(chosen, _PUNCTUATION)
        if self._folds:
            words = pc.utf8_lower(pc.ascii_ltrim(words, "\n"))
        else:
            words = pc.if_else(pc.starts_with(words, "\n"), words, pc.binary_join_element_wise(" ", words, ""))
        after = pc.replace_substring_regex(chosen, _BEFORE_PUNCTUATION, "")
        word, mark = self._words.numbers(words), self._marks_after.numbers(after)
        both = np.stack([self._words.counts[word], self._marks_after.counts[mark]], axis=1)
        starts = np.stack([self._words.starts[word], len(self._words.flat) + self._marks_after.starts[mark]], axis=1)
        plain_ids = gather(np.append(self._words.flat, self._marks_after.flat), starts.ravel(), both.ravel())
        counts[plain] = both.sum(axis=1)
        others = np.flatnonzero(~plain)
        rest = pieces.take(pa.array(others)).to_pylist()
        forms = [piece[1:] if piece[:1] == PieceTable.FIRST else spaced(piece, False) for piece in rest]
        alone = np.array([form is not None for form in forms], bool)
        other_ids, other_counts = self._flat(self._of_library([form for form in forms if form is not None]))
        counts[others[alone]] = other_counts
        # Both kinds go back to the order of the pieces.
        starts = np.zeros(len(pieces), np.int64)
        starts[plain] = np.cumsum(counts[plain]) - counts[plain]
        starts[others] = len(plain_ids) + np.cumsum(counts[others]) - counts[others]
        flat = gather(np.append(plain_ids, other_ids), starts, counts)
        counts[others[~alone]] = -1
        return flat, counts

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        return self._pieces.encode(texts)


@cache
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)
