"""Token counts by byte-pair merging with a heap and a linked list: no identifiers are made, a count is initial symbols minus merges."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import tokenizer_path, whole_texts
from tallyloom.llm.pieces import PieceCache

MARK = "▁"
_CHUNKS = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")


class MergeCounter:
    """Counts of one sentencepiece model of byte-pair merges with byte fallback, spaces kept and a space before the text.

    A merge is allowed if its piece is in the vocabulary; the piece with the highest score (the lowest rank) goes
    first, the leftmost of equals. A symbol without a piece costs its UTF-8 bytes.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = range(model.get_piece_size())
        if not any(map(model.is_byte, pieces)):
            raise ValueError("the model has no byte fallback")
        special = [i for i in pieces if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)]
        ranks = {model.id_to_piece(i): -model.get_score(i) for i in set(pieces) - set(special)}
        if any(MARK in piece.lstrip(MARK) or "\n" in piece for piece in ranks):
            raise ValueError("pieces of this model run over spaces or line ends")
        if (model.normalize("ＡＢ  á "), model.normalize("a")) != ("▁ＡＢ▁▁á▁", "▁a"):
            raise ValueError("the model changes texts")
        self._ranks = ranks
        self._pieces = PieceCache(self._encode, self._lead, self._whole, limit=800_000)

    def counts(self, texts: list[str]) -> Iterator[int]:
        return map(sum, self._pieces.values(texts))

    @staticmethod
    def _lead(piece: str, first: bool) -> str | None:
        if not piece or MARK in piece:
            return None
        return piece if piece[0] == "\n" else MARK + piece

    def _encode(self, forms: list[str]) -> list[int]:
        return [1 + self.count(form[1:]) if form[0] == "\n" else self.count(form) for form in forms]

    def _whole(self, text: str) -> list[int]:
        """No merge crosses a line end or ends in front of a space, so the chunks between them are counted apart."""
        return [1 if chunk == "\n" else self.count(chunk) for chunk in _CHUNKS.findall(MARK + text.replace(" ", MARK))]

    def count(self, chunk: str) -> int:
        """Tokens of a chunk in which spaces are already marks."""
        ranks = self._ranks
        n = len(chunk)
        if n < 2 or chunk in ranks and n == 2:
            return sum(1 if symbol in ranks else len(symbol.encode()) for symbol in chunk) - (n == 2)
        total = sum(1 if symbol in ranks else len(symbol.encode()) for symbol in chunk)
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(chunk[i : i + 2])) is not None]
        heapq.heapify(heap)
        end = list(range(1, n + 1))  # where the symbol that begins at i ends; 0: it has been merged into another
        before = list(range(-1, n))  # where the symbol before the one at i begins
        while heap:
            _, left, stop = heapq.heappop(heap)
            middle = end[left]
            if not middle or middle >= n or end[middle] != stop or not stop:
                continue  # one of the two has been merged meanwhile
            total -= self._cost(chunk, left, middle) + self._cost(chunk, middle, stop) - 1
            end[left], end[middle] = stop, 0
            if stop < n:
                before[stop] = left
                if (rank := ranks.get(chunk[left : end[stop]])) is not None:
                    heapq.heappush(heap, (rank, left, end[stop]))
            if left and (rank := ranks.get(chunk[before[left] : stop])) is not None:
                heapq.heappush(heap, (rank, before[left], stop))
        return total

    def _cost(self, chunk: str, start: int, stop: int) -> int:
        if stop - start > 1 or (symbol := chunk[start:stop]) in self._ranks:
            return 1
        return len(symbol.encode())


@cache
def _counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def token_counts(docs: DataFrame, model: str | None = None, limit: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``key, n_bytes, n_tokens, over_limit`` of every text.

    ``model`` is the path of a sentencepiece model that every executor can read. Null and empty texts have no
    tokens; repeated rows are counted each; an empty table gives no rows; other columns are not read.
    """
    path = model or tokenizer_path("piece_bpe_32k.model")
    slim = whole_texts(docs, key, text).select(F.col(key), F.col(text), F.octet_length(text).cast("long").alias("n_bytes"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            tokens = pa.array(counter.counts(batch.column(1).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), tokens], names=[key, "n_bytes", "n_tokens"])

    kind = slim.schema[key].dataType.simpleString()
    return slim.mapInArrow(count, f"`{key}` {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
