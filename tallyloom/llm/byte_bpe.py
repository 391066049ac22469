"""Byte-level byte-pair encoding and decoding as recursive queries of an in-process DuckDB in every Spark task."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyloom.llm.common import byte_blocks, tokenizer_path, whole_texts
from tallyloom.llm.pieces import PieceCache, spaced

#: A row is a token, its place in its word and the token after it. Each turn contracts the leftmost pair of lowest rank in every word
#: that still has a pair of the merge table; words without one have reached their fixpoint and leave the recursion.
_ENCODE = """
with recursive states(turn, word, place, token, following) as (
    select 0, word, place, token, following from symbols
    union all
    (
        with best as (
            select s.word, min(m.merged::bigint * 65536 + s.place) as least
            from states s join merges m on m.lefthand = s.token and m.righthand = s.following
            group by s.word
        ),
        chosen as (
            select b.word, (b.least % 65536)::integer as place, (b.least // 65536)::integer as merged, s.following
            from best b join states s on s.word = b.word and s.place = b.least % 65536 + 1
        )
        select s.turn + 1, s.word,
            s.place - (s.place > c.place)::integer,
            case when s.place = c.place then c.merged else s.token end::integer,
            case when s.place = c.place then c.following when s.place = c.place - 1 then c.merged else s.following end::integer
        from states s join chosen c on s.word = c.word
        where s.place <> c.place + 1
    )
)
select word, place, token from states semi join (select word, max(turn) as turn from states group by word) using (word, turn)
"""
#: For long words: all occurrences of the lowest-ranked pair in one turn, taken from the left without overlap. Pairs made by a contraction
#: rank higher than it, so this equals contracting the leftmost again and again, in as many turns as there are different pairs. The
#: recursion keeps one row for each place, whatever the turns; rows of a place that is gone are those of an earlier turn than its word's last.
_ENCODE_LONG = """
with recursive states(turn, word, pos, token) using key (word, pos) as (
    select 0, word, pos, token from symbols
    union
    (
        with pairs as (
            select s.turn, s.word, s.pos, s.token, m.merged, m.merged as rank, s.place
            from (
                select *, lead(token) over in_word as following, row_number() over in_word as place
                from states window in_word as (partition by word order by pos)
            ) s
            left join merges m on m.lefthand = s.token and m.righthand = s.following
        ),
        lowest as (select word, min(rank) as rank from pairs group by word having min(rank) is not null),
        chosen as (
            select p.*, l.rank as least, p.rank is not distinct from l.rank as hit
            from pairs p join lowest l using (word)
        ),
        runs as (
            select *, place - row_number() over (partition by word, hit order by pos) as run from chosen
        ),
        taken as (
            select *, hit and (row_number() over (partition by word, hit, run order by pos)) % 2 = 1 as take from runs
        ),
        dropped as (
            select *, coalesce(lag(take) over (partition by word order by pos), false) as gone from taken
        )
        select turn + 1, word, pos, case when take then merged else token end from dropped where not gone
    )
)
select word, pos as place, token from states semi join (select word, max(turn) as turn from states group by word) using (word, turn)
"""
#: Identifiers of all words in order, and the bytes that they decode to, in order again. One sort serves the block; a sort for
#: every word would take several times as long.
_DECODE = """
select list(token order by word, place) as tokens, string_agg(hexed, '' order by word, place) as decoded
from encoded join vocabulary using (token)
"""
_SIZES = """
select count(*)::bigint as tokens, sum(octet_length(bytes))::bigint as bytes
from encoded join vocabulary using (token) group by word order by word
"""


class RankEncoder:
    """Encoder of one file of ranks; words are the matches of ``pattern``.

    A pair may be merged if its bytes have a rank; the merge table lists, for every pair of tokens whose joined bytes
    have a rank, that rank, which is also the identifier of the merged token.
    """

    def __init__(self, path: str, pattern: str, memory: str = "300MB", block: int = 160_000, long: int = 128, limit: int = 600_000):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        merges = [
            (left, right, rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None
        ]
        self._pattern = regex.compile(pattern)
        self._block, self._long, self._limit = block, long, limit
        self._known: dict[str, tuple[bytes, bytes]] = {}
        self._bytes = np.array([ranks[bytes([value])] for value in range(256)], np.int32)
        self._db = duckdb.connect(config={"threads": 1, "memory_limit": memory})
        lefts, rights, merged = map(pa.array, zip(*merges))
        table = pa.table({"lefthand": lefts.cast("int32"), "righthand": rights.cast("int32"), "merged": merged.cast("int32")})
        self._create("merges", table)
        hexed, raw = pa.array([token.hex() for token in ranks]), pa.array(ranks.keys(), "binary")
        self._create("vocabulary", pa.table({"token": pa.array(ranks.values(), "int32"), "bytes": raw, "hexed": hexed}))
        self._joined = np.zeros((256, 256), bool)  # neighbouring bytes of any token
        for token in ranks:
            codes = np.frombuffer(token, np.uint8)
            self._joined[codes[:-1], codes[1:]] = True
        self._pieces = PieceCache(self._encode, spaced, lambda text: self._encode([text]), limit=limit)

    def _create(self, name: str, table: pa.Table) -> None:
        self._db.register("incoming", table)
        self._db.execute(f"create or replace table {name} as select * from incoming")
        self._db.unregister("incoming")

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """The identifiers of every text as little-endian unsigned 32-bit integers, and the bytes that they decode to."""
        for parts in self._pieces.values(texts):
            yield b"".join([ids for ids, _ in parts]), b"".join([decoded for _, decoded in parts])

    def _encode(self, forms: list[str]) -> list[tuple[bytes, bytes]]:
        split = [self._pattern.findall(form) for form in forms]
        distinct = {word for words in split for word in words}
        known = {word: self._known[word] for word in distinct if word in self._known}
        unknown = {word: word.encode() for word in distinct - known.keys()}
        split_up = {word: self._cut(raw) for word, raw in unknown.items() if len(raw) > self._long}
        parts = {part for cut in split_up.values() for part in cut} | {raw for word, raw in unknown.items() if word not in split_up}
        merged = self._merged(parts)
        fresh = {word: merged[raw] for word, raw in unknown.items() if word not in split_up}
        for word, cut in split_up.items():
            fresh[word] = tuple(b"".join(values) for values in zip(*[merged[part] for part in cut]))
        if len(self._known) + len(fresh) > self._limit:
            self._known.clear()
        self._known.update((word, value) for word, value in fresh.items() if len(word) <= 48)
        known |= fresh
        return [
            known[words[0]] if len(words) == 1 else (b"".join([known[w][0] for w in words]), b"".join([known[w][1] for w in words]))
            for words in split
        ]

    def _cut(self, raw: bytes) -> list[bytes]:
        """The word in parts that no merge can join, since the bytes on both sides of a cut are neighbours in no token."""
        codes = np.frombuffer(raw, np.uint8)
        cuts = [0, *(np.flatnonzero(~self._joined[codes[:-1], codes[1:]]) + 1).tolist(), len(raw)]
        return [raw[start:stop] for start, stop in zip(cuts, cuts[1:])]

    def _merged(self, parts: set[bytes]) -> dict[bytes, tuple[bytes, bytes]]:
        """Words or parts of words, about ``block`` bytes in one recursion, each long one in its own."""
        found: dict[bytes, tuple[bytes, bytes]] = {}
        group, size = [], 0
        for part in parts:
            if len(part) > self._long:
                found |= self._merge([part], _ENCODE_LONG)
                continue
            group.append(part)
            size += len(part)
            if size >= self._block:
                found |= self._merge(group, _ENCODE)
                group, size = [], 0
        return found | self._merge(group, _ENCODE) if group else found

    def _merge(self, raw: list[bytes], query: str) -> dict[bytes, tuple[bytes, bytes]]:
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        owner = np.repeat(np.arange(len(raw), dtype=np.int32), sizes)
        place = (np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
        token = self._bytes[np.frombuffer(b"".join(raw), np.uint8)]
        following = np.append(token[1:], -1).astype(np.int32)
        following[np.cumsum(sizes) - 1] = -1
        self._create("symbols", pa.table({"word": owner, "place": place, "pos": place, "token": token, "following": following}))
        self._db.execute(f"create or replace table encoded as {query}")
        block = self._db.sql(_DECODE).to_arrow_table()
        ids = memoryview(block.column("tokens").combine_chunks().values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
        decoded = bytes.fromhex(block.column("decoded")[0].as_py())
        sizes = self._db.sql(_SIZES).to_arrow_table()
        tokens, ends = ([0, *np.cumsum(column.to_numpy() * width).tolist()] for column, width in zip(sizes.columns, (4, 1)))
        return {
            word: (bytes(ids[t0:t1]), decoded[b0:b1])
            for word, t0, t1, b0, b1 in zip(raw, tokens, tokens[1:], ends, ends[1:])
        }


@cache
def _encoder(path: str, pattern: str) -> RankEncoder:
    return RankEncoder(path, pattern)


def encode_bytes(docs: DataFrame, ranks: str | None = None, pattern: str = public_tokenizers.PATTERN, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``key, n_tokens, ids, decoded`` of every text: identifiers as little-endian 32-bit integers, and the bytes decoded from them.

    Words are the matches of ``pattern``, merged apart; no special tokens. Null and empty texts give empty
    binaries; repeated rows are encoded each; an empty table gives no rows; other columns are not read. Very long words are cut where
    no token of the vocabulary could span the cut; what can't be cut takes as many turns as it has different pairs to contract, in memory
    that follows its length.
    """
    return _mapped(docs, ranks, pattern, key, text, lambda ids, decoded: (pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())), "ids binary, decoded binary")


def encode_digests(docs: DataFrame, ranks: str | None = None, pattern: str = public_tokenizers.PATTERN, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``encode_bytes``, with SHA-256 digests in place of the binaries, so that the bytes don't leave the task."""

    def digests(ids: list[bytes], decoded: list[bytes]):
        return tuple(pa.array([hashlib.sha256(value).hexdigest() for value in column]) for column in (ids, decoded))

    return _mapped(docs, ranks, pattern, key, text, digests, "ids_sha256 string, decoded_sha256 string")


def _mapped(docs, ranks, pattern, key, text, columns, schema) -> DataFrame:
    path = ranks or tokenizer_path("byte_bpe_50k.tiktoken")
    slim = whole_texts(docs, key, text)
    names = [key, "n_tokens", *(part.split()[0] for part in schema.split(", "))]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for whole in batches:
            for start, stop in byte_blocks(whole.column(1), 4_000_000):
                batch = whole.slice(start, stop - start)
                ids, decoded = zip(*encoder.encode(batch.column(1).to_pylist()))
                counts = pa.array([len(value) // 4 for value in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), counts, *columns(list(ids), list(decoded))], names=names)

    return slim.mapInArrow(encode, f"`{key}` {slim.schema[key].dataType.simpleString()}, n_tokens long, {schema}")
