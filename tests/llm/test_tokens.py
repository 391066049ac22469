"""Token files, packing, counts and byte-level encoding against the libraries."""

import base64
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from tallyloom.llm.byte_bpe import RankEncoder, encode_bytes
from tallyloom.llm.packing import Limits, Packer, pack_documents, pack_examples
from tallyloom.llm.token_count import MergeCounter, token_counts
from tallyloom.llm.token_files import read_token_files, token_checksums, write_token_files
from tallyloom.session import scratch_path
from tests.llm.fixtures_of_texts import ODD_TEXTS, documents


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def library_ids(name, end):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return [[*tokenizer.encode(text or "", add_special_tokens=False).ids, end] for text in ODD_TEXTS]


@pytest.mark.parametrize("encoding", ["delta", "dictionary"])
def test_token_files_hold_what_the_library_gives(spark, encoding):
    path = scratch_path(spark, "t")
    write_token_files(documents(spark), path, encoding=encoding, page_rows=2)
    rows = token_checksums(read_token_files(spark, path)).orderBy("doc_id").collect()
    start = 0
    for row, ids in zip(rows, library_ids("word_bpe_49k.json", 2), strict=True):
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), zlib.crc32(packed(ids)))
        start += len(ids)
    files = read_token_files(spark, path)
    assert files.where("doc_id = 7").select("ids").first()[0] == library_ids("word_bpe_49k.json", 2)[7]
    plan = files.select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_token_files_of_repeated_rows_and_of_none(spark):
    path = scratch_path(spark, "t")
    write_token_files(documents(spark, repeat=2), path)
    rows = read_token_files(spark, path).select("doc_id", "start", "n_tokens").orderBy("start", "n_tokens").collect()
    assert [row["doc_id"] for row in rows] == sorted(list(range(len(ODD_TEXTS))) * 2)
    assert [row["start"] for row in rows] == [0, *np.cumsum([row["n_tokens"] for row in rows])[:-1]]
    path = scratch_path(spark, "t")
    write_token_files(documents(spark, []), path)
    assert token_checksums(read_token_files(spark, path)).count() == 0
    with pytest.raises(ValueError):
        write_token_files(documents(spark), path, encoding="none")


def gapless(ranges):
    at = 0
    for start, length in sorted(ranges):
        assert start == at
        at += length
    return at


def test_packing_holds_every_identifier_once(spark):
    rows = pack_documents(documents(spark, repeat=1)).collect()
    ids = library_ids("byte_bpe_50k.json", 0)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        doc = ids[row["doc_id"]]
        assert row["doc_tokens"] == len(doc)
        assert bytes(row["ids"]) == packed(doc[row["start"] : row["start"] + row["length"]])
        by_doc[row["doc_id"]].append((row["start"], row["length"]))
        by_sequence[row["sequence_id"]].append((row["offset"], row["length"]))
    assert {name: gapless(ranges) for name, ranges in by_doc.items()} == dict(enumerate(map(len, ids)))
    used = [gapless(ranges) for ranges in by_sequence.values()]
    assert all(n == 1024 or n & (n - 1) == 0 for n in used)
    assert pack_documents(documents(spark, [])).count() == 0


@pytest.mark.parametrize("limits", [Limits(64, 3, 40), Limits(64, 100, 10), Limits(16, 1, 16)])
def test_packing_keeps_all_limits(spark, limits):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(0, 99, n).tolist(), (rng.random(n) < 0.5).tolist() if i % 4 else None) for i, n in enumerate(rng.integers(0, 150, 60).tolist())]
    rows += [(90, None, None), (91, [], []), (92, [1, 2, 3], [True]), (93, [5] * 10, [None] * 10)]
    pieces = pack_examples(spark.createDataFrame(rows, "example_id int, ids array<int>, loss array<boolean>"), limits).collect()
    got, use = defaultdict(list), defaultdict(lambda: [0, 0, 0])
    for piece in pieces:
        got[piece["example_id"]].append((piece["start"], list(np.frombuffer(piece["ids"], "<u4"))))
        for j, n in enumerate((piece["length"], 1, piece["loss_tokens"])):
            use[piece["sequence_id"]][j] += n
    assert all(n <= cap for used in use.values() for n, cap in zip(used, (limits.tokens, limits.segments, limits.loss)))
    assert {name: [i for _, ids in sorted(parts) for i in ids] for name, parts in got.items()} == {name: ids for name, ids, _ in rows if ids}
    total = {name: sum([True] * len(ids) if loss is None else [bool(x) for x in loss]) for name, ids, loss in rows if ids}
    assert sum(used[2] for used in use.values()) == sum(total.values())


def test_packer_prefers_what_fills_the_scarce_side():
    def item(name, tokens, loss):
        mask = np.zeros(tokens, np.uint8)
        mask[:loss] = 1
        return name, bytes(4 * tokens), mask

    sequences = list(Packer(Limits(100, 10, 50)).pack([item("a", 60, 0), item("b", 40, 40), item("c", 60, 10), item("d", 40, 0)]))
    assert sorted(sorted({p.key for p in s}) for s in sequences)[0] == ["a", "b"] or len(sequences) == 2
    with pytest.raises(ValueError):
        Packer(Limits(0, 1, 1))


def test_counts_equal_those_of_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = [text or "" for text in ODD_TEXTS]
    rows = token_counts(documents(spark, repeat=2), limit=100).orderBy("doc_id").collect()
    assert [row["n_tokens"] for row in rows[::2]] == [len(ids) for ids in model.encode(texts)]
    assert rows[::2] == rows[1::2]
    assert all(row["n_bytes"] == len(texts[row["doc_id"]].encode()) and row["over_limit"] == (row["n_tokens"] > 100) for row in rows)
    assert token_counts(documents(spark, [])).count() == 0


def test_counting_forgets_pieces_without_changing_counts():
    counter = MergeCounter(public_tokenizers.path("piece_bpe_32k.model"))
    texts = [text or "" for text in ODD_TEXTS]
    want = list(counter.counts(texts))
    counter._pieces._limit = 3
    assert list(counter.counts(texts)) == want


def test_bytes_equal_those_of_the_library_and_decode_to_the_text(spark):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = encode_bytes(documents(spark)).orderBy("doc_id").collect()
    for row, text in zip(rows, ODD_TEXTS, strict=True):
        ids = library.encode_ordinary(text or "")
        assert bytes(row["ids"]) == packed(ids) and row["n_tokens"] == len(ids)
        assert bytes(row["decoded"]).decode() == (text or "")
    assert encode_bytes(documents(spark, [])).count() == 0
    encoder = RankEncoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, long=4)
    assert [ids for ids, _ in encoder.encode([text or "" for text in ODD_TEXTS])] == [bytes(row["ids"]) for row in rows]


def test_very_long_words_are_encoded_as_by_the_library():
    """Random letters are cut where no token could span; a period of few letters can't be cut and stays in one recursion."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    library = tiktoken.Encoding("library", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = RankEncoder(path, public_tokenizers.PATTERN)
    letters = random.Random(3)
    words = ["".join(letters.choices("abcdefghijklmnopqrstuvwxyz", k=20_000)), "".join(letters.choices("abAB+/09é", k=5_000))]
    words += ["a" * 20_001, "xyz" * 7_000, "qj" * 300 + "the" * 300]
    for word, (ids, decoded) in zip(words, encoder.encode(words)):
        assert decoded == word.encode()
        assert ids == np.array(library.encode(word, disallowed_special=()), "<u4").tobytes()
    million = "".join(letters.choices("abcdefghijklmnopqrstuvwxyzABCDEF", k=1_000_000))
    (ids, decoded), = encoder.encode([million])
    assert decoded == million.encode() and len(ids) < 4_000_000
