"""Secrets in texts: a keyword automaton finds the places, anchored patterns match there, embedded checksums decide."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import product

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import whole_texts
from tallyloom.llm.spans import SPANS, without

BASE_KINDS = ("assign", "access", "hex")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


def in_any_case(word: str) -> list[str]:
    """All spellings of a word in lower-case and upper-case letters."""
    return ["".join(letters) for letters in product(*({c.lower(), c.upper()} for c in word))]


def ends_with_crc32(match: re.Match) -> bool:
    """The last six characters of a token are the CRC-32 of the thirty before, in base 62."""
    body = match[0].rpartition("_")[2]
    value, digits = zlib.crc32(body[:30].encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return body[30:] == digits


def is_base58_checked(match: re.Match) -> bool:
    """The last four of the decoded bytes begin the double SHA-256 of the others."""
    value = 0
    for letter in match[0]:
        value = value * 58 + BASE58.index(letter)
    data = value.to_bytes((value.bit_length() + 7) // 8, "big")
    return hashlib.sha256(hashlib.sha256(data[:-4]).digest()).digest()[:4] == data[-4:]


@dataclass(frozen=True)
class Rule:
    """A match begins with one of ``keywords``; ``valid`` keeps it. A match that fails is passed over, without another try inside it."""

    kind: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    valid: Callable[[re.Match], bool]


RULES = (
    Rule(
        "assign",
        tuple(form for word in ("password", "passwd", "secret", "token", "apikey", "api_key") for form in in_any_case(word)),
        re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE),
        lambda match: len(match[2]) >= 6,
    ),
    Rule("access", ("AKIA",), re.compile(r"AKIA[A-Z0-9]+"), lambda match: len(match[0]) >= 20),
    # A run of hexadecimal digits has no word of its own: its keywords are all its possible first four digits.
    Rule("hex", tuple(map("".join, product("0123456789abcdef", repeat=4))), re.compile(r"[0-9a-f]+"), lambda match: len(match[0]) >= 24),
    Rule("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), ends_with_crc32),
    Rule("npm", ("npm_",), re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), ends_with_crc32),
    Rule("xprv", ("xprv",), re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])"), is_base58_checked),
)


class Scanner:
    """Scans texts by ``rules``. Every text is passed once by the automaton; patterns run only where a keyword begins."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self._rules = rules
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, rule in enumerate(rules):
            for keyword in rule.keywords:
                self._automaton.add_word(keyword, i + len(rules) * len(keyword))
        self._automaton.make_automaton()

    def scan(self, text: str) -> list[tuple[str, int, int]]:
        """Kind, start and end (exclusive) of all secrets by start, then in the order of the rules."""
        rules, n = self._rules, len(self._rules)
        until = [0] * n
        found = []
        for end, code in self._automaton.iter(text):
            i = code % n
            start = end + 1 - code // n
            if start >= until[i] and (match := rules[i].pattern.match(text, start)):
                until[i] = match.end()
                if rules[i].valid(match):
                    found.append((start, i, match.end()))
        return [(rules[i].kind, start, end) for start, i, end in sorted(found)]


@cache
def _scanner() -> Scanner:
    return Scanner()


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``key, spans``; spans count code points, ends exclusive, by start, then kind.

    Assignments, access keys and long hexadecimal runs need no more than their pattern; platform tokens and extended private
    keys need a right embedded checksum. Null and empty texts have no spans; repeated rows are scanned each; an empty table gives no
    rows; other columns are not read. The work is linear in a text's length.
    """
    slim = whole_texts(docs, key, text)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner()
        for batch in batches:
            spans = [[{"kind": k, "start": a, "stop": b} for k, a, b in scanner.scan(value.as_py())] for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=[key, "spans"])

    return slim.mapInArrow(scan, f"`{key}` {slim.schema[key].dataType.simpleString()}, spans {SPANS}")


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]", text: str = "text") -> DataFrame:
    """All rows and columns, with every secret in ``text`` replaced by ``mark``; null texts stay null."""

    @F.pandas_udf("string")
    def redact(values: pd.Series) -> pd.Series:
        scanner = _scanner()
        return values.map(lambda value: value and without(value, [(a, b) for _, a, b in scanner.scan(value)], mark))

    return docs.withColumn(text, redact(F.col(text)))
