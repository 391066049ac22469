"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs them, and a span classifier decides."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import whole_texts
from tallyloom.session import materialize

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban")
CANDIDATES = "array<struct<kind:string,start:int,stop:int,base:boolean,pattern:string>>"

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_HOST = re.compile(r"[A-Za-z0-9-]+")
#: A match can only begin where a run of digits does, which the look-behind states, so that long runs take linear time.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])")
_VEILED_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]{1,63})+")
_INTERNATIONAL_PHONE = re.compile(r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-][0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])")
_IPV6 = re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])")
_IBAN = re.compile(r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Z0-9])")

#: Gazetteers: short lists of public knowledge.
_TOP_DOMAINS = frozenset("com org net edu gov mil int info biz eu uk us ca de fr es it nl be ch at se no dk fi pl pt ie au nz jp cn in br mx ar ru io".split())
_COUNTRY_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 98".split())
_IBAN_LENGTHS = dict(AT=20, BE=16, CH=21, DE=22, DK=18, ES=24, FI=18, FR=27, GB=22, IE=22, IT=27, LU=20, NL=18, NO=15, PL=28, PT=25, SE=24)
_CONTEXT = {
    "email": re.compile(r"mail|contact|write|courriel|correo|schreib|kontakt", re.IGNORECASE),
    "ip": re.compile(r"\bip\b|server|host|address|adresse|login", re.IGNORECASE),
    "card": re.compile(r"card|visa|carte|karte|tarjeta|credit|kredit|pay", re.IGNORECASE),
    "phone": re.compile(r"phone|\btel|call|fax|mobil|t[ée]l[ée]|anruf|llam", re.IGNORECASE),
    "iban": re.compile(r"iban|account|bank|konto|compte|cuenta", re.IGNORECASE),
}
_AGAINST = {
    "email": re.compile(r"[/@]$"),
    "ip": re.compile(r"(?:version|release|section|\bv)[\x20.]?$", re.IGNORECASE),
    "card": re.compile(r"(?:(?:isbn|number|order|nr\.?|\bid)[\x20:#]*|[A-Za-z0-9._-])$", re.IGNORECASE),
    "phone": re.compile(r"(?:[A-Za-z0-9]|[-+*/=]\x20?)$"),
    "iban": re.compile(r"[A-Za-z0-9]$"),
}


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def emails(text: str) -> Iterator[tuple[int, int, bool]]:
    """Leftmost addresses, and names at a host without a dot as failed ones; a text is passed once, sign by sign."""
    at, begin = text.find("@"), 0
    while at >= 0:
        size = _LOCAL.match(text[begin:at][::-1]).end()
        stop = at + 1
        if size and (match := _DOMAIN.match(text, at + 1)):
            yield at - size, match.end(), True
            stop = match.end()
        elif size and (match := _HOST.match(text, at + 1)):
            yield at - size, match.end(), False
        begin, at = stop, text.find("@", stop)


def base_candidates(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """Matches of the base patterns, and whether they pass."""
    if "@" in text:
        for start, stop, passes in emails(text):
            yield "email", start, stop, passes
    for match in _IP.finditer(text):
        yield "ip", *match.span(), all(len(part.lstrip("0")) < 4 and int(part.lstrip("0") or "0") <= 255 for part in match[0].split("."))
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 13:
            digits = _digits(match[0])
            yield "card", *match.span(), 16 <= len(digits) <= 19 and luhn(digits)
    if "+" in text:
        for match in _PHONE.finditer(text):
            yield "phone", *match.span(), 8 <= len(_digits(match[0])) <= 15


def further_candidates(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans that the base patterns don't look for."""
    for pattern in (_LOCAL_PHONE, _INTERNATIONAL_PHONE) if "+" in text else (_LOCAL_PHONE,):
        for match in pattern.finditer(text):
            yield "phone", *match.span()
    if "at)" in text or "at]" in text:
        for match in _VEILED_EMAIL.finditer(text):
            yield "email", *match.span()
    if ":" in text:
        for match in _IPV6.finditer(text):
            yield "ip", *match.span()
    for match in _IBAN.finditer(text):
        yield "iban", *match.span()


def _checks(kind: str, span: str) -> int:
    """The vote of the regex and checksum labeler."""
    if kind == "email":
        return 1 if _DOMAIN.search(span.partition("@")[2]) or "at" in span and "@" not in span else -1
    if kind == "ip":
        return 1 if ":" in span or all(len(part) <= 3 and int(part) <= 255 for part in span.split(".")) else -1
    if kind == "card":
        return 1 if 13 <= len(_digits(span)) <= 19 and luhn(_digits(span)) else -1
    if kind == "phone":
        return 1 if 8 <= len(_digits(span)) <= 15 else -1
    plain = span.replace(" ", "")
    return 1 if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1 else -1


def _listed(kind: str, span: str) -> int:
    """The vote of the gazetteer labeler."""
    digits = _digits(span)
    if kind == "email":
        return 1 if re.split(r"[^A-Za-z0-9-]", span)[-1].lower() in _TOP_DOMAINS or span[-4:-1] in ("com", "org") else -1
    if kind == "ip":
        return -1 if span.split(".")[0] in ("0", "255") else 0
    if kind == "card":
        return 1 if digits[0] in "3456" else -1
    if kind == "phone":
        return 1 if span[0] == "+" and any(digits[:n] in _COUNTRY_CODES for n in (1, 2)) else 0 if span[0] != "+" and digits[0] not in "01" else -1
    return 1 if _IBAN_LENGTHS.get(span[:2]) == len(span.replace(" ", "")) else -1


def votes(text: str, kind: str, start: int, stop: int) -> tuple[int, ...]:
    """Votes for (1), against (-1) or neither (0): checks, gazetteer, words before, signs around."""
    span, before = text[start:stop], text[max(0, start - 40) : start]
    around = -1 if _AGAINST[kind].search(before) or text[stop : stop + 1].isalnum() else 1
    return _checks(kind, span), _listed(kind, span), 1 if _CONTEXT[kind].search(before) else 0, around


def apart(spans: list[tuple[str, int, int]], taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The spans from the left that overlap neither those taken nor each other, the longer of those that begin together."""
    marks = sorted((start, stop) for _, start, stop in taken)
    kept = []
    at = end = 0
    for kind, start, stop in sorted(set(spans), key=lambda c: (c[1], -c[2], c[0])):
        while at < len(marks) and marks[at][0] < stop:
            end = max(end, marks[at][1])
            at += 1
        if start >= end:
            kept.append((kind, start, stop))
            end = stop
    return kept


def candidates(text: str) -> list[tuple[str, int, int, bool, str]]:
    """All candidates: base spans that pass, then others apart from them, those first that pass their kind's check."""
    base, others = [], []
    for kind, start, stop, passes in base_candidates(text):
        (base if passes else others).append((kind, start, stop))
    others += further_candidates(text)
    sound = [c for c in others if _checks(c[0], text[c[1] : c[2]]) > 0]
    kept = apart(sound, base)
    kept += apart(others, base + kept)
    order = {kind: i for i, kind in enumerate(KINDS)}
    rows = [(*c, True) for c in base] + [(*c, False) for c in kept]
    found = []
    for kind, start, stop, is_base in sorted(rows, key=lambda c: (order[c[0]], c[1])):
        shape = min(3, (stop - start) // 8)
        found.append((kind, start, stop, is_base, ",".join(map(str, (order[kind], *votes(text, kind, start, stop), shape)))))
    return found


def estimate_reliabilities(table: np.ndarray, counts: np.ndarray, turns: int = 60) -> np.ndarray:
    """EM over vote patterns: the probability that candidates of each pattern are personal data.

    ``table`` has a row per pattern: kind, then the votes. Each labeler has, for every kind, a distribution of its
    votes given either truth, smoothed by one observation; the start is a soft majority.
    """
    kinds, ballots = table[:, 0], table[:, 1:] + 1
    truth = 1 / (1 + np.exp(-(ballots - 1).sum(axis=1)))
    for _ in range(turns):
        odds = np.zeros(len(table))
        for kind in np.unique(kinds):
            of = kinds == kind
            for value, sign in ((truth, 1), (1 - truth, -1)):
                weight = counts[of] * value[of]
                odds[of] += sign * np.log(weight.sum() + 1)
                for labeler in range(ballots.shape[1]):
                    seen = np.bincount(ballots[of, labeler], weight, 3) + 1 / 3
                    odds[of] += sign * np.log(seen / seen.sum())[ballots[of, labeler]]
        truth = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return truth


def fit_classifier(table: np.ndarray, counts: np.ndarray, truth: np.ndarray, turns: int = 400, decay: float = 1e-3) -> np.ndarray:
    """Logistic regression of the EM labels on kind, votes and length; returns the probability of every pattern."""
    columns = [table[:, 0] == kind for kind in np.unique(table[:, 0])]
    columns += [table[:, j] == value for j in range(1, table.shape[1]) for value in np.unique(table[:, j])]
    x = np.array(columns, np.float64).T
    weight = np.sqrt(counts)
    weight = weight / weight.sum()
    w = np.zeros(x.shape[1])
    for _ in range(turns):
        p = 1 / (1 + np.exp(-x @ w))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + decay * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (weight * (p - truth)) + decay * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return 1 / (1 + np.exp(-x @ w))


def find_personal_data(docs: DataFrame, threshold: float = 0.5, key: str = "doc_id", text: str = "text", base_flag: bool = False) -> DataFrame:
    """Rows ``key, spans``: all base matches, and further candidates that the span classifier accepts; ``base_flag`` tells them apart.

    The texts are read once; the candidates are kept in a scratch table. Their patterns (kind, votes, length class; at most 5 * 3^4 * 4 of
    them) are counted over the whole corpus, and only these counts reach the driver. Spans count code points, ends exclusive, by kind, then start.
    Null and empty texts have no spans; repeated rows are searched each and count each; an empty table gives no rows; other columns
    are not read. The work is linear in a text's length.
    """
    slim = whole_texts(docs, key, text)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("base", pa.bool_()), ("pattern", pa.string())]))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[dict(zip(("kind", "start", "stop", "base", "pattern"), c)) for c in candidates(value.as_py())] for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=[key, "candidates"])

    found = materialize(slim.mapInArrow(label, f"`{key}` {slim.schema[key].dataType.simpleString()}, candidates {CANDIDATES}"), "pii-candidates")
    patterns = found.select(F.explode("candidates").alias("c")).groupBy("c.pattern").count().orderBy("pattern").collect()
    accepted = ["none"]
    if patterns:
        table = np.array([[int(value) for value in row["pattern"].split(",")] for row in patterns])
        counts = np.array([row["count"] for row in patterns], np.float64)
        truth = estimate_reliabilities(table[:, :-1], counts)
        chance = fit_classifier(table, counts, truth)
        accepted += [row["pattern"] for row, p in zip(patterns, chance) if p >= threshold]
    kept = F.filter("candidates", lambda c: c["base"] | c["pattern"].isin(*accepted))
    fields = ("kind", "start", "stop", "base") if base_flag else ("kind", "start", "stop")
    return found.select(key, F.transform(kept, lambda c: F.struct(*[c[field].alias(field) for field in fields])).alias("spans"))
