"""Personal data and secrets against plain patterns."""

import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import pii
from tallyloom.llm.secret_scan import BASE62, Scanner, find_secrets, redact_secrets
from tallyloom.llm.spans import without
from tests.llm.fixtures_of_texts import ODD_TEXTS, documents

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)


def plain_personal(text):
    spans = [("email", *m.span()) for m in EMAIL.finditer(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            spans.append(("card", *m.span()))
    return spans + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def plain_secrets(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(found)]


PARTS = st.lists(
    st.sampled_from(
        ["a@b.c", "@", ".", "+1 ", "(743)", " 555-3824", "1.2.3.4", "256", "4785380592391139", " ", "-", "token", "='", "password: ", "AKIA", "ABCDEFGHIJKLMNOPQRST", "deadbeef", "0a1b2c", "é", "x_y", "\n"]
    ),
    max_size=14,
).map("".join)


@settings(max_examples=300, deadline=None)
@given(PARTS)
def test_base_spans_are_those_of_the_patterns(text):
    assert [c[:3] for c in pii.candidates(text) if c[3]] == plain_personal(text)
    assert [s for s in Scanner_of_tests().scan(text) if s[0] in ("assign", "access", "hex")] == plain_secrets(text)


_SCANNER = []


def Scanner_of_tests():
    if not _SCANNER:
        _SCANNER.append(Scanner())
    return _SCANNER[0]


def test_long_texts_take_linear_time():
    for text in ("x" * 300_000 + "@", "1" * 300_000, "a@" * 50_000, "+1" * 50_000, "1." * 100_000, "0" * 5_000 + "1.2.3.4"):
        pii.candidates(text)
    for text in ("token" * 50_000, "0" * 300_000, "AKIA" * 50_000, "token " + " " * 300_000):
        Scanner_of_tests().scan(text)


def test_candidates_that_labelers_agree_on_are_added(spark):
    texts = ["call +1 (269) 555-3296 4524132264652876 now", "write to ann (at) example (dot) com", "host x@y", "v 1.2.3.4", "phone (743) 555-3824"] * 5 + ["+1 (743) 555-3824 mail 19@mail5.example.com"] * 20
    rows = pii.find_personal_data(documents(spark, texts), base_flag=True).orderBy("doc_id").collect()
    assert [tuple(s)[:3] for s in rows[0]["spans"] if not s["base"]] == [("phone", 5, 22)]
    assert not rows[2]["spans"]
    assert all([tuple(s)[:3] for s in row["spans"] if s["base"]] == plain_personal(texts[row["doc_id"]]) for row in rows)
    assert pii.find_personal_data(documents(spark, [])).count() == 0
    odd = pii.find_personal_data(documents(spark, repeat=2)).collect()
    assert len(odd) == 2 * len(ODD_TEXTS)


def test_reliable_labelers_outvote_the_others():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.3
    votes = np.array([np.where(rng.random(4000) < right, truth, ~truth) * 2 - 1 for right in (0.95, 0.9, 0.6)]).T
    table, counts = np.unique(np.column_stack([np.zeros(4000, int), votes]), axis=0, return_counts=True)
    chance = pii.estimate_reliabilities(table, counts.astype(float))
    of = {tuple(row): p for row, p in zip(table.tolist(), chance)}
    assert of[(0, 1, 1, -1)] > 0.9 and of[(0, -1, -1, 1)] < 0.1
    fitted = pii.fit_classifier(np.column_stack([table, np.zeros(len(table), int)]), counts.astype(float), chance)
    assert ((fitted > 0.5) == (chance > 0.5)).all()


def test_embedded_checksums_decide():
    body = "abcdefghijklmnopqrstuvwxyz0123"
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    scan = Scanner_of_tests().scan
    assert scan(f"x ghp_{body}{digits} y") == [("github", 2, 42)]
    assert scan(f"x ghp_{body}000000 y") == []
    key = "xprv9s21ZrQH143K3QTDL4LXw2F7HEK3wJUD2nW2nRk4stbPy6cq3jPPqjiChkVvvNKmPGJxWUtg6LnF5kejMRNNU3TGtRBeJgk33yuGBxrMPHi"  # of a published test vector
    assert scan(key) == [("xprv", 0, 111)] and scan(key[:-1] + "j") == []


def test_secrets_of_odd_rows_and_their_removal(spark):
    rows = find_secrets(documents(spark, repeat=2)).collect()
    assert len(rows) == 2 * len(ODD_TEXTS) and not any(row["spans"] for row in rows)
    masked = redact_secrets(documents(spark, [None, "", "a token = abcdefgh b deadbeefdeadbeefdeadbeef"])).orderBy("doc_id")
    assert [row["text"] for row in masked.collect()] == [None, "", "a [SECRET] b [SECRET]"]
    assert find_secrets(documents(spark, [])).count() == 0
    assert without("abcdef", [(1, 3), (2, 4)], "-") == "a-ef"
