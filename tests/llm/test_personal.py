"""Base spans against the plain patterns, and what cues add."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from millrace.llm import personal
from millrace.llm.queries import QUERIES


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits(text):
    return re.sub("[^0-9]", "", text)


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
}


def slow(text):
    return [
        (kind, m.start(), m.end()) for kind, (form, valid) in BASE.items() for m in re.finditer(form, text or "") if valid(m[0])
    ]


def base(text):
    return [span for span in personal.spans_of(text) if span[0] in BASE]


def test_base_kinds_on_random_texts():
    rng = random.Random(4)
    alphabets = ["0123456789. ", "ab@.-1_", "+1 2(3).-4", "0 4-1.2+@a::b\n"]
    for _ in range(6_000):
        letters = rng.choice(alphabets)
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(60)))
        assert base(text) == slow(text), text
    for _ in range(300):  # right check digits
        number = "".join(rng.choice("0123456789") for _ in range(rng.randrange(11, 21)))
        number = next(number + d for d in "0123456789" if luhn(number + d))
        text = "x" + re.sub("(.{4})", rng.choice([r"\1", r"\1 ", r"\1-", r"\1  "]), number) + "y"
        assert base(text) == slow(text)


@pytest.mark.parametrize("text", [
    "a@b.c@d.e", "a@b.c_x@d.e", "@b.c", "a@b", "a@b..c", "a@b.c.", "é.a@b.cé", "1.2.3.4.5.6.7.8.9", "256.1.1.1.1.1.1.1.1",
    "1.2.3.0000000255", "9" * 6_000 + ".1.1.1", "+1", "+12", "+123", "+1 (743) 555-3824-", "++49 30 1234567", "4111 1111 1111 1111",
    "4111-1111-1111-1112", "\U0001f600 4111111111111111", "12345678901234567890", "K@mail.example.comİx@y.zz",
])
def test_base_kinds_on_chosen_texts(text):
    if "9" * 5_000 in text:
        assert base(text) == []
    else:
        assert base(text) == slow(text)


@pytest.mark.parametrize("text,kind,found", [
    ("write to jane.doe (at) mail (dot) example [dot] org now", "spelled", ["jane.doe (at) mail (dot) example [dot] org"]),
    ("meet (at) noon", "spelled", []),
    ("see https://joe:pass@db.example.com:5432/x", "login", ["https://joe:pass@db.example.com:5432"]),
    ("see https://db.example.com/a@b", "login", []),
    ("at 2001:db8::ff00:42:8329, or fe80::1.", "ip6", ["2001:db8::ff00:42:8329", "fe80::1"]),
    ("at 12:30:45 and a::b::c and std::cout", "ip6", []),
    ("Phone: (030) 123-4567 x", "tel", ["(030) 123-4567"]),
    ("tel:5551234567", "tel", ["5551234567"]),
    ("microphone 1234567", "tel", []),
    ("IBAN: DE89 3704 0044 0532 0130 00 paid", "iban", ["DE89 3704 0044 0532 0130 00"]),
    ("iban GB82WEST12345698765432", "iban", ["GB82WEST12345698765432"]),
    ("IBAN: DE88 3704 0044 0532 0130 00", "iban", []),
    ("SSN 536-22-1234.", "ssn", ["536-22-1234"]),
    ("ssn: 666-22-1234, ssn: 536-00-1234", "ssn", []),
    ("Account number: AB-123456 and passport no. X1234567", "account", ["AB-123456", "X1234567"]),
    ("on account of weather, accounting 123456", "account", []),
])
def test_added_kinds(text, kind, found):
    assert [text[s:e] for k, s, e in personal.spans_of(text) if k == kind] == found


def test_long_texts_end():
    for piece in ("1 ", "a@", "1.", "+1", "::", "a.", "iban ", "http://a", "[at]", "1-", "account "):
        personal.spans_of(piece * 50_000)


def want(key, text):
    spans = slow(text)
    joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
    counts = [sum(k == kind for k, _, _ in spans) for kind in BASE]
    return (key, *counts, hashlib.sha256(joined.encode()).hexdigest()), set(spans)


def check(rows, docs):
    texts = {}
    for key, text in docs:
        texts.setdefault(key, []).append(want(key, text))
    for row in rows:
        spans = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in row["spans"].split(",") if x)]
        assert any(tuple(row)[:6] == facts and found <= set(spans) for facts, found in texts[row["doc_id"]])
        order = [(personal.KINDS.index(k), s) for k, s, _ in spans]
        assert order == sorted(order)


def test_query_on_whole_table(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op13_personal"](spark, small).collect()
    assert len(rows) == len(docs)
    check(rows, docs)
    assert all(sum(row[f"n_{kind}"] for row in rows) for kind in BASE)


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "a@b.co a@b.co"), (3, "a@b.co a@b.co"), (None, "1.2.3.4"), (4, "\U0001f600é a@b.co")]
    rows += [(5, "word " * 50_000 + "+1 (743) 555-3824")] + [(i, "see 1.2.3.4") for i in range(50, 90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as spans", "2 as n_email")
    found = personal.report(docs).collect()
    assert len(found) == len(rows)
    check(found, rows)
    assert personal.report(docs.limit(0)).count() == 0
    masked = {r["doc_id"]: r["masked"] for r in personal.mask(docs).collect()}
    assert masked[1] == "" and masked[3] == "[EMAIL] [EMAIL]" and masked[4] == "\U0001f600é [EMAIL]"
    assert masked[5].endswith("word [PHONE]") and masked[None] == "[IP]"
