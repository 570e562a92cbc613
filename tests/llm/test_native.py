"""Line dedup and personal data: brute force on awkward tables, and no Python in the plans."""

from __future__ import annotations

import random
import re
import time
from collections import defaultdict

import pytest

from fixtures import messy, nothing, small  # noqa: F401
from helpers import pairs

from martwright.llm import line_dedup, pii

WS = " \t\n\x0b\x0c\r"
LOWER = {i: i + 32 for i in range(65, 91)}
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_lines(rows, least):
    docs_of = defaultdict(set)
    key = lambda line: line.strip(WS).translate(LOWER)
    for i, t in rows:
        for line in (t or "").split("\n"):
            docs_of[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or len(docs_of[key(x)]) < least]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("heavy", [1, 40, 65_536])  # no line heavy, some, all
def test_lines_against_brute_force(messy, monkeypatch, heavy):
    monkeypatch.setattr(line_dedup, "HEAVY", heavy)
    for least in (2, 3):
        got = line_dedup.drop_common_lines(messy, least)
        assert set(messy.columns) - {"N_Lines"} <= set(got.columns) | {"n_lines"}
        rows = sorted(((r.doc_id, r["n_lines"], r["n_dropped"], r.text) for r in got.select(
            "doc_id", "n_lines", "n_dropped", "text").collect()), key=repr)
        assert rows == brute_lines(pairs(messy), least)


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if k % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                  "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


CASES = ["a@b.c%x@d.e", "é a.b@c-d.e.f. 🤗 x@y", "1.2.3.4.5.6.7.8 300.1.1.1 1.1.1.0256 0001.2.3.4 00000255.1.1.1",
         "4111-1111 1111 1111 4111111111111112 4111  1111", "+4 (11).11-11 11111 x +1 +12345678 ++123456789",
         "+41111 1111 1111 1111", "a@@b.c a@b..c", "x@1.2.3.4", "12 34-56@x.com 4111 1111 1111 1111-a@b.com"]


def test_spans_against_brute_force(spark, messy):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "doc_id long, text string")
    for df in (messy.select("doc_id", "text"), rows):
        got = pii.find_pii(df).select("text", pii.span_list(pii.F.col("pii"), base_only=True).alias("s")).collect()
        assert len(got) == df.count()
        for r in got:
            assert r.s == brute_spans(r.text), r.text[:60]


def test_extra_kinds_need_checksum_or_context(spark):
    texts = ["pay to GB82 WEST 1234 5698 7654 32 now", "pay to GB83 WEST 1234 5698 7654 32 now",
             "my SSN is 219-09-9999.", "order 219-09-9999.", "call (784) 555-9263 today", "part (784) 555-9263",
             "call +1 (784) 555-9263 today"]
    got = pii.find_pii(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    kinds = {r.text: [s.kind for s in r.pii] for r in got}
    assert list(map(kinds.get, texts)) == [["iban"], [], ["national_id"], [], ["local_phone"], [], ["phone"]]


def near_word(kind, text, start, end):
    words = re.compile(rf"(?i)\b(?:{pii.CONTEXT_WORDS[kind]})")
    return bool(words.search(text[max(0, start - 40):start]) or words.search(text[end:end + 40]))


def test_context_reaches_past_other_matches(spark):
    rng = random.Random(3)
    parts = ["(784) 555-9263", "784 555 9264", "219-09-9999", "call", "recall", "SSN", "or", "é🤗", ",", "4111 1", "a@b.co",
             "1.2.3.4", "host", "mail", "+1 784 555 9263", "filler words here", "1.2.3.400"]
    texts = ["Call (784) 555-9263 or (784) 555-9264.", "SSN 219-09-9999, 219-09-9998, 219-09-9997",
             "219-09-9999 219-09-9998 ssn", "call " + "(784) 555-9263 " * 4]
    texts += [" ".join(rng.choices(parts, k=rng.randint(1, 25))) for _ in range(150)]
    got = pii.find_pii(spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)).collect()
    for r in got:
        base = [s for s in r.pii if s.kind in pii.BASE]
        for s in base:
            assert s.score == pytest.approx(1.1 if near_word(s.kind, r.text, s.start, s.end) else 0.8), (r.text, s)
        for kind in ("national_id", "local_phone"):
            expected = [m.span() for m in re.finditer(pii.PATTERNS[kind], r.text)
                        if near_word(kind, r.text, *m.span())
                        and not re.search("[0-9+-]$", r.text[:m.start()]) and not re.match("[0-9-]", r.text[m.end():])
                        and not any(s.start < m.end() and m.start() < s.end for s in base)]
            assert [(s.start, s.end) for s in r.pii if s.kind == kind] == expected, r.text
    assert [len(r.pii) for t in texts[:4] for r in got if r.text == t] == [2, 3, 2, 3]


def test_ibans_end_where_they_should(spark):
    de, gb, no, fr = ("DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "NO9386011117947",
                      "FR14 2004 1010 0505 0001 3M02 606")
    own = "QX" + next(f"{c:02}" for c in range(2, 99) if int("1234567890" "101112" "2633" + f"{c:02}") % 97 == 1) + "1234567890ABC"
    cases = {f"{de} BIC COBADEFFXXX": [de], f"{de} Please": [de], f"{de} {gb}": [de, gb], f"{gb} {de} {no} 7": [gb, de, no],
             f"AB12 {de}": [de], f"é{fr} X": [fr], f"{own} {no}, {own}": [own, no, own], f"{de}X": [], f"{de}x": [], f"X{no}": [],
             f"pay {no} {no} {no} {no}": [no] * 4, f"{de}": [de], f"🤗 {de} 12 {gb}!": [de, gb]}
    got = pii.find_pii(spark.createDataFrame([(t,) for t in cases], "text string")).collect()
    assert {r.text: [r.text[s.start:s.end] for s in r.pii if s.kind == "iban"] for r in got} == cases


def test_masking(spark, messy):
    texts = {"write a@b.co, or +1 784 555 92 63!": "write [EMAIL], or [PHONE]!", "x@1.2.3.4 é": "[EMAIL] é",
             "12 a": "12 a", None: None, "": ""}
    got = pii.mask_pii(spark.createDataFrame([(t, "x") for t in texts], "text string, _spans string"))
    assert got.columns == ["text", "_spans"]
    assert sorted((r.text for r in got.collect()), key=str) == sorted(texts.values(), key=str)
    masked = pii.mask_pii(messy)
    assert masked.columns == messy.columns
    assert pii.find_pii(masked.select("text")).selectExpr("sum(size(pii))").first()[0] == 0


def test_empty_tables(nothing):
    assert line_dedup.drop_common_lines(nothing).count() == 0
    assert pii.find_pii(nothing).count() == pii.mask_pii(nothing).count() == 0


@pytest.mark.parametrize("make", [line_dedup.drop_common_lines, pii.find_pii, pii.mask_pii])
def test_no_python_in_the_plan(messy, monkeypatch, make):
    made, write = [], line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df, name: made.append(df) or write(df, name))
    made.append(make(messy))
    for df in made:
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_a_text_of_a_million_numbers(spark):
    """Positions take time in proportion to the matches."""
    text = " ,".join(str(k) for k in range(100_000, 1_100_000)) + " 4111 1111 1111 1111"
    started = time.monotonic()
    row = pii.find_pii(spark.createDataFrame([(text,)], "text string")).select("pii").first()
    assert time.monotonic() - started < 120
    assert [(s.kind, s.start, s.end) for s in row.pii] == [("card", len(text) - 19, len(text))]
