"""Operator 1, personal data: regular expressions propose spans, checksums
confirm them, nearby context words adjust the score.  DataFrame functions only.

Kinds, in report order:

=============  =====================================================  ==========
kind           confirmed by                                           score
=============  =====================================================  ==========
email          pattern                                                0.8
ip             four parts of at most 255                              0.8
card           13 to 19 digits, Luhn                                  0.8
phone          ``+`` form, 9 to 15 digits                             0.8
iban           15 to 34 letters and digits, mod 97 = 1, no part of    0.8
               a longer word
national_id    ddd-dd-dddd, not inside a longer number                0.4
local_phone    ddd ddd dddd without ``+``, not inside a number        0.4
=============  =====================================================  ==========

A context word within 40 code points of a span adds 0.3; spans of 0.6 and
more are reported.  So the first five stand alone, and the last two need
context.  The last three are left out where they overlap one of the first
four.  Spans are code points, the end exclusive.

An IBAN may be followed by a space and more capitals or digits, so every end
of a word from 15 to 34 is tested.  Of several that pass, the one its country
prescribes counts, else the longest; spans are taken from the left.

The positions come from ``split`` and ``regexp_extract_all`` with one pattern:
gaps and matches alternate, and their lengths add up to positions.  Context
is taken from the text, joined from the gaps and matches around a span, so it
doesn't end at the next match.  Patterns
use possessive loops, and the two with an open run at the front start at the
run's first character only, and positions are summed in chunks, so the search
takes time in proportion to the text and its matches (over a million numbers in
one text are tested).  What passes the checks is a few spans in real texts; the
tests for overlap compare the last three kinds with the first four, so a text
made of confirmed spans alone takes the product of their numbers.

Defined results: a null or empty text has no spans; repeated rows, ties and
null ids are scored row by row; output columns replace input columns of the
same name, all other columns stay; a very long text is searched whole, in one
task; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martwright.llm.common import fresh

CONTEXT, KEEP = 40, 0.6
CHUNK = 512  # matches whose positions are summed together
BASE = ("email", "ip", "card", "phone")
MORE = ("iban", "national_id", "local_phone")

# The contract's patterns in linear-time form, and our own.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}",
    "national_id": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "local_phone": r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}",
}
# Where an IBAN can start; its end is searched for from there.
IBAN_START = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})"
IBAN_AHEAD = 64  # the rest of 34 with spaces between, and what follows
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU",
}
CONTEXT_WORDS = {
    "email": "mail|contact",
    "ip": "ip|address|host|server",
    "card": "card|visa|credit|payment",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|account|bank",
    "national_id": "ssn|social|security",
    "local_phone": "phone|tel|call|mobile|fax",
}
# A cheap test that a text can hold the kind at all.
_HINT = {"email": lambda t: t.contains("@"), "phone": lambda t: t.contains("+")}

SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    doubled = F.transform(values, lambda d, i: F.when(i % 2 == 0, d).otherwise(
        d * 2 - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without spaces leaves 1 modulo 97 (letters count 10 to 35)."""
    turned = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))

    def step(a: Column, ch: Column) -> Column:
        code = F.ascii(ch)
        return F.when(code >= 65, (a * 100 + code - 55) % 97).otherwise((a * 10 + code - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _small(part: Column) -> Column:
    part = F.ltrim(part, F.lit("0"))
    return (F.length(part) < 3) | ((F.length(part) == 3) & (part <= "255"))


def _confirmed(kind: str, hit: Column, before: Column, after: Column) -> Column:
    n = F.length(_digits(hit))
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), _small)
    if kind == "card":
        return n.between(13, 19) & luhn(_digits(hit))
    if kind == "phone":
        return n.between(9, 15)
    if kind == "iban":
        return hit.isNotNull()
    if kind in ("national_id", "local_phone"):
        return ~before.rlike("[0-9+-]$") & ~after.rlike("^[0-9-]")
    return F.lit(True)


def _score(kind: str, before: Column, after: Column) -> Column:
    words = rf"(?i)\b(?:{CONTEXT_WORDS[kind]})"
    near = before.rlike(words) | after.rlike(words)
    return F.lit(0.4 if kind in MORE[1:] else 0.8) + F.when(near, 0.3).otherwise(0.0)


def _iban(words: Column) -> Column:
    """The IBAN that ``words`` start with, its spaces included; null if none."""
    parts = F.split(F.regexp_extract(words, r"^(?:\x20?[A-Z0-9]++(?![a-z]))++", 0), " ")
    plain = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice(parts, F.lit(1), k), "").alias("plain")))
    passed = F.filter(plain, lambda c: F.length(c["plain"]).between(15, 34) & mod97(c["plain"]))
    usual = F.create_map(*[F.lit(x) for n, codes in IBAN_LENGTHS.items() for c in codes.split() for x in (c, n)])
    best = F.array_max(F.transform(passed, lambda c: F.struct(
        F.coalesce(F.length(c["plain"]) == F.try_element_at(usual, F.left(c["plain"], F.lit(2))), F.lit(False)).alias("usual"),
        F.length(c["plain"]).alias("n"), c["k"].alias("k"))))
    return F.left(words, best["n"] + best["k"] - 1)


def _pieces(gaps: Column, hits: Column, width: int) -> Column:
    """For each match, the end of the text up to and with it, and the start of
    the text from it on, as far as its own two gaps tell."""
    return F.transform(hits, lambda h, i: F.struct(
        F.concat(F.right(F.get(gaps, i), F.lit(CONTEXT)), F.right(h, F.lit(CONTEXT))).alias("back"),
        F.concat(F.left(h, F.lit(width)), F.left(F.get(gaps, i + 1), F.lit(width))).alias("ahead")))


def _around(gaps: Column, hits: Column, pieces: Column, width: int) -> Column:
    """Each match with the ``CONTEXT`` code points of text before it and the
    ``width`` after it."""
    most = width // 2  # a match has at least two code points

    def around(hit: Column, i: Column) -> Column:
        back = F.slice(pieces, F.greatest(i - most, F.lit(0)) + 1, F.least(i, F.lit(most)))["back"]
        ahead = F.slice(pieces, i + 2, F.lit(most))["ahead"]
        before = F.concat(F.array_join(back, ""), F.right(F.get(gaps, i), F.lit(CONTEXT)))
        after = F.concat(F.left(F.get(gaps, i + 1), F.lit(width)), F.array_join(ahead, ""))
        return F.struct(hit.alias("hit"), F.right(before, F.lit(CONTEXT)).alias("before"),
                        F.left(after, F.lit(width)).alias("after"))

    return F.transform(hits, around)


def _whole_ibans(around: Column) -> Column:
    """Starts of IBANs, each made the whole of its IBAN (null if there is none)."""
    words = F.transform(around, lambda m: F.struct(
        m["before"].alias("before"), F.concat(m["hit"], m["after"]).alias("words"),
        _iban(F.concat(m["hit"], F.left(m["after"], F.lit(IBAN_AHEAD)))).alias("hit")))
    return F.transform(words, lambda m: F.struct(
        m["hit"].alias("hit"), m["before"].alias("before"),
        F.substring(m["words"], F.length(m["hit"]) + 1, F.lit(CONTEXT)).alias("after")))


def _from_the_left(spans: Column) -> Column:
    """``spans`` without those that start inside an earlier one."""
    def add(kept: Column, s: Column) -> Column:
        end = F.coalesce(F.get(kept, F.size(kept) - 1)["end"], F.lit(0))
        return F.when(s["start"] < end, kept).otherwise(F.concat(kept, F.array(s)))

    return F.aggregate(spans, F.array().cast(SPAN), add)


def _running(values: Column) -> Column:
    """Running sums of an array of whole numbers.

    A fold that appends copies its result at every step, so it is kept short:
    within chunks of ``CHUNK`` values, and over the chunks' sums.
    """
    def sums(xs: Column) -> Column:
        return F.aggregate(xs, F.array().cast("array<int>"), lambda a, x: F.concat(
            a, F.array(F.coalesce(F.get(a, F.size(a) - 1), F.lit(0)) + x)))

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int")),
                         lambda c: sums(F.slice(values, c * CHUNK + 1, F.lit(CHUNK))))
    # with the sum of all chunks before each, in front of the first a zero
    before = sums(F.concat(F.array(F.lit(0)), F.transform(chunks, lambda c: F.element_at(c, -1))))
    return F.flatten(F.zip_with(chunks, F.slice(before, F.lit(1), F.size(chunks)),
                                lambda c, o: F.transform(c, lambda x: x + o)))


def _kind_spans(kind: str, gaps: Column, hits: Column, around: Column) -> Column:
    """Confirmed spans of one kind from its gaps and matches."""
    # of the gaps and matches alone, an IBAN's match being its start
    ends = _running(F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.length(g) + F.length(h)))

    def span(m: Column, at: Column) -> Column:
        start = at - (4 if kind == "iban" else F.length(m["hit"]))
        return F.when(_confirmed(kind, m["hit"], m["before"], m["after"]), F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(m["hit"])).alias("end"),
            _score(kind, m["before"], m["after"]).alias("score")))

    found = F.filter(F.zip_with(around, ends, span), lambda s: s.isNotNull() & (s["score"] >= KEEP))
    if kind == "iban":
        found = _from_the_left(found)
    return F.when(F.size(hits) > 0, found).otherwise(F.array().cast(SPAN))


def find_pii(docs: DataFrame, text_col: str = "text", out_col: str = "pii") -> DataFrame:
    """``docs`` with ``out_col``: array of (kind, start, end, score), by kind
    as listed above, then start.  No shuffle."""
    t, = fresh(docs, "_text")
    df = docs.withColumn(t, F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    none = F.array().cast("array<string>")
    by_kind = {}
    for kind in (*BASE, *MORE):
        hits, gaps, pieces, around, out = fresh(
            df, f"_{kind}_hits", f"_{kind}_gaps", f"_{kind}_pieces", f"_{kind}_around", f"_{kind}")
        pattern, width = (IBAN_START, IBAN_AHEAD + CONTEXT) if kind == "iban" else (PATTERNS[kind], CONTEXT)
        maybe = _HINT.get(kind, lambda c: c.rlike("[0-9]"))(F.col(t))
        df = df.withColumn(hits, F.when(maybe, F.regexp_extract_all(
            F.col(t), F.lit(pattern), F.lit(0))).otherwise(none))
        df = df.withColumn(gaps, F.when(F.size(hits) > 0, F.split(F.col(t), pattern, -1)).otherwise(none))
        # columns of their own, so that no match makes them anew
        df = df.withColumn(pieces, _pieces(F.col(gaps), F.col(hits), width))
        df = df.withColumn(around, _around(F.col(gaps), F.col(hits), F.col(pieces), width))
        if kind == "iban":
            df = df.withColumn(around, _whole_ibans(F.col(around)))
        df = df.withColumn(out, _kind_spans(kind, F.col(gaps), F.col(hits), F.col(around)))
        df = df.drop(hits, gaps, pieces, around)
        by_kind[kind] = out
    base, = fresh(df, "_base")
    df = df.withColumn(base, F.concat(*[F.col(by_kind[k]) for k in BASE]))

    def apart(spans: str) -> Column:
        return F.filter(F.col(spans), lambda s: ~F.exists(
            F.col(base), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))

    found = F.concat(F.col(base), *[apart(by_kind[k]) for k in MORE])
    return df.withColumn(out_col, found).drop(t, base, *by_kind.values())


def span_list(spans: Column, base_only: bool = False) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    if base_only:
        spans = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def mask_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets.

    Spans that overlap are masked together, under the kind of the first.
    Texts without spans stay as they are (null stays null).
    """
    spans, = fresh(docs, "_spans")
    df = find_pii(docs, text_col, spans)
    text = F.col(f"`{text_col}`")
    ordered = F.array_sort(F.transform(F.col(spans), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def merge(a: Column, s: Column) -> Column:
        last = F.get(a, F.size(a) - 1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"),
                          last["kind"].alias("kind"))
        return F.when((F.size(a) > 0) & (s["start"] < last["end"]),
                      F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(joined))
                      ).otherwise(F.concat(a, F.array(s)))

    merged, = fresh(df, "_merged")
    df = df.withColumn(merged, F.when(F.size(spans) > 0, F.aggregate(
        ordered, F.array().cast("array<struct<start:int,end:int,kind:string>>"), merge)))
    m = F.col(merged)

    def piece(s: Column, i: Column) -> Column:
        start = F.when(i == 0, F.lit(0)).otherwise(F.get(m, i - 1)["end"])
        return F.concat(F.substring(text, start + 1, s["start"] - start), F.lit("["), F.upper(s["kind"]), F.lit("]"))

    tail = F.substring(text, F.get(m, F.size(m) - 1)["end"] + 1, F.length(text))
    masked = F.concat(F.array_join(F.transform(m, piece), ""), tail)
    return df.withColumn(text_col, F.when(m.isNotNull(), masked).otherwise(text)).drop(spans, merged)
