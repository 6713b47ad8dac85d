"""Personal data in text, with DataFrame functions only.

Regular expressions propose spans, checksums confirm them, and words nearby
adjust a score.  *Base* kinds (email, ip, card, phone) keep every span that
passes its check; *further* kinds (iban, national phone numbers, social
security numbers) also need a score of ``KEEP_AT`` and must not overlap a base
span.  Spans are code points, end exclusive.

A pattern's matches are leftmost and do not overlap; a match that fails its
check is dropped and not retried.  Positions come from the lengths of the
matches and of the text between them, summed in blocks, so that a text with
many matches costs near-linear time.  Patterns use possessive quantifiers and
lookbehind at the start of a run: the same matches, without backtracking, and
without a restart at each character of a long run.

Null text counts as empty: no spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP_AT = 0.5
#: code points before and after a span that are searched for context words
BEFORE, AFTER = 48, 24
_BLOCK = 64

BASE = ("email", "ip", "card", "phone")
FURTHER = ("iban", "national_phone", "ssn")

PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a maximal run of digits with single separators, of 12 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
    "national_phone": r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: a text without this character cannot match
NEEDS = {"email": "@", "phone": "+", "ip": "."}
#: score before context, and words that raise it by CONTEXT when they stand nearby
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.7, "national_phone": 0.2, "ssn": 0.2}
CONTEXT = 0.4
WORDS = {
    "email": r"\b(?:e-?mail|contact|correo|courriel|write to)\b",
    "ip": r"\b(?:ip|address|host|server|client)\b",
    "card": r"\b(?:card|visa|mastercard|amex|credit|karte|carte|tarjeta)\b",
    "phone": r"\b(?:phone|tel|telephone|call|mobile|cell|fax|telefon|handy)\b",
    "iban": r"\b(?:iban|bank|account|konto|compte|cuenta)\b",
    "national_phone": r"\b(?:phone|tel|telephone|call|mobile|cell|fax|telefon|handy)\b",
    "ssn": r"\b(?:ssn|social security)\b",
}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The Luhn check of a string of ASCII digits."""
    def value(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((F.length(digits) - i) % 2 == 1, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + value(i))
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """The IBAN check of a string of A-Z and 0-9: rotated by four, letters as 10 to 35, remainder 1."""
    moved = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))

    def step(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 65, (acc * 10 + code - 48) % 97).otherwise((acc * 100 + code - 55) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(step(acc, c))) == 1


_PART = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})?"


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return found.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return luhn(_digits(found))
    if kind == "phone":
        return F.length(_digits(found)).between(9, 15)
    if kind == "iban":
        return mod97(F.regexp_replace(found, r"\x20", ""))
    if kind == "ssn":
        return ~found.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _with_matches(df: DataFrame, kind: str) -> DataFrame:
    """Add ``m_<kind>`` (the matches) and ``g_<kind>`` (the length of the gap before each)."""
    text, pattern = F.col("_text"), F.lit(PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    if kind in NEEDS:
        found = F.when(F.contains(text, F.lit(NEEDS[kind])), found).otherwise(F.array().cast("array<string>"))
    df = df.withColumn(f"m_{kind}", found)
    # Java's split keeps a text's leading and, with -1, trailing empty pieces
    gaps = F.transform(F.split(text, PATTERNS[kind], -1), lambda piece: F.length(piece))
    return df.withColumn(f"g_{kind}", F.when(F.size(f"m_{kind}") > 0, gaps).otherwise(F.array().cast("array<int>")))


def _with_spans(df: DataFrame, kind: str, order: int) -> DataFrame:
    """Replace them by ``s_<kind>``: ``start, order, end, kind, score`` of each match that passes its check."""
    m, g, steps, sums = (F.col(f"{c}_{kind}") for c in "mgtp")
    df = df.withColumn(f"t_{kind}", F.zip_with(F.slice(g, 1, F.size(m)), m, lambda gap, x: gap + F.length(x)))
    # p: the sum of all steps before each block
    blocks = F.sequence(F.lit(0), F.floor(F.size(steps) / _BLOCK).cast("int"))
    df = df.withColumn(f"p_{kind}", F.aggregate(
        blocks, F.array(F.lit(0)),
        lambda acc, b: F.concat(acc, F.array(F.element_at(acc, -1) + F.aggregate(
            F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0), lambda n, x: n + x)))))

    def span(x: Column, k: Column) -> Column:
        block = F.floor(k / _BLOCK).cast("int")
        before = F.element_at(sums, block + 1) + F.aggregate(
            F.slice(steps, block * _BLOCK + 1, k % _BLOCK), F.lit(0), lambda n, s: n + s)
        start = before + F.element_at(g, k + 1)
        return F.struct(start.alias("start"), F.lit(order).alias("order"),
                        (start + F.length(x)).alias("end"), F.lit(kind).alias("kind"), x.alias("text"))

    df = df.withColumn(f"s_{kind}", F.filter(F.transform(m, span), lambda s: _valid(kind, s["text"])))

    def scored(s: Column) -> Column:
        text = F.col("_text")
        near = F.concat_ws(" ", F.substring(text, F.greatest(s["start"] - BEFORE, F.lit(0)) + 1,
                                            F.least(s["start"], F.lit(BEFORE))),
                           F.substring(text, s["end"] + 1, F.lit(AFTER)))
        lift = F.when(F.lower(near).rlike(WORDS[kind]), F.lit(CONTEXT)).otherwise(F.lit(0.0))
        return F.struct(s["start"].alias("start"), s["order"].alias("order"), s["end"].alias("end"),
                        s["kind"].alias("kind"), F.least(F.lit(SCORES[kind]) + lift, F.lit(1.0)).alias("score"))

    return (df.withColumn(f"s_{kind}", F.transform(f"s_{kind}", scored))
            .drop(*[f"{c}_{kind}" for c in "mgtp"]))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, further``: arrays of ``start, order, end, kind, score``, by start, then kind."""
    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kinds = BASE + FURTHER
    for kind in kinds:
        df = _with_matches(df, kind)
    for order, kind in enumerate(kinds):
        df = _with_spans(df, kind, order)
    df = df.select("doc_id", F.array_sort(F.concat(*[F.col(f"s_{k}") for k in BASE])).alias("base"),
                   F.concat(*[F.col(f"s_{k}") for k in FURTHER]).alias("more"))
    further = F.filter("more", lambda s: (s["score"] >= KEEP_AT) & ~F.exists(
        "base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return df.select("doc_id", "base", F.array_sort(further).alias("further"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")
