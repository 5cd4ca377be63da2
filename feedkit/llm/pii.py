"""Personal data in texts: expressions propose spans, checksums confirm them, words nearby move their score.

Everything is Spark's own functions. Spark gives the matches of an expression and the text between them, but not their
places; ``spans`` adds up the lengths of both. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The four base kinds. Each expression finds what the plain one in the comment finds, leftmost first and
# without overlaps. Possessive quantifiers and the look-behind keep the time in proportion to the text: a match can
# only begin at the start of a run of its characters, or (\G) where the last match ended.
BASE = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Characters of an IBAN by country. A code that is not listed takes as many as follow.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_LISTED = "|".join(" ".join(IBAN_LENGTHS.values()).split())
_BY_LENGTH = "|".join(rf"(?:{x.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, x in IBAN_LENGTHS.items())
IBAN = rf"^(?:{_BY_LENGTH}|(?!{_LISTED})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}+)(?![A-Za-z0-9])"
# Added kinds. The expression of an IBAN finds where one may begin, so that none hides behind a false beginning; it is confirmed by its remainder mod 97, a national number by its ranges and the words near it, a
# secret by the name it is assigned to.
ADDED = {
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "secret": r"""(?i:(?<![a-z0-9])(?:password|passwd|pwd|secret|token|api[_-]?key)\x20?[=:]\x20?["']?)[A-Za-z0-9_/+.-]{8,}+""",
}
KINDS = {**BASE, **ADDED}
# A text without this expression holds no span of the kind and is not searched.
HINTS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
DIGIT = r"[0-9]"
OCTET = r"0*+(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
# Words that speak for a kind when they stand within CONTEXT characters before or after a span.
WORDS = {
    "email": "mail|contact|write|reach",
    "ip": r"ip\b|address|host|server|login",
    "card": "card|visa|master|credit|debit|carte|karte|tarjeta",
    "phone": "phone|call|tel|mobile|fax|appel|anruf|llame",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "ssn": "ssn|social|security|insurance",
    "secret": "password|secret|token|key|login",
}
CONTEXT = 40
# Score of a confirmed span, and what a word nearby adds.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "secret": 0.6}
BONUS = 0.2
# Added spans below this score are dropped. Base spans always stay.
KEEP = 0.5


def spans(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of all matches, in order."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(0))
    # Fold over the matches: ``at`` is where the last one ended.
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"))

    def step(acc: Column, m: Column) -> Column:
        begin = acc["at"] + m["gap"]
        end = begin + F.length(m["value"])
        span = F.struct(begin.alias("start"), end.alias("end"), m["value"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(acc["out"], span).alias("out"))

    gaps = F.transform(F.slice(between, 1, F.size(found)), lambda g: F.length(g))
    pairs = F.zip_with(gaps, found, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def whole_ibans(text: Column, heads: Column) -> Column:
    """The spans of the IBANs that begin with the given ones."""

    def whole(s: Column) -> Column:
        # 34 characters with a space before each but the first, and the one behind.
        value = F.regexp_extract(F.substr(text, s["start"] + 1, F.lit(68)), IBAN, 0)
        end = s["start"] + F.length(value)
        return F.struct(s["start"].alias("start"), end.alias("end"), value.alias("value"))

    return F.filter(F.transform(heads, whole), lambda s: s["value"] != "")


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c: F.ascii(c) - 48)
    doubled = F.transform(values, lambda v, i: F.when(i % 2 == 0, v).when(v > 4, 2 * v - 9).otherwise(2 * v))
    return F.aggregate(doubled, F.lit(0), lambda a, v: a + v) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without spaces leaves the remainder 1: country and check digits last, letters as 10 to 35."""
    moved = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))
    codes = F.transform(F.split(moved, ""), lambda c: F.when(F.ascii(c) < 58, F.ascii(c) - 48).otherwise(F.ascii(c) - 55))
    return F.aggregate(codes, F.lit(0), lambda a, v: F.when(v < 10, a * 10 + v).otherwise(a * 100 + v) % 97) == 1


def confirmed(kind: str, value: Column) -> Column:
    """What a match must pass beyond its expression."""
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.rlike(f"^{OCTET}$"))
    if kind == "card":
        digits = digits_of(value)
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits_of(value)).between(9, 15)
    if kind == "iban":
        plain = F.replace(value, F.lit(" "), F.lit(""))
        return F.length(plain).between(15, 34) & mod97(plain)
    return F.lit(True)


def score(kind: str, text: Column, span: Column) -> Column:
    """Prior of the kind, plus a bonus for a word of the kind before or after the span."""
    before = F.substr(text, F.greatest(span["start"] - CONTEXT + 1, F.lit(1)), F.least(span["start"], F.lit(CONTEXT)))
    after = F.substr(text, span["end"] + 1, F.lit(CONTEXT))
    near = F.concat_ws(" ", before, after).rlike(f"(?i){WORDS[kind]}")
    return F.least(F.lit(1.0), F.lit(PRIOR[kind]) + F.when(near, F.lit(BONUS)).otherwise(F.lit(0.0)))


def find_pii(docs: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """Adds one array column of (start, no, kind, end, value, score), by start and then by the order of KINDS.

    A null or empty text has no spans. Spans of different kinds may overlap. Other columns are kept as they are, a
    column that has the name ``into`` is replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    type_ = "array<struct<start:int,no:int,kind:string,end:int,value:string,score:double>>"
    return docs.withColumn(into, F.sort_array(F.concat(*[_of_kind(kind, whole) for kind in KINDS]).cast(type_)))


def _of_kind(kind: str, text: Column) -> Column:
    """Confirmed and rated spans of one kind. A text that cannot hold any is not searched."""
    hint = F.contains(text, F.lit(HINTS[kind])) if kind in HINTS else F.lit(True)
    if kind in ("ip", "card", "phone", "ssn", "iban"):
        hint = hint & text.rlike(DIGIT)
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    raw = F.when(hint, spans(text, KINDS[kind])).otherwise(none)
    raw = whole_ibans(text, raw) if kind == "iban" else raw
    rated = F.transform(
        F.filter(raw, lambda s: confirmed(kind, s["value"])),
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(list(KINDS).index(kind)).alias("no"),
            F.lit(kind).alias("kind"),
            s["end"].alias("end"),
            s["value"].alias("value"),
            score(kind, text, s).alias("score"),
        ),
    )
    return rated if kind in BASE else F.filter(rated, lambda s: s["score"] >= KEEP)
