"""Base spans against plain Python, checksums and context."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from feedkit.llm import pii
from feedkit.llm.queries import QUERIES

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for no, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), no, kind, m.end()))
    return sorted(out)


ODD = [
    None,
    "",
    "a@b.c_d@e.f",
    "x" * 9000 + "@y",
    "a@b.c." * 50,
    "é😀 a.b+c@d-e.fr, 1.2.3.4.5.6.7.8 and 256.1.1.1 0001.2.3.255",
    "4111 1111-1111 1111 x 4111111111111112 4111  1111",
    "+1 (555) 555-1234 +12 +1--2 +49 (0) 30.123456789012345678",
    "0" * 12,
    "7" * 30000,
    "1.1.1.1.1 +1.1.1.1.1.1.1.1.1",
    "..@..@a.b@c.d",
    "a@b.c@d.e@f.g",
]


def test_base_spans_equal_plain_expressions(spark, sf_dir):
    texts = [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()] + ODD
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = pii.find_pii(docs).select("doc_id", "pii").collect()
    for doc, spans in got:
        found = [(s["start"], s["no"], s["kind"], s["end"]) for s in spans if s["kind"] in pii.BASE]
        assert found == base_spans(texts[doc]), texts[doc]
        for s in spans:
            assert texts[doc][s["start"] : s["end"]] == s["value"]


def test_added_kinds_need_a_checksum_or_context(spark):
    rows = [
        (1, "IBAN DE89 3704 0044 0532 0130 00 here"),
        (2, "IBAN DE88 3704 0044 0532 0130 00 here"),
        (3, "my ssn is 123-45-6789"),
        (4, "part 123-45-6789 of it"),
        (5, 'token = "0cab398dc11d1a2a11dc6572c8df8bd228c864f3" and password=f48865c76c86ee5394 x'),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: [s["kind"] for s in r[1]] for r in pii.find_pii(docs).select("doc_id", "pii").collect()}
    assert [got[i] for i in (1, 3, 5)] == [["iban"], ["ssn"], ["secret", "secret"]]
    assert "iban" not in got[2] and got[4] == []


def test_luhn_and_mod97(spark):
    one = spark.range(1)
    assert one.select(pii.luhn(F.lit("4111111111111111")), pii.luhn(F.lit("4111111111111112"))).first()[:] == (True, False)
    assert one.select(pii.mod97(F.lit("GB82WEST12345698765432")), pii.mod97(F.lit("GB82WEST12345698765431"))).first()[:] == (True, False)


def test_context_raises_the_score(spark):
    docs = spark.createDataFrame([(1, "call 4111111111111111"), (2, "visa card 4111111111111111")], "doc_id long, text string")
    scores = [r[0][0]["score"] for r in pii.find_pii(docs).orderBy("doc_id").select("pii").collect()]
    assert scores[0] < scores[1] <= 1


def test_awkward_rows(spark, small):
    docs = small.withColumn("pii", F.lit("clash"))
    assert pii.find_pii(docs).count() == small.count()
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_query(spark, sf_dir):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    for row in QUERIES["op10_pii"](spark, sf_dir).collect():
        base = base_spans(texts[row["doc_id"]])
        joined = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in base)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in PLAIN] == [sum(b[2] == k for b in base) for k in PLAIN]
        assert set(filter(None, joined.split(","))) <= set(row["spans"].split(","))


def test_ibans_end_where_their_country_says(spark):
    iban = "DE89 3704 0044 0532 0130 00"
    rows = [
        (1, f"IBAN {iban} Please pay", [iban]),
        (2, "DE89370400440532013000 BIC COBADEFF", ["DE89370400440532013000"]),
        (3, f"{iban} 2 times, then GB82 WEST 1234 5698 7654 32 AND MORE", [iban, "GB82 WEST 1234 5698 7654 32"]),
        (4, f"ID AB12 {iban}", [iban]),
        (5, f"{iban}7 and x{iban}", []),
        (6, f"é😀 {iban}", [iban]),
        (7, "NO93 8601 1117 947 BE68 5390 0754 7034 X", ["NO93 8601 1117 947", "BE68 5390 0754 7034"]),
    ]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.find_pii(docs).collect()}
    for i, text, want in rows:
        found = [s for s in got[i]["pii"] if s["kind"] == "iban"]
        assert [s["value"] for s in found] == want
        assert all(text[s["start"] : s["end"]] == s["value"] for s in found)


def test_long_secrets_are_whole(spark):
    secret = "eyJhbGciOi.J9-_" * 400
    docs = spark.createDataFrame([(1, f"token={secret} x")], "doc_id long, text string")
    found = [s for s in pii.find_pii(docs).first()["pii"] if s["kind"] == "secret"]
    assert [(s["start"], s["value"]) for s in found] == [(0, f"token={secret}")]
