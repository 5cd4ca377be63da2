"""Importance resampling: features against a plain version, ranks, and awkward rows."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedkit.llm import resampling as R

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return PLAIN.findall(lowered)


def plain_buckets(text):
    w = plain_words(text)
    grams = [*w, *[f"{a} {b}" for a, b in zip(w, w[1:])]]
    return sorted(zlib.crc32(g.encode()) % R.BUCKETS for g in grams)


TEXTS = [
    "",
    " \n",
    "One",
    "A-b_c{d}É日本 x\x00y\x7fz 😀1 Straße İ K",
    "same same same",
    "tab\tand\r\nline  two   spaces",
    "éÉ" * 50,
    "!lead and trail?",
]


@pytest.mark.parametrize("text", TEXTS)
def test_features(text):
    found = list(R.Words().buckets(text.encode()))
    assert sorted(np.concatenate([b for _, b in found]).tolist()) == plain_buckets(text)
    assert sum(n for n, _ in found) == len(plain_words(text))


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_long_texts_are_cut_beside_words(size, monkeypatch):
    monkeypatch.setattr(R, "STRETCH", size)
    for text in TEXTS:
        found = list(R.Words().buckets(text.encode()))
        assert sorted(np.concatenate([b for _, b in found]).tolist()) == plain_buckets(text)


def test_one_long_text(spark):
    docs = spark.createDataFrame([(1, "Long words, " * 400_000)], "doc_id long, text string")
    row = R.importance(docs, docs).first()
    assert (row["n_words"], row["n_features"], row["weight"], row["rank"]) == (800_000, 1_599_999, 0, None)


def test_awkward_rows(spark, small):
    docs = small.withColumns({"score": F.lit("clash"), "c0": F.lit("mine"), "data": F.lit("d"), "id": F.lit("i")})
    target = spark.createDataFrame([("quick brown fox",), (None,), ("",)], "text string")
    rows = R.importance(docs, target).collect()
    assert len(rows) == small.count()
    assert all(r["weight"] == 0 for r in rows if r["n_features"] == 0)
    ranked = [r for r in rows if r["rank"] is not None]
    able = [r for r in rows if r["n_words"] >= R.MIN_WORDS]
    assert [r["rank"] for r in sorted(ranked, key=lambda r: r["rank"])] == list(range(1, len(able) * R.PERCENT // 100 + 1))
    drawn = R.resample(docs, target)
    assert drawn.columns == docs.columns and {r["data"] for r in drawn.collect()} <= {"d"}
    again = R.importance(docs, target).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))
    assert R.importance(docs.limit(0), target).count() == 0
    assert R.importance(docs, target.limit(0)).count() == small.count()


def test_ranks_of_ties_and_repeated_rows(spark):
    """Equal scores go by id; rows that agree in both are taken one by one. One score holds most rows."""
    rows = [(i % 50 if i % 7 else None, 30, 5 if i % 3 else i % 11) for i in range(4_000)]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, score long")
    got = R.draw(scored.repartition(5)).filter("rank IS NOT NULL").orderBy("rank").collect()
    want = sorted(rows, key=lambda r: (-r[2], r[0] is None, r[0] or 0))[:1_000]
    assert [(r["doc_id"], r["score"]) for r in got] == [(r[0], r[2]) for r in want]
    assert [r["rank"] for r in got] == list(range(1, 1_001))


def test_resample_prefers_the_target(spark):
    rows = [(i, ("apple pear plum " if i % 2 else "stone iron lead ") * 10, "x") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, of string")
    target = spark.createDataFrame([("apple pear plum " * 5_000,)], "text string")
    drawn = R.resample(docs, target)
    assert drawn.columns == docs.columns
    ids = [r["doc_id"] for r in drawn.collect()]
    assert len(ids) == 100 and sum(i % 2 for i in ids) > 90
