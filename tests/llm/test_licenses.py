"""Notices found in whole, damaged and awkward texts."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from feedkit.llm import licenses as lic


def found(spark, texts, templates=lic.TEMPLATES):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: set(filter(None, r["licenses"].split(","))) for r in lic.license_digest(docs, templates).collect()}


def test_every_notice_is_found_anywhere(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(50)]
    texts = []
    for name, notice in lic.TEMPLATES:
        before, after = (" ".join(rnd.choices(words, k=rnd.randint(0, 90))) for _ in range(2))
        texts.append(f"{before} {notice.upper() if rnd.random() < 0.3 else notice}\n{after}")
    got = found(spark, texts)
    assert all(name in got[i] for i, (name, _) in enumerate(lic.TEMPLATES))


def plain(text, templates):
    """Licenses of which a window of the grid holds enough shingles."""
    words = lic._plain_words(text or "")
    shingles = [tuple(words[i : i + lic.SHINGLE]) for i in range(len(words) - lic.SHINGLE + 1)]
    out = set()
    for name, notice in templates:
        wanted = set(lic._plain_shingles(notice))
        step = 1 << (len(wanted).bit_length() - 1)
        for first in range(0, len(shingles), step):
            if 100 * len(wanted & set(shingles[first : first + 3 * step])) >= lic.PERCENT * len(wanted):
                out.add(name)
    return out


def test_damaged_notices_equal_brute_force(spark):
    rnd = random.Random(9)
    texts = []
    for _ in range(120):
        words = rnd.choice(lic.TEMPLATES)[1].split()
        for _ in range(rnd.randint(0, 3)):
            words[rnd.randrange(len(words))] = "changed"
        texts.append(" ".join(["filler"] * rnd.randint(0, 40) + words + ["filler"] * rnd.randint(0, 40)))
    assert found(spark, texts) == {i: plain(t, lic.TEMPLATES) for i, t in enumerate(texts)}


def test_every_passing_window_holds_a_marked_word():
    marked = set(lic.marks())
    for _, notice in lic.TEMPLATES:
        shingles = set(lic._plain_shingles(notice))
        unmarked = [s for s in shingles if not marked & set(s)]
        assert 100 * len(unmarked) < lic.PERCENT * len(shingles)


def test_awkward_rows(spark, small):
    notice = spark.createDataFrame([(9, "Released under the MIT License."), (9, "Licensed under CC BY 4.0."), (None, "Released under the MIT License.")], "doc_id long, text string")
    docs = small.select("doc_id", "text").union(notice).withColumn("licenses", F.lit("clash"))
    rows = lic.license_digest(docs).collect()
    assert len(rows) == docs.count()
    assert {r["licenses"] for r in rows if r["doc_id"] == 9} == {"CC-BY-4.0,MIT"}
    assert {r["licenses"] for r in rows if r["doc_id"] in (1, 2, 3, 4, 5, 6, 8)} == {""}
    spans = lic.find_licenses(docs).filter("id IS NULL").collect()
    assert {r["license"] for r in spans} == {"MIT"}
    assert lic.license_digest(docs.limit(0)).count() == 0
