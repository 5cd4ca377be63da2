"""Segments against a plain version, what is learned, held-out labels and awkward rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from feedkit.llm import toxicity as T
from feedkit.llm.queries import QUERIES


def plain_segments(scores):
    """The best stretch, then the same to its left and right."""
    best = None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 1e-12 and (best is None or total > best[2] + 1e-9):
                best = (i, j + 1, total)
    if best is None:
        return []
    a, b, _ = best
    return [*plain_segments(scores[:a]), best, *[(i + b, j + b, s) for i, j, s in plain_segments(scores[b:])]]


@pytest.mark.parametrize("seed", range(60))
def test_segments(seed):
    r = random.Random(seed)
    scores = [r.uniform(0.05, 1.0) if r.random() < 0.3 else -0.25 for _ in range(r.randrange(50))]
    got = sorted(T.segments([(i, s) for i, s in enumerate(scores) if s > 0], 0.25))
    want = plain_segments(scores)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want])


def test_tokens_of_long_texts(monkeypatch):
    text = "Wörter,and 漢字 more-words\n" * 40
    whole = list(T.tokens(text.encode()))
    monkeypatch.setattr(T, "STRETCH", 5)
    assert list(T.tokens(text.encode())) == whole
    assert [n for n, _ in T.stretches(text.encode())][1] > 0
    assert list(T.tokens(b"")) == []


def test_token_scores():
    counts = {b"bad": (40, 0), b"the": (50, 500), b"rare": (3, 0), b"twice": (2, 0), b"lose*": (40, 1), b"loser": (39, 0), b"stem*": (40, 2), b"stema": (9, 0)}
    found = T.token_scores(counts, 50, 500)
    assert {b"bad", b"loser", b"stem*"} <= set(found) and not {b"the", b"twice", b"lose*", b"rare"} & set(found)
    assert T.token_scores(counts, 0, 500) == T.token_scores(counts, 50, 0) == {}


def test_common_words_of_longer_documents_have_no_score():
    """Enough documents make any difference certain; a small one is no evidence."""
    counts = {b"and": (1900, 15000), b"this": (1500, 11000), b"bad": (300, 100)}
    assert set(T.token_scores(counts, 2000, 18000)) == {b"bad"}


def test_words_of_longer_documents_are_not_learned(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(600):
        y = int(i % 4 == 0)
        text = r.choices(words, k=150 if y else 70)
        rows.append((i, " ".join([*text, "vile", "foul"] if y else text), y))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = T.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert {b"vile", b"foul"} <= set(model.lexicon) and not [t for t in model.lexicon if t.startswith(b"w")]


def test_evidence_falls_with_length():
    tail = T.fit_tail([(1000, [(0, 1, 1.0)]), (1000, [(5, 6, 2.0)]), (1000, [])])
    short, long = tail.evidence(100, [(0, 1, 9.0)]), tail.evidence(100_000, [(0, 1, 9.0)])
    assert short > long > 0 and tail.evidence(100, []) == 0


def make_docs(spark, n=600):
    """Every fifth document has a passage of insults; clean ones share all other words, and some hold one insult."""
    r, rows, labels = random.Random(3), [], []
    words = [f"w{i}" for i in range(300)]
    bad = ["vile", "nasty", "rotten", "foul"]
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randrange(30, 200))]
        toxic = i % 5 == 0
        if toxic:
            at = r.randrange(len(text))
            text[at:at] = [r.choice(bad) if r.random() < 0.6 else r.choice(words) for _ in range(12)]
        elif i % 40 == 1:
            text.append(r.choice(bad))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_finds_passages_that_labels_point_to(spark):
    docs, labels = make_docs(spark)
    model = T.fit(docs, labels)
    assert {b"vile", b"nasty", b"rotten", b"foul"} <= set(model.lexicon)
    rows = T.find_passages(docs, model).collect()
    held = [r for r in rows if T.zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    right = sum((r["score"] >= 0.5) == (r["doc_id"] % 5 == 0) for r in held)
    assert right > 0.97 * len(held)
    for r in rows:
        words = r["text"].split()
        for p in r["passages"]:
            assert 0 <= p["first"] < p["end"] <= len(words) and p["expected"] < 1
        if r["doc_id"] % 5 == 0 and r["score"] >= 0.5:
            assert any(w in ("vile", "nasty", "rotten", "foul") for p in r["passages"] for w in words[p["first"] : p["end"]])


def test_many_copies_of_a_toxic_document_teach_no_clean_words(spark):
    docs, labels = make_docs(spark)
    copied = docs.filter("doc_id = 0").crossJoin(spark.range(1_000, 2_000).select("id")).select(F.col("id").alias("doc_id"), "text")
    model = T.fit(docs.unionByName(copied), labels.unionByName(copied.select("doc_id", F.lit(1).alias("toxic"))))
    assert len(set(model.lexicon) ^ set(T.fit(docs, labels).lexicon)) <= 2


def test_awkward_rows(spark, small):
    docs = small.withColumns({"score": F.lit("clash"), "passages": F.lit(1), "data": F.lit("mine"), "_data": F.lit("too")})
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0), (99, 1)], "doc_id long, toxic int")
    model = T.fit(docs, labels)
    rows = T.find_passages(docs, model).collect()
    assert len(rows) == small.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["data"] for r in rows} == {"mine"} and {r["_data"] for r in rows} == {"too"}
    empty = T.fit(docs.limit(0), labels.limit(0))
    assert empty.lexicon == {} and len({r["score"] for r in T.find_passages(docs, empty).collect()}) == 1
    assert T.find_passages(docs.limit(0), model).count() == 0


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op12_toxicity"](spark, sf).collect() if r["doc_id"] in labels]
    clean = [r["predicted"] for r in rows if r["held_out"] and labels[r["doc_id"]] == 0]
    toxic = [r["predicted"] for r in rows if r["held_out"] and labels[r["doc_id"]] == 1]
    assert sum(clean) <= 0.05 * len(clean) and sum(toxic) >= 0.6 * len(toxic)
