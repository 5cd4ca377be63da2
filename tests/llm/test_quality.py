"""Measures against brute force, and a verdict that does not depend on the order of the rules."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from feedkit.llm import quality


def plain_measures(text):
    words = [w for w in "".join(" " if c in "\x20\x09\x0a\x0b\x0c\x0d" else c for c in text or "").split(" ") if w]
    lines = [x for x in (text or "").split("\n") if x.strip("\x20\x09\x0b\x0c\x0d")]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit)


def test_measures(spark):
    rnd = random.Random(2)
    alphabet = ["a", "b", "é", "😀", "\x85", "\xa0", "\x1c", " ", "\n", "\t", "\r", "#", "|", "the"]
    texts = ["".join(rnd.choices(alphabet, k=rnd.randint(0, 120))) for _ in range(300)] + [None, "", "a a a a a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.judge(docs, quality.RULES).collect():
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert got == plain_measures(r["text"]), repr(r["text"])
        assert r["base_failed"] == (got[0] < 50 or 100 * got[4] > 50 * got[0])


def test_the_verdict_does_not_depend_on_the_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one, two = (quality.judge(docs, r).select("doc_id", "kept").collect() for r in (quality.RULES, quality.RULES[::-1]))
    assert sorted(one) == sorted(two)
    assert {r["doc_id"] for r in quality.keep_good(docs).collect()} == {d for d, kept in one if kept}


def test_order_is_by_rejections_per_second(spark):
    def slow(t):
        return sum(range(20_000)) < 0

    rules = [quality.Rule("slow", slow), quality.Rule("never", lambda t: False), quality.Rule("often", lambda t: len(t.data) % 2 == 0)]
    docs = spark.range(60).select(F.concat(F.repeat(F.lit("the cat of id "), 1), *[F.concat(F.lit(f" w{k}x"), "id") for k in range(60)]).alias("text"))
    assert [r.name for r in quality.ordered(docs, "text", rules)][0] == "often"
    assert [r.name for r in quality.ordered(docs, "text", rules)][-1] == "slow"


def test_labelled_documents(spark, sf_dir):
    """Documents labelled as good are kept if they are long enough, most of the others go."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    rows = quality.judge(docs, quality.RULES).collect()
    assert all(r["kept"] or r["base_failed"] for r in rows if r["quality"] == 1)
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(bad) <= 0.1 * len(bad)


def test_awkward_rows(spark, small):
    docs = small.withColumn("kept", F.lit("clash"))
    rows = quality.judge(docs, quality.ordered(docs)).collect()
    assert len(rows) == small.count() and not any(r["kept"] for r in rows if r["doc_id"] in (2, 3, 4, 5))
    assert quality.keep_good(docs.limit(0)).count() == 0
    assert quality.keep_good(small).columns == small.columns


def test_own_columns_are_kept(spark, small):
    docs = small.withColumns({c: F.lit(c) for c in ("data", "_data", "Kept", "n_words", "_n_words", "rejected_by")})
    judged = quality.judge(docs, quality.RULES)
    assert {c for c in judged.columns if c.lower() == "kept"} == {"kept"}
    assert all((r["data"], r["_data"], r["_n_words"]) == ("data", "_data", "_n_words") for r in judged.collect())
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    text = "the man and the dog went to that house with some of those people. " + " ".join(f"word{i}x of" for i in range(60))
    good = quality.keep_good(docs.withColumn("text", F.lit(text)))
    rows = good.collect()
    assert len(rows) == small.count() and all(r[c] == c for r in rows for c in ("data", "_data", "Kept", "n_words", "_n_words", "rejected_by"))
