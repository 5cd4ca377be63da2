"""Targets against a plain version, what is taken, and the rank order of Pareto sampling."""

from __future__ import annotations

import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from feedkit.llm import mixing
from feedkit.llm.queries import QUERIES
from feedkit.llm.text import count_words


def plain_targets(sizes):
    """sizes: source -> words. Shares by weight, cut at three times the size, the excess shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        target |= {s: 3.0 * sizes[s] for s in over}
        left -= sum(3.0 * sizes[s] for s in over)
        open_ -= over
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 1000, "c": 50, None: 3},
        {"a": 1, "b": 2, "c": 1000, "d": 0},
        {"x": 7},
        {None: 5, "é": 4, "Z": 3, "z": 2, "": 1},
        {f"s{i}": (i * 37) % 50 for i in range(40)},
        {"a": 0, "b": 0},
    ],
)
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_query(spark, sf_dir):
    rows = QUERIES["op4_mixing"](spark, sf_dir).collect()
    docs = {r[0]: (r[1], len((r[2] or "").encode().split())) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text").collect()}
    sizes, taken, targets, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in rows:
        source, size = docs[r["doc_id"]]
        assert r["size"] == size and 0 <= r["taken"] <= 3 * size and r["taken"] == r["copies"] * size
        sizes[source] += size
        taken[source] += r["taken"]
        targets[source] = r["target"]
        largest[source] = max(largest[source], size)
    assert len(rows) == len(docs) and targets == pytest.approx(plain_targets(sizes))
    for source in sizes:
        assert abs(taken[source] - targets[source]) <= largest[source]
    again = {r["doc_id"]: r["taken"] for r in QUERIES["op4_mixing"](spark, sf_dir).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_the_smallest_ranks_fill_a_hot_source(spark):
    """One source holds nearly all rows: the words taken come as near to the target as whole documents allow."""
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"),
        F.lit("t").alias("text"),
        F.when(F.col("id") % 50 == 0, "b").otherwise("a").alias("source"),
        (F.col("id") % 97).alias("words"),
    )
    rows = mixing.mix(docs, "words").groupBy("source").agg(F.sum("taken").alias("n"), F.max("target").alias("t")).collect()
    for r in rows:
        assert abs(r["n"] - r["t"]) <= 49


def test_claims_are_fair(spark):
    """Over many documents of one claim, the share that is taken once more does not depend on their size."""
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") < 20_000, "a").otherwise("b").alias("source"),
        F.when(F.col("id") % 2 == 0, 10).otherwise(1).alias("words"),
    )
    got = mixing.mix(docs, "words").filter("source = 'b'").groupBy("words").agg(F.avg("copies")).collect()
    low, high = sorted(r[1] for r in got)
    assert high - low < 0.05


def test_awkward_rows(spark, small):
    docs = small.withColumn("taken", F.lit("clash")).withColumn("w", count_words("text"))
    rows = mixing.mix(docs, "w").collect()
    assert len(rows) == small.count()
    assert all(r["copies"] == 0 for r in rows if r["w"] == 0)
    assert {r["target"] for r in rows if r["source"] is None} == {0.0}
    assert mixing.mix(docs.limit(0), "w").count() == 0


# --- against a plain sampler ------------------------------------------------------------------------------------------


def plain_claims(docs, target):
    """docs: (grade value, words). The level at which claims of at most three copies add up to the target."""
    wanted = [(q, n) for q, n in docs if q > 0 and n > 0]
    low, high = 0.0, 1e12
    for _ in range(400):
        middle = (low + high) / 2
        if sum(min(3.0, middle * q) * n for q, n in wanted) < target:
            low = middle
        else:
            high = middle
    return high


def test_documents_taken_equal_a_plain_pareto_sampler(spark):
    """Document by document: certain copies, then the smallest ratios of odds until the open words are filled."""
    rows = [(i, f"t{i}", "abc"[i % 3 if i % 7 else 0], (i * 37) % 50, float((i * 13) % 9)) for i in range(1_500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, words long, liking double")
    tie = F.xxhash64("doc_id", "text", "words", F.lit(mixing.SEED))
    us = {r[0]: r[1] for r in docs.select("doc_id", ((F.shiftrightunsigned(F.xxhash64(tie, F.lit(mixing.SEED)), 11) + 0.5) / float(1 << 53))).collect()}
    got = {r["doc_id"]: (r["copies"], r["target"]) for r in mixing.mix(docs, "words", preference="liking").collect()}
    for source in "abc":
        mine = [(i, n, 2.0 ** (math.floor(math.log2(q) * 16) / 16) if q > 0 else 0.0) for i, _, s, n, q in rows if s == source]
        target = got[mine[0][0]][1]
        level = plain_claims([(q, n) for _, n, q in mine], target)
        claim = {i: min(3.0, level * q) for i, _, q in mine}
        whole = {i: math.floor(c + 1e-7) for i, c in claim.items()}
        left = target - sum(whole[i] * n for i, n, _ in mine)
        part = {i: claim[i] - whole[i] for i in claim}
        ranked = sorted((us[i] / (1 - us[i]) / (part[i] / (1 - part[i])), i, n) for i, n, _ in mine if n > 0 and part[i] > 1e-6)
        more, words = set(), 0
        for _, i, n in ranked:
            if left - words < n / 2:
                break
            more.add(i)
            words += n
        want = {i: (whole[i] + (i in more)) if n else 0 for i, n, _ in mine}
        assert {i: got[i][0] for i in want} == want


def test_preferred_documents_are_taken_more_often(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") < 15_000, "a").otherwise("b").alias("source"),
        F.lit(10).alias("words"), F.when(F.col("id") % 2 == 0, 4.0).otherwise(1.0).alias("liking"),
    )
    rows = mixing.mix(docs, "words", preference="liking").filter("source = 'a'").groupBy("liking").agg(F.avg("copies"), F.max("target"))
    copies = {r[0]: r[1] for r in rows.collect()}
    assert copies[4.0] / copies[1.0] == pytest.approx(4.0, rel=0.1)


def test_repeated_rows_are_taken_one_by_one(spark):
    """1,000 equal rows of 2 words beside a source of its own: the target is met to half a row."""
    rows = [(1, "two words", "a", 2)] * 1_000 + [(2, "x", "b", 1_000), (3, "y", "b", 1_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, words long")
    got = mixing.mix(docs, "words").filter("source = 'a'").agg(F.sum("taken"), F.max("target"), F.count("*")).first()
    assert got[2] == 1_000 and abs(got[0] - got[1]) <= 1


def test_own_columns_keep_their_values(spark):
    names = "k u n g of_k of_g whole part open v edge fill tied of_e h place source_size"
    rows = [(i, f"t{i}", "ab"[i % 2], i, *["mine"] * len(names.split())) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, words long, " + ", ".join(f"{n} string" for n in names.split()))
    got = mixing.mix(docs, "words")
    assert got.columns == [c for c in docs.columns if c != "source_size"] + ["source_size", "target", "copies", "taken"]
    for r in got.collect():
        assert all(r[n] == "mine" for n in names.split() if n != "source_size")


def test_documents_without_a_preference_are_left_out(spark):
    rows = [(1, "a", "s", 5, None), (2, "b", "s", 5, 0.0), (3, "c", "s", 5, float("nan")), (4, "d", "s", 5, -1.0), (5, "e", "s", 5, 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, words long, liking double")
    assert {r["doc_id"]: r["copies"] for r in mixing.mix(docs, "words", preference="liking").collect()} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 3}
