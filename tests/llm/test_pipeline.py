"""Each stage against a plain version, on whole tables."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline as cp
from pyspark.sql import functions as F

from feedkit.llm import decontaminate as dc
from feedkit.llm import quality
from tests.llm.test_ngram_join import plain_components


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def test_stages_against_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    before = docs.collect()
    for name, stage in cp.STAGES[:3]:
        out = stage(spark, spark.createDataFrame(before, docs.schema), sf_dir)
        assert out.columns == columns
        if name == "quality_rules":
            texts = [(r, quality.Text((r["text"] or "").encode())) for r in before]
            want = [r for r, t in texts if not t.base_failed and not any(q.rejects(t) for q in quality.RULES)]
        elif name == "ngram_join":
            root = plain_components([(r["doc_id"], r["text"]) for r in before], cp.WORDS, cp.PERCENT)
            want = [r for r in before if root[r["doc_id"]] == r["doc_id"]]
        else:
            bench = [x["text"].encode() for x in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            windows = set()
            for item in map(dc.words, bench):
                k = min(10, len(item))
                windows |= {tuple(item[i : i + k]) for i in range(len(item) - k + 1) if k}

            def clean(text, windows=windows):
                words = dc.words((text or "").encode())
                return not any(tuple(words[i : i + k]) in windows for k in {len(w) for w in windows} for i in range(len(words) - k + 1))

            want = [r for r in before if clean(r["text"])]
        got = out.collect()
        assert Counter(map(tuple, got)) == Counter(map(tuple, want)) and len(got) < len(before) + 1
        before = got
    mixed = cp.source_mixing(spark, spark.createDataFrame(before, docs.schema), sf_dir)
    copies = Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == columns and set(copies) <= {r["doc_id"] for r in before} and max(copies.values()) <= 3
    out = cp.token_output(spark, mixed, sf_dir)
    assert Counter(r["doc_id"] for r in out.collect()) == copies


def test_run_gives_what_the_stages_give(spark, sf_dir):
    out = cp.run(spark, sf_dir).orderBy("start").collect()
    assert [r["start"] for r in out] == [sum(r["n_tokens"] for r in out[:i]) for i in range(len(out))]
    assert [r["doc_id"] for r in out] == sorted(r["doc_id"] for r in out)


def test_awkward_rows(spark, small, sf_dir):
    docs = small.withColumn("lang", F.lit("en")).withColumn("fp", F.lit(1))
    for _, stage in cp.STAGES[:4]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    kept = cp.near_duplicates(spark, docs, sf_dir).collect()
    assert sorted((r["doc_id"] for r in kept if r["doc_id"] is not None)) == [1, 2, 3, 4, 5, 8]
    assert sum(r["doc_id"] is None for r in kept) == 1
    twice = cp.near_duplicates(spark, docs.filter("doc_id = 6"), sf_dir)
    assert twice.count() == 1
    assert cp.token_output(spark, docs, sf_dir).count() == docs.count()
    assert cp.token_output(spark, docs.limit(0), sf_dir).count() == 0
