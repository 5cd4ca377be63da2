"""The classifier on held-out labels and the language model against what a distribution must satisfy."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedkit.llm import classifier
from feedkit.llm import pitman_yor as py
from feedkit.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def test_classifier_on_held_out_labels(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op8_quality_classifier"](spark, DATA).collect()}
    labels = spark.read.parquet(f"{DATA}/labels.parquet").collect()
    held = [r for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(rows[r["doc_id"]]["held_out"] for r in held)
    right = [rows[r["doc_id"]]["predicted"] == r["quality"] for r in held]
    assert len(rows) == 1000 and sum(right) >= 0.9 * len(right)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows.values())


def test_classifier_never_learns_held_out_labels(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    turned = labels.withColumn("quality", F.when(classifier.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = classifier.fit(docs, labels, rows=60), classifier.fit(docs, turned, rows=60)
    assert np.array_equal(one.weights, two.weights) and one.bias == two.bias


def test_classifier_awkward_rows(spark, small):
    labels = spark.createDataFrame([(1, 1), (6, 0), (6, 1), (2, None), (None, 1), (8, 0), (99, 1)], "doc_id long, quality int")
    model = classifier.fit(small, labels)
    clash = small.withColumns({c: F.lit(c) for c in ("Score", "data", "_data")})
    assert all((r["data"], r["_data"]) == ("data", "_data") for r in classifier.score(clash, model).collect())
    rows = classifier.score(small.withColumn("score", F.lit("clash")), model).collect()
    assert len(rows) == small.count() and all(0 <= r["score"] <= 1 for r in rows)
    empty = classifier.score(small, classifier.fit(small, labels.limit(0))).collect()
    assert {r["score"] for r in empty} == {0.5}
    assert classifier.score(small.limit(0), model).count() == 0


def plain_base(rows):
    """Base score, n_tokens, n_known by id."""
    tokens = {i: [*(t or "").encode().lower().split(), b""] for i, t in rows}
    train = Counter(w for i, x in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in x)
    n, v = sum(train.values()), len(train)
    return {
        i: (len(x), sum(train[w] > 0 for w in x), n, sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x))
        for i, x in tokens.items()
    }


def test_base_scores_and_held_out_texts(spark):
    texts = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    want = plain_base(texts)
    rows = QUERIES["op6_lm_score"](spark, DATA).collect()
    for r in rows:
        n, known, total, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1)
    # One word in six of these few texts is unknown. The base gives each unknown word what one of half a use would have,
    # without end; the model has to spell it. Where most words are known the model is ahead.
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 1000 and sum(r["score"] for r in held) / sum(r["n_tokens"] for r in held) > -4.4
    known = [r for r in held if r["n_known"] >= 0.85 * r["n_tokens"]]
    assert known and sum(r["score"] for r in known) > sum(r["base_score"] for r in known)


def test_grams_begin_anew_at_every_word():
    key, starts = py.grams([b"ab", b"", b"a"])
    symbols = key & 63
    assert starts.tolist() == [0, 3, 4] and symbols.tolist() == [2, 3, py.WORD_END, py.TEXT_END, 2, py.WORD_END]
    assert key[0] == key[4] == 2 and key[1] == (2 << 6 | 3)


def test_every_byte_has_its_own_spelling():
    spelled = {tuple(s[s != 255].tolist()) for s in py._SYMBOLS}
    assert len(spelled) == 256 and not any(s[0] == py.TEXT_END for s in spelled)


def test_spelling_model_is_a_distribution(monkeypatch):
    key, _ = py.grams([b"abc", b"abd", b"ba", b"x1", b""] * 30)
    keys, n = np.unique(key, return_counts=True)
    model = py.Model(keys, n)
    model.sweep()
    for level in model.levels:
        assert (level.t <= level.c).all() and ((level.t > 0) == (level.c > 0)).all()
    assert np.allclose(model.predictive(py.ORDER - 2).sum(axis=1), 1)
    table = 10.0 ** py.Model(keys, n).averaged().astype(float)
    assert np.allclose(table.reshape(-1, 64).sum(axis=1), 1, atol=1e-4)


def test_seats_follow_the_process():
    """Mean numbers of tables against a plain simulation of the Chinese restaurant process."""
    random = np.random.default_rng(3)
    for c, p in ((2, 0.3), (10, 0.05), (300, 0.02)):
        plain = []
        for _ in range(400):
            t = 1
            for i in range(1, c):
                new = (1 + 0.5 * (20 + t)) * p
                t += random.random() < new / (new + i - 0.5 * t)
            plain.append(t)
        ours = py.seat(np.full(4000, c), np.full(4000, p), np.full(4000, 20), 1.0, 0.5, random)
        assert ours.mean() == pytest.approx(np.mean(plain), rel=0.1)


def test_contexts_look_back_only():
    languages = np.array([0, 1, 0, 2, 2, 2, 0, 3, 0], np.int8)
    assert py.contexts(languages, np.array([7, 2])).tolist() == [0, 0, 1, 1, 1, 2, 2, 0, 3]


def test_small_chunks_and_partitions_give_the_same_counts(spark, small, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in small.select("doc_id", "text").collect() if r["doc_id"] is not None]
    monkeypatch.setattr(py, "PARTITION_DISHES", 3)
    docs = small.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).withColumn("score", F.lit("clash"))
    want = plain_base({i: t for i, t in rows}.items())
    got = py.score(docs.repartition(4)).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[r["doc_id"]][:3]
        assert r["base_score"] == pytest.approx(want[r["doc_id"]][3], rel=1e-9)


def test_language_model_awkward_rows(spark, small):
    got = py.score(small).collect()
    assert len(got) == small.count() and all(r["score"] < 0 for r in got)
    assert [r["n_tokens"] for r in got if r["doc_id"] in (2, 3, 4)] == [1, 1, 1]
    assert py.score(small.limit(0)).count() == 0


def test_word_contexts_make_a_distribution():
    """Probabilities of all words after each pair of words add up to one, whether the pair was seen or not."""
    random = np.random.default_rng(5)
    p = np.array([0.1, 0.2, 0.3, 0.4])
    # Dishes of two restaurants of one word, each with all four words, and of three restaurants of two words below each.
    pair = np.repeat(np.arange(8), 3)
    one, two = np.repeat([0, 1], 4), np.tile(np.arange(3), 8) + 3 * np.repeat([0, 1], 12)
    c = random.integers(0, 60, 24) * (two != 2)
    samples = list(py.seated_after_words(c, pair, two, one, np.tile(p, 2), random))
    assert len(samples) == py.SAMPLES
    for own, factor, tables in samples:
        assert np.allclose(np.bincount(two, weights=own + factor * np.tile(p, 2)[pair]), 1)
        assert (tables <= np.bincount(pair, weights=c)).all() and (tables > 0).all()


def test_word_order_counts(spark, monkeypatch):
    random = np.random.default_rng(7)
    nouns = [f"noun{i}" for i in range(30)]
    follows = {w: nouns[(7 * i + 1) % 30] for i, w in enumerate(nouns)}

    def chain():
        w = [nouns[random.integers(30)]]
        while len(w) < 40:
            w.append(follows[w[-1]] if random.random() < 0.9 else nouns[random.integers(30)])
        return w

    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 1]
    texts = {i: chain() for i in range(400)}
    for a, b in zip(held[::2], held[1::2], strict=False):
        texts[b] = [texts[a][k] for k in random.permutation(40)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    one = {r["doc_id"]: r for r in py.score(docs).collect()}
    for a, b in zip(held[::2], held[1::2], strict=False):
        assert one[a]["base_score"] == pytest.approx(one[b]["base_score"]) and one[a]["score"] > one[b]["score"] + 10
    # Each restaurant of words before is whole in its partition, so many of them change no more than the random seats.
    monkeypatch.setattr(py, "PARTITION_TOKENS", 1000)
    monkeypatch.setattr(py, "CHUNK_TOKENS", 3000)
    many = {r["doc_id"]: r for r in py.score(docs.repartition(3)).collect()}
    assert sum(r["score"] for r in many.values()) == pytest.approx(sum(r["score"] for r in one.values()), rel=0.01)


def test_pairs_of_small_numbers_have_hashes_of_their_own():
    a, b = np.meshgrid(np.arange(200_000, dtype=np.uint64), np.arange(5, dtype=np.uint8))
    assert len(np.unique(py._mixed(a.reshape(-1), b.reshape(-1)))) == a.size


def test_steps_between_samples_come_back():
    samples = list(np.random.default_rng(3).integers(0, 9, (py.SAMPLES, 50)))
    steps = np.stack(py._steps(samples)).astype("<u4")
    assert all(np.array_equal(py._from_steps(steps, i), x) for i, x in enumerate(samples))


def test_answers_to_tokens_take_a_few_bytes(spark, tmp_path, monkeypatch):
    """What is sent to a chunk about its tokens' contexts and what it stores are small against the text."""
    monkeypatch.setattr("feedkit.session.shared_dir", lambda _: str(tmp_path))
    tokens = sum(r["n_tokens"] for r in py.score(spark.read.parquet(f"{DATA}/documents.parquet")).collect())
    left = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet") if "pitman-yor" not in str(f))
    assert 0 < left < 9 * tokens
