"""Links and components against brute force, the bounds of the sketches, and large groups."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedkit.llm import ngram_join as nj
from feedkit.llm.components import components


def plain_set(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def plain_components(rows, size, percent):
    """rows: (id, text). Smallest id that links lead to, per id."""
    sets = [(i, plain_set(t, size)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            common = len(a & b)
            if a and b and 100 * common >= percent * (len(a) + len(b) - common):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: find(i) for i, _ in sets}


def near_copies(seed, n):
    """Texts at all distances from each other, short and long ones, copies, chains of small changes."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    while len(texts) < n:
        words = rnd.choices(vocabulary, k=rnd.choice([1, 2, 3, 5, 8, 12, 20, 30, 60, 150, 400]))
        for _ in range(rnd.randint(1, 8)):
            texts.append(" ".join(words))
            if rnd.random() < 0.3:
                words = list(words)
            for _ in range(rnd.choice([0, 1, 1, 2, max(1, len(words) // 40)])):
                words = list(words)
                at = rnd.randrange(len(words))
                words[at : at + rnd.choice([0, 1, 1])] = [rnd.choice(vocabulary)]
    return [(i, t) for i, t in enumerate(texts[:n])]


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (1, 60)])
def test_components_equal_brute_force(spark, size, percent):
    rows = near_copies(size, 500)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: r["component_id"] for r in nj.near_duplicates(docs, size, percent).collect()}
    assert got == plain_components(rows, size, percent)


def test_sketch_keys_meet_for_every_pair_within_the_bound():
    rnd = np.random.default_rng(1)
    for percent in (60, 80, 90):
        bands = nj.Bands(percent)
        for n in (4, 9, 10, 19, 20, 35, 70, 200, 1000):
            for _ in range(20):
                base = rnd.integers(0, 1 << 62, 2 * n).astype(np.uint64)
                a = np.unique(base[:n])
                other = int(rnd.integers(0, max(1, nj.differences(n, n, percent)) + 1))
                b = np.unique(np.concatenate([a[other // 2 :], base[n : n + other - other // 2]]))
                common = len(np.intersect1d(a, b))
                if common < len(a) and 100 * common >= percent * (len(a) + len(b) - common):
                    (mine, lone), (others, alone) = nj.sketch_keys(a, bands), nj.sketch_keys(b, bands)
                    shared = set(mine) & set(others)
                    assert shared
                    some = {k for k, x in [*zip(mine, lone), *zip(others, alone)] if x}
                    assert len(shared) > 1 or shared & some
                    differ = np.bitwise_count(nj.signature(a) ^ nj.signature(b)).sum()
                    assert differ <= nj.differences(len(a), len(b), percent)


def test_a_large_group_of_near_copies(spark):
    """Hundreds of variants that differ from the first in a few places: all of one component or known to be apart."""
    rnd = random.Random(5)
    base = [f"t{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 400):
        words = list(base)
        for at in rnd.sample(range(150), rnd.choice([0, 1, 2, 3, 5])):
            words[at] = f"v{i}-{at}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in nj.near_duplicates(docs, 3, 90).collect()}
    assert got == plain_components(rows, 3, 90)


def test_awkward_rows(spark, small):
    docs = small.withColumn("component_id", F.lit("clash")).withColumn("fp", F.lit(1))
    rows = nj.near_duplicates(docs, 3, 90).collect()
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=str)
    n = dict((r["doc_id"], r["n_shingles"]) for r in rows)
    assert [g for g in got if g[0] in (2, 3, 4)] == [(2, 0, 2), (3, 0, 3), (4, 0, 4)]
    assert [g for g in got if g[0] in (1, 6)] == [(1, n[1], 1), (6, n[1], 1), (6, n[1], 1)]
    assert (None, n[None], None) in got and (5, 1, 5) in got
    assert nj.near_duplicates(docs.limit(0)).count() == 0


def test_rows_without_an_id_link_others(spark):
    """A bridge without an id between two texts that are too far from each other, a near copy without an id, copies of it."""
    base = [f"w{i}" for i in range(200)]
    near = [*base[:99], "x", *base[100:]]
    far = [*near[:49], "y", *near[50:]]
    rows = [(1, " ".join(base)), (None, " ".join(near)), (None, " ".join(near)), (2, " ".join(far)), (3, "alone in the world")]
    rows += [(None, "alone in the other world"), (None, "lonely words of nobody")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    percent = 96
    got = sorted(((r["doc_id"], r["component_id"]) for r in nj.near_duplicates(docs, 3, percent).collect()), key=str)
    sets = [plain_set(" ".join(x), 3) for x in (base, near, far)]

    def alike(a, b):
        return 100 * len(a & b) >= percent * len(a | b)

    assert alike(sets[0], sets[1]) and alike(sets[1], sets[2]) and not alike(sets[0], sets[2])
    assert got == sorted([(1, 1), (None, 1), (None, 1), (2, 1), (3, 3), (None, None), (None, None)], key=str)


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_a_passage_in_many_texts_that_are_otherwise_different(spark, size, percent):
    rnd = random.Random(11)
    passage = [f"p{i}" for i in range(120)]
    rows = []
    for i in range(400):
        own = [f"o{i}-{j}" for j in range(rnd.choice([20, 30, 120]))]
        rows.append((i, " ".join(own[: len(own) // 2] + passage + own[len(own) // 2 :])))
        if i % 50 == 0:
            rows.append((1_000 + i, rows[-1][1].replace("p60", "q60")))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in nj.near_duplicates(docs, size, percent).collect()}
    assert got == plain_components(rows, size, percent)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (500, 400)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)} | {400: 400, 500: 400}


def test_pairs_are_counted_before_their_signatures_are_fetched(spark, monkeypatch):
    """The shuffle that counts the pairs is swept before the joins of the pairs shuffle again."""
    events = []
    write, link = nj.Scratch.written, nj._could_link
    monkeypatch.setattr(nj.Scratch, "written", lambda self, df: events.append(df.columns) or write(self, df))
    monkeypatch.setattr(nj.Scratch, "sweep", lambda self: events.append("sweep"))
    monkeypatch.setattr(nj, "_could_link", lambda percent: events.append("link") or link(percent))
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join([*words, f"x{i}"])) for i in range(4)], "doc_id long, text string")
    got = {r["component_id"] for r in nj.near_duplicates(docs).collect()}
    at = events.index("link")
    assert got == {0} and events[at - 2 : at] == [["a", "b"], "sweep"]


def test_poor_words_have_no_keys():
    """So many of the words with the fewest bits are left out that partners still share two."""
    rnd, bands = np.random.default_rng(2), nj.Bands(80)
    hashes = np.unique(rnd.integers(0, 1 << 62, 600).astype(np.uint64))
    keys, lone = nj.sketch_keys(hashes, bands)
    assert len(keys) == sum(t + 2 for _, t, _ in bands.of(len(hashes))) and not lone.any()
    # Keys of the parts are those of the whole.
    assert len(np.unique(keys)) == len(keys)


def test_keys_and_pairs_go_in_parts(spark, monkeypatch):
    """Each part of the keys, and of the pairs, is written and its shuffle swept before the next one is shuffled."""
    events, goes = [], []
    write, key = nj.Scratch.written, nj.keyed
    monkeypatch.setattr(nj.Scratch, "written", lambda self, df: events.append(df.columns) or write(self, df))
    monkeypatch.setattr(nj.Scratch, "sweep", lambda self: events.append("sweep"))
    monkeypatch.setattr(nj, "keyed", lambda *args: goes.append(args[-2:]) or key(*args))
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join([*words, f"x{i}"])) for i in range(4)], "doc_id long, text string")
    whole = sorted(map(tuple, key(docs, 5, 80, "text").collect()))
    assert sorted(tuple(r) for go in range(3) for r in key(docs, 5, 80, "text", go, 3).collect()) == whole
    assert {r["component_id"] for r in nj.near_duplicates(docs).collect()} == {0}
    assert goes == [(go, nj.KEY_GOES) for go in range(nj.KEY_GOES)] and nj.KEY_GOES > 1
    at = events.index(["key", "fp", "low", "high", "f", "g"])
    parts = [["key", "fp", "low", "high", "f", "g"], "sweep"] * nj.KEY_GOES + [["a", "b"], "sweep"] * 2 * nj.PAIR_GOES
    assert events[at : at + len(parts)] == parts
