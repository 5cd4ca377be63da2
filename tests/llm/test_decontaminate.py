"""Suffix arrays, matches and hits against brute force."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedkit.llm import decontaminate as dc


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_is_sorted(seed):
    rnd = np.random.default_rng(seed)
    text = np.append(rnd.integers(0, rnd.choice([2, 3, 40]), 300), [0, 0]).astype(np.int32)
    depth = 16
    array = dc.suffix_array(text, depth)

    def suffix(i):
        out = []
        for x in text[i : i + depth].tolist():
            if x == 0:
                break
            out.append(x)
        return out

    found = [suffix(i) for i in array.tolist()]
    assert found == sorted(found) and sorted(array.tolist()) == np.flatnonzero(text).tolist()


def plain_hits(doc, items, window):
    words, hit, names = dc.words(doc), set(), set()
    for name, item in items:
        w = dc.words(item)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            for p in range(len(words) - k + 1):
                if words[p : p + k] == w[i : i + k]:
                    hit |= set(range(p, p + k))
                    names.add(name)
    return len(words), len(hit), sorted(names)


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [(str(i), " ".join(rnd.choices(vocabulary, k=rnd.choice([1, 3, 4, 7, 15, 30])))) for i in range(12)]
    docs = []
    for i in range(60):
        words = rnd.choices([*vocabulary, "x", "y"], k=rnd.randint(0, 40))
        for _ in range(rnd.randint(0, 3)):
            part = rnd.choice(items)[1].split()
            a = rnd.randrange(len(part))
            words[rnd.randint(0, len(words)) : 0] = part[a : a + rnd.randint(1, 12)]
        docs.append((i, ", ".join(words).title()))
    return docs, items


@pytest.mark.parametrize(("seed", "block"), [(1, 1 << 20), (2, 60)])
def test_hits_and_matches(spark, seed, block):
    docs, items = corpus(seed)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id string, text string")
    for r in dc.mark_contaminated(frame, bench, window=4, block_bytes=block).collect():
        want = plain_hits(docs[r["doc_id"]][1].encode(), [(i, t.encode()) for i, t in items], 4)
        assert (r["n_words"], r["n_hit"], r["items"]) == want
        words = dc.words(docs[r["doc_id"]][1].encode())
        for m in r["matches"]:
            item = dc.words(dict(items)[m["item_id"]].encode())
            assert words[m["doc_word"] :][: m["n_words"]] == item[m["item_word"] :][: m["n_words"]]


def test_awkward_rows(spark, small):
    bench = [(1, None), (2, ""), (3, "one"), (None, "lazy dog the quick"), (4, "lazy dog the quick"), (4, "fox"), (5, "no id")]
    bench = spark.createDataFrame(bench, "item_id long, text string")
    docs = small.withColumn("items", F.lit("clash")).withColumn("item_id", F.lit(0))
    rows = dc.mark_contaminated(docs, bench).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["items"]) for r in rows), key=str)
    assert [g for g in got if g[0] in (2, 3, 5)] == [(2, 0, []), (3, 0, []), (5, 1, ["3"])]
    assert [g for g in got if g[0] in (1, 6)] == [(1, 108, ["4"]), (6, 108, ["4"]), (6, 108, ["4"])]
    assert [g[2] for g in got if g[0] is None] == [["5"]]
    assert all(r["n_hit"] == 0 for r in dc.mark_contaminated(docs, bench.limit(0)).collect())
    assert dc.mark_contaminated(docs.limit(0), bench).count() == 0


def test_items_without_id_are_hit_but_have_no_name(spark):
    bench = [(None, "one two three four"), (None, "seven eight nine ten"), ("a", "one two three four"), ("b", "five six")]
    bench = spark.createDataFrame(bench, "item_id string, text string")
    docs = [(1, "x one two three four y"), (2, "seven eight nine ten"), (3, "five six seven eight nine ten one two three four"), (4, "six five")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["n_items"], r["items"]) for r in dc.mark_contaminated(docs, bench).collect()}
    assert got == {1: (4, 2, ["a"]), 2: (4, 1, []), 3: (10, 3, ["a", "b"]), 4: (0, 0, [])}


def test_repeated_words_take_memory_in_proportion():
    items = dc.Items([("a", b"w " * 1_000), ("b", b"w " * 5), ("c", b"v " * 30)], 10)
    shard = [[items.number[b"w"]] * 200_000, [0] * 10, [items.number[b"w"]] * 7, [items.number[b"v"]] * 9]
    tracemalloc.start()
    found, _ = dc._shard_matches(shard, items)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {r: (int(h.sum()), n) for r, (h, n) in found.items()} == {0: (200_000, [0, 1]), 2: (7, [1])}
    # Listing every place of every suffix would take 200,000 x 991 numbers.
    assert peak < 200_000 * 8 * 40


def test_many_pairs_are_made_distinct_in_parts(monkeypatch):
    docs, items = corpus(7)
    named = [(i, t.encode()) for i, t in items]
    held = dc.Items(named, 4)
    shard = [[held.number.get(w, 0) for w in dc.words(t.encode())] for _, t in docs]
    whole = dc._shard_matches(shard, held)[0]
    monkeypatch.setattr(dc, "PAIRS", 5)
    parts = dc._shard_matches(shard, held)[0]
    assert {r: n for r, (_, n) in parts.items()} == {r: n for r, (_, n) in whole.items()}
    for r, (_, text) in enumerate(docs):
        _, n_hit, names = plain_hits(text.encode(), named, 4)
        hit, numbers = whole.get(r, (np.zeros(0, bool), []))
        assert (int(hit.sum()), sorted(held.ids[x] for x in numbers)) == (n_hit, names)


def test_own_columns_are_kept(spark):
    docs = spark.createDataFrame([(1, "one two", "i", "d"), (2, "six", "j", "e")], "doc_id long, text string, items string, data string")
    bench = spark.createDataFrame([("a", "one two")], "item_id string, text string")
    assert [tuple(r) for r in dc.keep_clean(docs, bench).collect()] == [(2, "six", "j", "e")]
    marked = {r["doc_id"]: (r["data"], r["items"]) for r in dc.mark_contaminated(docs, bench).collect()}
    assert marked == {1: ("d", ["a"]), 2: ("e", [])}
