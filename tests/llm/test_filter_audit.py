"""The diagram against plain counting over permutations, masks of texts, and awkward rows."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from feedkit.llm import filter_audit as A


def plain_audit(counts, filters):
    n, total, found = len(filters), [0] * len(filters), {}
    for order in itertools.permutations(range(n)):
        alive = dict(counts)
        for step, i in enumerate(order, 1):
            gone = {m: w for m, w in alive.items() if m >> i & 1}
            alive = {m: w for m, w in alive.items() if not m >> i & 1}
            removed = sum(w[0] for w in gone.values())
            total[i] += removed
            fails = sum(w[0] for m, w in counts.items() if m >> i & 1)
            found["".join(filters[j] for j in order), step] = [
                sum(w[0] for w in alive.values()), removed, fails - removed, counts.get(1 << i, (0,))[0],
                sum(w[1] for w in gone.values()), sum(w[2] for w in gone.values()), i,
            ]
    return {k: (*v[:-1], total[v[-1]]) for k, v in found.items()}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
@pytest.mark.parametrize("seed", range(4))
def test_every_order(n, seed):
    r = random.Random(seed)
    counts = {m: (r.randrange(4), r.randrange(3), r.randrange(2)) for m in range(1 << n) if r.random() < 0.7}
    got = {(x[0], x[1]): x[2:] for x in A.audit_part(counts, "ABCDE"[:n])}
    assert got == plain_audit(counts, "ABCDE"[:n])


@pytest.mark.parametrize("n", range(1, 7))
def test_plain_changes_meet_every_order_once(n):
    order, seen = list(range(n)), {tuple(range(n))}
    for at in A.plain_changes(n):
        order[at], order[at + 1] = order[at + 1], order[at]
        assert tuple(order) not in seen
        seen.add(tuple(order))
    assert len(seen) == len(list(itertools.permutations(range(n))))


def test_diagram_shares_nodes():
    """Where every mask weighs the same, a level needs one node."""
    diagram = A.Diagram.of(dict.fromkeys(range(32), (1, 0, 0)), 5)
    assert [len(x) for x in diagram.children] == [1] * 5
    for at in A.plain_changes(5):
        diagram.swap(at)
        assert [len(x) for x in diagram.children] == [1] * 5


def test_masks():
    long = " ".join(f"w{i}" for i in range(100))
    assert A.text_mask(b"") == A.text_mask(b" \n\t") == 1
    assert A.text_mask(long.encode()) == 0
    assert A.text_mask(long.replace("w99", "w1").encode()) == 0
    assert A.text_mask(" ".join(f"w{i % 79}" for i in range(100)).encode()) == 2
    assert A.text_mask(b"AB" + "é".encode() * 18) == 1
    assert A.text_mask(b"ABC" + "é".encode() * 18) == 5
    assert A.text_mask(b"a|b") == 9
    assert A.text_mask(("a " * 1_000_000).encode()) == 2


def test_equal_texts_and_labels(spark):
    rows = [
        (5, "same", "de"), (3, "same", "en"), (3, "same", "en"), (9, "same", None), (None, "same", "en"),
        (1, None, "en"), (2, "", "en"), (7, "other", ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string").withColumns(
        {"mask": F.lit("x"), "digest": F.lit("y"), "part": F.lit("z"), "of": F.lit("w"), "id": F.lit("v")}
    )
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 1), (3, None, 1), (None, 1, 1), (9, 2, 0)], "doc_id long, quality int, toxic int")
    got = {(r["part"], r["mask"]): (r["n"], r["good"], r["toxic"]) for r in A.mask_counts(docs, labels, "lang").collect()}
    assert got == {
        ("de", 17): (1, 1, 1), ("en", 1): (4, 0, 2), ("", 17): (1, 0, 0), ("en", 17): (1, 0, 0), ("", 1): (1, 0, 0),
    }


def test_awkward_tables(spark, small):
    docs = small.withColumn("lang", F.col("source"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = A.filter_audit(docs, labels).collect()
    assert len(rows) == 4 * 600 and {r["part"] for r in rows} == {"a", "b", "é", ""}
    assert all(r["kept"] >= 0 and r["good_lost"] == r["toxic_lost"] == 0 for r in rows)
    # E takes one of two equal texts of different ids; a null text equals an empty one.
    assert {r["unique_fails"] + r["redundant"] + r["removed"] > 0 for r in rows if r["part"] == "a" and r["filter_order"][r["step"] - 1] == "E"} == {True}
    assert A.filter_audit(docs.limit(0), labels).count() == 0
