"""Positions, running values, spans, pairs, top rows, quantiles and literals."""

from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedkit.errors import TooFewRows
from feedkit.operators import literals, pairing, spans, topk
from feedkit.operators.aggregates import corr_pairs, date_range, distinct_per_group
from feedkit.operators.ordering import in_order, in_ranges, last_so_far, number_rows, rank_in_group


@pytest.fixture(scope="module")
def hot(spark):
    """One group holds most rows; order values are sparse and unsorted."""
    rng = random.Random(1)
    data = [("hot" if i % 10 else f"g{i % 70}", rng.randrange(10**6) * 1000 + i) for i in range(1000)]
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "g string, o long")


@pytest.mark.parametrize("parts", [1, 7, 40, None])
def test_rank_does_not_depend_on_chunks(hot, parts):
    data, df = hot
    expected = {}
    for g in {g for g, _ in data}:
        inside = sorted(o for h, o in data if h == g)
        expected.update({(g, o): (i + 1, len(inside), inside[0]) for i, o in enumerate(inside)})
    got = rank_in_group(df, ["g"], "o", "r", "n", {"first": "o"}, parts=parts).collect()
    assert {(r["g"], r["o"]): (r["r"], r["n"], r["first"]) for r in got} == expected


def test_no_task_gets_a_whole_group(hot):
    _, df = hot
    _, counts = in_order(df, ["g", "o"], "pos", parts=20)
    assert counts.agg(F.max("n")).first()[0] < df.filter("g = 'hot'").count() / 5


@pytest.mark.parametrize("far", [9 * 10**18, -9 * 10**18, 50_000])
def test_ranges_follow_the_rows(spark, far):
    """One far outlier makes no large chunk, chunk numbers grow with the order, and positions have no gap."""
    df = spark.range(50_000).union(spark.createDataFrame([(far,)], "id long"))
    sizes = in_ranges(df, ["id"], "c", "p", 50).groupBy("c").agg(
        F.count("id").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"), F.max("p").alias("last")
    )
    found = sizes.orderBy("c").collect()
    assert max(r["n"] for r in found) <= 3_000 and all(r["last"] == r["n"] - 1 for r in found)
    assert all(a["high"] < b["low"] for a, b in zip(found, found[1:], strict=False))
    placed, counts = in_order(df, [F.col("id").desc()], "id_pos", F.col("id") % 2 == 0, 50)
    assert counts.agg(F.sum("n"), F.sum("marked")).first() == (50_001, 25_001 if far % 2 == 0 else 25_000)
    pairs = placed.orderBy("id_pos").collect()
    assert [r["id_pos"] for r in pairs] == list(range(1, 50_002))
    assert [r["id"] for r in pairs] == sorted((r["id"] for r in pairs), reverse=True)


def test_few_rows_and_clashing_names(spark):
    for data in ([], [(5, 1), (-3, 2)]):
        df = spark.createDataFrame(data, "_chunk long, _at long")
        placed, _ = in_order(df, ["_chunk"], "_place")
        assert rows(placed, "_chunk", "_at", "_place") == [(a, b, i + 1) for i, (a, b) in enumerate(sorted(data))]
        assert rows(rank_in_group(df, ["_at"], "_chunk", "_pos"), "_chunk", "_pos") == [(a, 1) for a, _ in sorted(data)]


def test_null_keys_form_no_group(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "g string, o long")
    assert rows(rank_in_group(df, ["g"], "o"), "g", "o", "rank") == [("a", 2, 1)]


def test_positions_do_not_shuffle_the_rows_again(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = number_rows(spark.range(1000).withColumnRenamed("id", "k"), "k", "pos", F.lit(0), parts=4)
        plan = numbered._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert numbered.filter("pos <> k + 1").isEmpty() and numbered.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_number_rows_goes_on_from_start(spark):
    df = spark.createDataFrame([(30,), (10,), (20,)], "line long")
    assert rows(number_rows(df, "line", "id", F.lit(100), parts=2), "line", "id") == [(10, 101), (20, 102), (30, 103)]


@pytest.mark.parametrize("parts", [20, 8, 1, None])
def test_last_so_far(spark, parts):
    data = [("a", i, i if i % 7 == 0 else None) for i in range(40)]
    df = spark.createDataFrame(data, "g string, o long, v long")
    got = last_so_far(df, ["g"], "o", "v", "last", parts=parts)
    assert rows(got, "o", "last") == [(i, i // 7 * 7) for i in range(40)]


def replay(marks):
    """Spans and rejects of a list of (position, is_start), one mark after the other."""
    opened, out, rejects = [], {}, set()
    for at, start in marks:
        if start:
            out[at] = [len(opened) + 1, opened[-1] if opened else None, None]
            opened.append(at)
        elif opened:
            out[opened.pop()][2] = at
        else:
            rejects.add(at)
    return out, rejects


@pytest.mark.parametrize("parts", [12, 3, None])
def test_spans_equal_a_replay(spark, parts):
    rng = random.Random(7)
    runs = {run: [(i, rng.random() < 0.5) for i in range(60)] for run in range(4)}
    runs[9] = [(0, True), (1, True), (2, False), (3, False)]
    runs[10] = [(0, False), (1, True)]
    data = [(run, i, s) for run, marks in runs.items() for i, s in marks]
    df = spark.createDataFrame(data, "run int, at long, s boolean")
    depth = spans.span_depth(df, "run", "at", F.col("s"), parts=parts)
    got = spans.match_spans(df, "run", "at", "at", F.col("s"), F.lit(100).cast("long"), parts=parts)
    parents = spans.span_parents(df, "run", "at", F.col("s"), parts=parts)
    expected, expected_parents, rejected = [], [], []
    for run, marks in runs.items():
        out, rejects = replay(marks)
        uid = {at: i + 1 for i, at in enumerate(out)}
        rejected += [(run, at) for at in rejects]
        expected += [(run, at, d, end, float((100 if end is None else end) - at)) for at, (d, _, end) in out.items()]
        expected_parents += [(run, at, uid[at], d, uid.get(p)) for at, (d, p, _) in out.items()]
    assert rows(depth.filter("rejected"), "run", "at") == sorted(rejected)
    assert sorted(map(tuple, got.select("run", "at", "depth", "end_at", "seconds").collect())) == sorted(expected)
    assert {tuple(r) for r in parents.select("run", "at", "uid", "depth", "pid").collect()} == set(expected_parents)


def test_an_end_may_close_several_layers(spark):
    data = [("r", 1, True, 1), ("r", 2, True, 1), ("r", 5, False, 2), ("r", 6, True, 1)]
    df = spans.widen_ends(spark.createDataFrame(data, "run string, at long, s boolean, n int"), ["run"], "at", "n")
    got = spans.match_spans(df, "run", "mark_no", "at", F.col("s"), F.lit(9).cast("long"))
    assert rows(got, "mark_no", "depth", "end_at", "seconds") == [(1, 1, 5, 4.0), (2, 2, 5, 3.0), (5, 1, None, 3.0)]


def test_pairs(spark):
    data = [(1, 0, "A", "M", "C"), (1, 1, "B", None, "D"), (2, 2, "X", None, None), (2, 3, "Y", "N", "E")]
    df = spark.createDataFrame(data, "game int, ord int, team string, ref_main string, ref_crew1 string")
    swapped = pairing.swap_opponents(df, "game", "ord")
    assert rows(swapped, "team", "opp") == [("A", "B"), ("B", "A"), ("X", "Y"), ("Y", "X")]
    filled = pairing.fill_referees(df, "game", "ord")
    assert rows(filled, "ord", "ref_main", "ref_crew1", "ref_crew2") == [
        (0, "M", "C", "D"), (1, "M", "C", "D"), (2, None, None, "E"), (3, None, None, "E"),
    ]


def test_odd_number_of_rows_is_an_error(spark):
    df = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "line long, team string")
    paired = pairing.pair_by_position(df, "line")
    with pytest.raises(PySparkException, match="rows in pair are not 2"):
        pairing.swap_opponents(paired, "pair", "line").collect()


def test_top_rows_put_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 7), (4, 5)], "k int, v int")
    assert [r["k"] for r in topk.top_rows(df, "v", 3, "k").collect()] == [3, 2, 4]
    assert [r["k"] for r in topk.top_rows(df, "v", 9, "k").collect()] == [3, 2, 4, 1]
    with pytest.raises(ValueError):
        topk.top_rows(df, "v", -1, "k")


def test_top_pairs_modes(spark):
    df = spark.createDataFrame([("a", "b", 0.5), ("a", "c", -0.9), ("b", "c", None), ("b", "d", 0.7)], "col_a string, col_b string, corr double")
    values = {m: [r["corr"] for r in topk.top_pairs(df, 4, m).collect()] for m in ("pos", "neg", "abs")}
    assert values == {"pos": [0.7, 0.5, -0.9, None], "neg": [-0.9, 0.5, 0.7, None], "abs": [0.9, 0.7, 0.5, None]}


def test_corr_pairs_use_complete_rows(spark):
    data = [(1.0, 2.0, 1.0), (2.0, 4.0, 1.0), (3.0, None, 1.0), (4.0, 1.0, 1.0)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in corr_pairs(df, {c: F.col(c) for c in "abc"}).collect()}
    assert got["a", "b"] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4, 1])[0, 1])
    assert got["a", "c"] is None


def test_wide_correlations_equal_pairwise_ones(spark):
    """Nulls, constants, constants of the common rows, columns without a value, large values with a small spread."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(400, 9))
    table = [[None if rng.random() < 0.2 else float(x) for x in r] for r in base]
    for i, r in enumerate(table):
        r += [0.1, None, 1e9 + float(base[i][0]), 7.5 if i % 2 else float(i), None if i % 2 == 0 else float(i)]
    names = [f"c{i:02}" for i in range(14)]
    df = spark.createDataFrame(table, ", ".join(f"{n} double" for n in names)).repartition(3)
    plan = corr_pairs(df, {n: F.col(n) for n in names})
    assert "Generate" not in plan._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in plan.collect()}
    assert len(got) == 91
    for (a, b), value in got.items():
        pairs = [(r[int(a[1:])], r[int(b[1:])]) for r in table]
        x, y = np.array([p for p in pairs if None not in p]).reshape(-1, 2).T
        if len(x) == 0 or x.min() == x.max() or y.min() == y.max():
            assert value is None
        else:
            assert value == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-6)


def quantile_data(kind):
    rng = np.random.default_rng(3)
    if kind == "ties":
        return np.where(rng.random(5000) < 0.4, 7.0, rng.integers(0, 20, 5000).astype(float))
    if kind == "equal":
        return np.full(4000, 2.5)
    return rng.normal(size=5000) ** 3


@pytest.mark.parametrize("kind", ["normal", "ties", "equal"])
@pytest.mark.parametrize("gather", [10, 100_000])
def test_quantiles_are_exact(spark, kind, gather):
    values = quantile_data(kind)
    data = [(float(v),) for v in values] + [(None,), (float("nan"),)]
    df = spark.createDataFrame(data, "v double")
    probs = [0.0, 0.001, 0.05, 1 / 3, 0.5, 0.9, 0.9999, 1.0]
    got = topk.exact_quantiles(df, "v", probs, gather=gather, accuracy=50 if gather == 10 else 10_000)
    assert got == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)


def test_quantiles_of_nothing(spark):
    assert topk.exact_quantiles(spark.createDataFrame([(None,)], "v double"), "v", [0.5]) == [None]


def test_outliers_by_share_keep_the_bounds(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 12)] + [(99, None)], "k int, v double")
    assert rows(topk.remove_outliers(df, "v", "k", top=0.1, bottom=0.1), "k") == [(i,) for i in range(2, 11)]


def test_outliers_by_count(spark):
    equal = spark.createDataFrame([(i, 5.0) for i in range(4)], "k int, v double")
    assert rows(topk.remove_outliers(equal, "v", "k", top=1, bottom=1), "k") == [(2,), (3,)]
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None), (4, 9.0), (5, 9.0)], "k int, v double")
    assert rows(topk.remove_outliers(df, "v", "k", top=2, bottom=0.5), "k") == [(1,), (2,), (3,)]
    assert rows(topk.remove_outliers(df, "v", "k", top=1, bottom=1), "k") == [(2,), (3,), (5,)]
    with pytest.raises(TooFewRows):
        topk.remove_outliers(df, "v", "k", top=3, bottom=3)


def test_date_range_of_nothing(spark):
    assert tuple(date_range(spark.createDataFrame([], "d date"), "d").first()) == (0, None, None)


def test_distinct_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", None), ("b", None)], "g string, v int")
    assert rows(distinct_per_group(df, ["g"], ["v"])) == [("a", 2), ("b", 1)]


@pytest.mark.parametrize("part_size", [1, 2, 100])
def test_literals(spark, part_size):
    data = [("g", 3, "c", 30), ("g", 1, "a", 10), ("g", 2, "b", 20), ("h", 1, "3", 1), ("h", 2, "x", 2)]
    df = spark.createDataFrame(data, "g string, o long, s string, n int")

    def whole(pieces, *order):
        out = {}
        for r in pieces.orderBy("g", *order).collect():
            out[r["g"]] = out.get(r["g"], "") + r["text"]
        return out

    size = {"part_size": part_size, "parts": 5}
    # The first element decides about the quotes of all.
    assert whole(literals.list_literal(df, ["g"], "o", "s", **size), "part") == {"g": "['a', 'b', 'c']", "h": "[3, x]"}
    assert whole(literals.list_literal(df, ["g"], "o", "s", plain=True, **size), "part")["g"] == "[a, b, c]"
    assert whole(literals.dict_literal(df, ["g"], "o", "s", "n", **size), "part")["g"] == "{'a':10, 'b':20, 'c':30}"
    assert whole(literals.matrix_literal(df, ["g"], "o", ["s", "n"], **size), "part")["g"] == (
        "[['a', '10'], ['b', '20'], ['c', '30']]"
    )
    assert whole(literals.columns_literal(df, ["g"], "o", ["s", "n"], **size), "col_no", "part")["g"] == (
        "{'s':['a', 'b', 'c'], 'n':[10, 20, 30]}"
    )
    ids = literals.id_lists(df, ["g"], "o", **size).orderBy("g", "part").collect()
    assert [i for r in ids if r["g"] == "g" for i in r["ids"]] == [1, 2, 3]
    assert max(len(r["ids"]) for r in ids) <= part_size
