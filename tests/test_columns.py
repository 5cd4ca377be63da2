"""Filters, casts, scalars and arrays on rows that the given tables do not have: nulls, ties, odd text."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedkit import functions as K
from feedkit.operators import filters


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame([(1, "x"), (2, "y"), (None, "x"), (5, None)], "a int, b string")


def one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v")).alias("r")).first()[0]


def test_criteria_nulls(small):
    assert rows(filters.filter_criteria(small, {"a": [1, None], "b": ["x"]})) == [(None, "x"), (1, "x")]


def test_criteria_empty_and_unknown(small):
    assert filters.filter_criteria(small, {}).count() == 4
    assert filters.filter_criteria(small, {"zz": [1]}).count() == 0
    assert filters.filter_criteria(small, {"a": []}).count() == 0


def test_single_match(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3), (3, None, 4)], "k int, v string, n int")
    assert rows(filters.single_match(df, ["k"])) == [(2, "c", 3), (3, None, 4)]
    assert rows(filters.repeated_matches(df, ["k"])) == [(1, 2)]


def test_missing_link(spark):
    df = spark.createDataFrame([(1, None, 2018), (2, 7, 2018), (3, None, 2017)], "id int, tsid int, season int")
    assert rows(filters.missing_link(df, "tsid", "season", 2018), "id") == [(1,)]


def test_watermark_bounds(spark):
    df = spark.createDataFrame([(i,) for i in range(5)], "d int")
    assert rows(df.filter(filters.between_marks("d", F.lit(1), F.lit(3)))) == [(2,), (3,)]


def test_complete_rows(small):
    assert rows(filters.complete_rows(small, ["a", "b"])) == [(1, "x"), (2, "y")]
    assert filters.complete_rows(small, ["a"]).count() == 3


def test_casts(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("2.5",)], "c string")
    lenient = filters.cast_columns(df, {"c": "int"})
    assert rows(lenient, "c", "c_raw") == [(None, None), (None, "2.5"), (None, "x"), (1, "1")]
    assert rows(filters.cast_failures(lenient, ["c"])) == [("c", 2)]
    with pytest.raises(PySparkException):
        filters.cast_columns(df, {"c": "int"}, strict=True).collect()


def test_explode_examples(spark):
    df = spark.createDataFrame([(4, 10, ["A", "B"]), (5, 11, []), (6, 12, None)], "id int, x1 int, x2 array<string>")
    assert rows(filters.explode_sequence(df, "x2")) == [(4, 10, "A"), (4, 10, "B")]


def test_flatten_example(spark):
    value = one(spark, [["A", "B", "C"], ["D", "E"]], "array<array<string>>", K.flatten_once)
    assert value == ["A", "B", "C", "D", "E"]


@pytest.mark.parametrize(
    ("a", "b", "order", "equal"),
    [([1, 1, 2], [1, 2, 2], False, False), ([2, 1], [1, 2], False, True), ([2, 1], [1, 2], True, False), ([], [], True, True)],
)
def test_sequences_equal(spark, a, b, order, equal):
    df = spark.createDataFrame([(a, b)], "a array<int>, b array<int>")
    assert df.select(K.sequences_equal(F.col("a"), F.col("b"), order)).first()[0] is equal


def test_arrays(spark):
    df = spark.createDataFrame([([1, 2, 2, 3], [2, 3], [])], "a array<int>, b array<int>, e array<int>")
    a, b, e = (F.col(c) for c in "abe")
    got = df.select(K.common_elements(a, b), K.contains_all(a, b), K.contains_all(b, a), K.contains_all(a, e)).first()
    assert (sorted(got[0]), *got[1:]) == ([2, 3], True, False, True)
    got = df.select(K.all_equal(a), K.all_equal(e), K.all_equal(F.array(F.lit(1), F.lit(1)))).first()
    assert tuple(got) == (False, None, True)


def test_common_across(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("b", 2), ("c", 2), ("c", 1)], "g string, e int")
    assert rows(filters.common_across(df, "g", "e", ["a", "b", "c"])) == [(2,)]


def test_maps(spark):
    df = spark.createDataFrame([({"a": 1, "b": 2}, {"b": 2, "a": 1}, {"a": 1})], "m map<string,int>, n map<string,int>, o map<string,int>")
    assert tuple(df.select(K.maps_equal(F.col("m"), F.col("n")), K.maps_equal(F.col("m"), F.col("o"))).first()) == (True, False)


@pytest.mark.parametrize(
    ("text", "clean"),
    [
        ("a&nbsp;\n\n b", "a b"),
        ("a é b", "a  b"),
        ("\t x \x1f", "x"),
        ("é a", "a"),
        ("a\n \n  \nb  c d", "a b c d"),
        ("", ""),
        ("\n", ""),
        ("a\tb", "a\tb"),
        ("ünï\ncode  ✓ end\r\n", "n code  end"),
    ],
)
def test_clean_html(spark, text, clean):
    assert one(spark, text, "string", K.clean_html) == clean


@pytest.mark.parametrize(("minutes", "periods"), [(240, 0), (265, 1), (290, 2), (230, 0), (200, -1), (264, 0)])
def test_overtime(spark, minutes, periods):
    assert one(spark, minutes, "int", K.overtime_periods) == periods


def test_game_id_is_the_same_from_both_sides(spark):
    day = dt.datetime(2017, 10, 18)
    df = spark.createDataFrame(
        [(day, "CLE", "BOS", True), (day, "BOS", "CLE", False), (day, None, "CLE", True), (day, "A", "B", None)],
        "gd timestamp_ntz, own string, opp string, home boolean",
    )
    got = df.select(K.game_id(F.col("gd"), F.col("own"), F.col("opp"), F.col("home"))).collect()
    assert [r[0] for r in got] == ["171018_CLE_BOS", "171018_CLE_BOS", None, None]


@pytest.mark.parametrize(
    ("text", "number"),
    [("jan", 1), ("Sept", 9), ("sept", 9), ("September", 9), ("MAY", None), ("may", 5), ("December", 12), ("x", None)],
)
def test_month_number(spark, text, number):
    assert one(spark, text, "string", K.month_number) == number


def test_nan_becomes_null(spark):
    assert one(spark, float("nan"), "double", K.norm_nan) is None
    assert one(spark, 1.5, "double", K.norm_nan) == 1.5


def test_dates(spark):
    assert one(spark, "10/18/2017", "string", lambda c: K.parse_date(c, "MM/dd/yyyy")) == dt.datetime(2017, 10, 18)
    assert one(spark, "soon", "string", lambda c: K.parse_date(c, "MM/dd/yyyy")) is None
    day = dt.datetime(2017, 10, 18, 1, 2, 3)
    assert one(spark, day, "timestamp_ntz", K.format_date_sql) == "2017-10-18 01:02:03"
    assert one(spark, day, "timestamp_ntz", lambda c: K.format_date_sql(c, "#")) == "#2017-10-18 01:02:03#"


def test_text_helpers(spark):
    assert one(spark, "O'Neal's", "string", K.escape_quotes) == "O''Neal''s"
    assert one(spark, "2017 Regular Season", "string", lambda c: K.lacks_text(c, "Regular Season")) is False
    assert one(spark, "HOME", "string", lambda c: K.venue_is(c, "home", ignore_case=True)) is True
    assert one(spark, "h", "string", lambda c: K.venue_is(c, "H")) is False
    assert [one(spark, t, "string", K.is_number) for t in ("3", "x", "", "1e5", None)] == [True, False, False, True, False]
    assert [one(spark, t, "string", K.is_number) for t in ("12d", "3f", "nan", " -4.5 ", ".5", "1.")] == [False] * 3 + [True] * 3


def test_weighted_score(spark):
    df = spark.createDataFrame([(10, 5, 4, 1, 2, 3)], "pts int, treb int, ast int, blk int, stl int, tov int")
    got = df.select(K.weighted_score({c: F.col(c) for c in df.columns})).first()[0]
    assert got == pytest.approx(10 + 6 + 6 + 3 + 6 - 3)
