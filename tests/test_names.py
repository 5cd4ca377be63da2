"""Name lists, parsing, the resolving steps, and edit-distance joins against brute force."""

from __future__ import annotations

import itertools
import random
import string

import pytest
from conftest import rows
from pyspark.sql import functions as F

from feedkit.errors import UnhandledName
from feedkit.operators import joins, names, similarity
from feedkit.operators.similarity import nearest_names, similar_pairs
from feedkit.operators.topk import rank_by_distance
from feedkit.sources import active_team_names, lookup_pairs, name_pairs


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.fixture(scope="module")
def lists(spark):
    conversions = spark.createDataFrame([("Nene H", "Nene"), ("Both", "Other")], "old_name string, new_name string")
    missing = spark.createDataFrame([("Gone",)], "name string")
    known = spark.createDataFrame([("Kobe",), ("Both",)], "name string")
    return conversions, missing, known


def test_last_listing_wins(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "z", 3), (None, "q", 4)], "o string, n string, k int")
    assert rows(lookup_pairs(df, "o", "n", "k")) == [("a", "y"), ("b", "z")]


def test_resolution_and_messages(spark, lists):
    df = spark.createDataFrame([(n,) for n in ("Nene H", "Gone", "Kobe", "Who", "Both")], "name string")
    got = {r["name"]: (r["clean"], r["status"]) for r in joins.resolve_names(df, "name", *lists).collect()}
    assert got == {
        "Nene H": ("Nene", "converted"),
        "Both": ("Other", "converted"),
        "Gone": ("Gone", "known missing"),
        "Kobe": ("Kobe", "known"),
        "Who": (None, "unhandled"),
    }
    got = {r["name"]: (r["problematic"], r["info"]) for r in joins.name_status(df, "name", *lists).collect()}
    assert got == {
        "Nene H": (True, "Should be Nene."),
        "Both": (True, "Should be Other."),
        "Gone": (False, "Known to be missing from PStats."),
        "Kobe": (False, "In PStats."),
        "Who": (True, "Not in PStats, no associated name, and not known to be missing."),
    }
    assert rows(joins.keep_unhandled(df, "name", lists[0])) == [("Gone",), ("Kobe",), ("Nene",), ("Other",), ("Who",)]
    assert rows(joins.unhandled_names(df.union(df), "name", *lists)) == [("Who",)]


def test_unmapped_codes_are_reported(spark):
    df = spark.createDataFrame([("BOS",), ("XXX",), (None,)], "team string")
    lookup = spark.createDataFrame([("BOS", "Boston")], "old_name string, new_name string")
    assert rows(joins.map_values(df, "team", lookup)) == [(None,), (None,), ("Boston",)]
    assert rows(joins.unmapped(df, "team", lookup), "reason") == [("team not in lookup: XXX",), ("team not in lookup: null",)]


def test_team_names(spark):
    df = spark.createDataFrame([("BOS", "Boston", True), ("SEA", "Seattle", False)], "code string, full string, active boolean")
    assert rows(active_team_names(df, F.col("active"), ["code", "full"])) == [("BOS",), ("Boston",)]


@pytest.mark.parametrize(
    ("name", "parts"),
    [
        ("Tim Hardaway, Jr.", ("Tim", "Hardaway", "Jr.")),
        ("Tim Hardaway Sr", ("Tim", "Hardaway", "Sr")),
        ("Juan Carlos Navarro", ("Juan Carlos", "Navarro", None)),
        ("  James Ennis III ", ("James", "Ennis", "III")),
        ("Robert Griffin IV", ("Robert", "Griffin", "IV")),
    ],
)
def test_parse(spark, name, parts):
    df = spark.createDataFrame([(name,), ("Nene",)], "name string")
    assert rows(names.parse_names(df, "name"), "first", "last", "suffix") == [parts]


STEPS = [
    ("LeBron James", "LeBron James", 0),
    ("CJ McCollum", "C.J. McCollum", 1),
    ("T.J. Warren", "TJ Warren", 2),
    ("Tim Hardaway Jr.", "Tim Hardaway", 3),
    ("De'Aaron Fox", "DeAaron Fox", 4),
    ("Shaq O'Neal", "Shaq ONeal", 5),
    ("Karl Towns-Smith", "Karl Smith", 6),
    ("Lou Williams", "Louis Williams", 7),
    # A value that is only a nickname leads to its names, in their order; the first known spelling wins.
    ("Maxi Kleber", "Maximilian Kleber", 7),
]
MISSES = [
    # Terminal steps: the alias would lead to a known name, but initials and suffixes settle the matter.
    ("Lou Williams III", "missing"),
    ("LJ Zeta", "missing"),
    ("Nobody Here", "missing"),
    ("Nene", "unparsed"),
]


def test_resolving_steps(spark):
    known = [best for _, best, _ in STEPS] + ["Louis Williams", "Maxim Kleber"]
    universe = spark.createDataFrame([(n,) for n in known], "name string")
    nicknames = spark.createDataFrame(
        [("Louis", "Lou", 1), ("LJ", "Larry", 2), ("Maximilian", "Maxi", 3), ("Maxim", "Maxi", 4)],
        "name string, nickname string, ord long",
    )
    inputs = spark.createDataFrame([(n,) for n, *_ in STEPS + MISSES], "name string")
    got = {r["name"]: r for r in names.resolve_best_names(inputs, "name", universe, nicknames).collect()}
    assert {n: (got[n]["best"], got[n]["step"], got[n]["status"]) for n, *_ in STEPS} == {
        n: (best, step, "found") for n, best, step in STEPS
    }
    assert {n: got[n]["status"] for n, _ in MISSES} == dict(MISSES)
    assert {r["best"] for r in got.values()} - {None} <= set(known)


def test_name_side_of_the_aliases_wins(spark):
    nicknames = spark.createDataFrame([("Al", "Bo", 1), ("Bo", "Cy", 2), ("Dee", "Bo", 3)], "name string, nickname string, ord int")
    df = spark.createDataFrame([("Al",), ("Bo",), ("Cy",), ("Zed",)], "v string")
    assert rows(joins.aliases_of(df, "v", nicknames), "v", "alias") == [("Al", "Bo"), ("Bo", "Cy"), ("Cy", "Bo"), ("Zed", None)]
    assert rows(joins.has_alias(df, "v", nicknames)) == [("Al",), ("Bo",), ("Cy",)]


def test_abbreviations(spark):
    universe = spark.createDataFrame([("Carl Anvil", 2), ("Cold Anvil", 1), ("Bob Rod", 3), ("Nene", 4)], "name string, ord int")
    df = spark.createDataFrame([("C. Anvil",), ("C. Anvill",), ("N. Nene",)], "abbrev string")
    got = {r["abbrev"]: (r["full_name"], r["by_distance"]) for r in names.resolve_abbrevs(df, "abbrev", universe).collect()}
    assert got == {"C. Anvil": ("Cold Anvil", False), "C. Anvill": ("Cold Anvil", True), "N. Nene": ("Nene", True)}


def random_names(n, seed, low, high, letters="abcd "):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        text = "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))
        out.add(text)
        chars = list(text)
        for _ in range(rng.randint(0, 3)):
            chars[rng.randrange(len(chars))] = rng.choice(letters)
        out.add("".join(chars))
    return sorted(out)[:n]


@pytest.mark.parametrize(
    ("texts", "limit", "variant_length"),
    [
        (random_names(150, 1, 1, 9), 4, 32),
        (["John " + n for n in random_names(120, 2, 4, 8, string.ascii_lowercase[:6])], 4, 32),
        # The same names on the path for long strings, and astride the border between both.
        (["Johnathan Fitzgerald " + n for n in random_names(120, 3, 4, 10)], 4, 14),
        (random_names(120, 4, 14, 26), 4, 20),
        (random_names(100, 5, 1, 6), 2, 32),
    ],
)
def test_similar_pairs_equal_brute_force(spark, texts, limit, variant_length):
    df = spark.createDataFrame(list(enumerate(texts)), "ord long, name string")
    got = similar_pairs(df, "name", "ord", limit, variant_length)
    expected = [
        (a, b, d) for i, a in enumerate(texts) for b in texts[i + 1 :] if (d := distance(a, b)) < limit
    ]
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert expected


def test_known_pairs_are_left_out_in_either_order(spark):
    known = name_pairs(spark.createDataFrame([("b", "a")], "x string, y string"), "x", "y")
    pairs = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "c")], "n1 string, n2 string")
    assert rows(joins.without_known_pairs(pairs, "n1", "n2", known)) == [("a", "c")]


def test_nearest_equals_brute_force(spark):
    people = random_names(80, 6, 1, 14, string.ascii_lowercase[:9] + " ")
    values = random_names(40, 7, 1, 20, string.ascii_lowercase[4:14]) + ["zzz", "z" * 30, "", "a"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    universe = spark.createDataFrame(list(enumerate(people)), "ord long, name string")
    got = {r["v"]: (r["dist"], r["name"]) for r in nearest_names(df, "v", universe).collect()}
    expected = {}
    for v in values:
        d, ord_ = min((distance(v, p), i) for i, p in enumerate(people))
        expected[v] = (d, people[ord_])
    assert got == expected


def test_nearest_of_nothing(spark):
    none = spark.createDataFrame([], "v string")
    universe = spark.createDataFrame([(1, "a")], "ord long, name string")
    assert nearest_names(none, "v", universe).collect() == []


def test_rank_by_distance(spark):
    df = spark.createDataFrame([("abd", 1), ("abc", 2), ("xyz", 3), ("abe", 4)], "n string, o int")
    assert [r["n"] for r in rank_by_distance(df, "n", "abc", "o").collect()] == ["abc", "abd", "abe", "xyz"]


def test_similar_pairs_beyond_the_variants(spark):
    """Long strings at a large distance, short ones that share nothing, and both together."""
    a = "the quick brown fox jumps over it"
    texts = [a, a[:20] + "XXXXXXXXXXX" + a[31:], "abcdef", "aXcdYf", "uvw", "", "abc", "abcdefghijklmnop", a.upper()]
    for limit in (5, 12):
        df = spark.createDataFrame([(t, i) for i, t in enumerate(texts) if t], "name string, ord int")
        got = {(r["name1"], r["name2"]): r["dist"] for r in similar_pairs(df, "name", "ord", limit).collect()}
        want = {(s, t): distance(s, t) for i, s in enumerate(texts) for t in texts[i + 1 :] if s and t}
        assert got == {p: d for p, d in want.items() if d < limit}
    with pytest.raises(ValueError):
        similar_pairs(df, "name", "ord", 4, 5)


def test_templates_with_a_varying_number(spark):
    texts = [f"item number {i:06d} of the catalogue" for i in range(0, 3000, 13)]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "name string, ord int")
    want = {(s, t) for i, s in enumerate(texts) for t in texts[i + 1 :] if sum(x != y for x, y in zip(s, t, strict=True)) < 2}
    got = {(r["name1"], r["name2"]) for r in similar_pairs(df, "name", "ord", 2).collect()}
    assert got == {p for p in want if distance(*p) < 2}


def test_unicode_white_space_in_names(spark):
    df = spark.createDataFrame([("\u00a0Tim\u00a0Hardaway",)], "full_name string")
    assert rows(names.parse_names(df, "full_name"), "full_name", "first", "last") == [("Tim\u00a0Hardaway", "Tim", "Hardaway")]


def test_strict_resolution_stops_at_an_unhandled_name(spark):
    lists = (
        spark.createDataFrame([("Bob", "Robert")], "old_name string, new_name string"),
        spark.createDataFrame([("Gone",)], "name string"),
        spark.createDataFrame([("Known",)], "name string"),
    )
    good = spark.createDataFrame([("Bob",), ("Gone",), ("Known",)], "n string")
    assert joins.resolve_names(good, "n", *lists, strict=True).count() == 3
    with pytest.raises(UnhandledName, match="Nobody"):
        joins.resolve_names(good.union(spark.createDataFrame([("Nobody",)], "n string")), "n", *lists, strict=True)


@pytest.mark.parametrize("block", [50, 2048])
def test_large_blocks_of_one_template(spark, monkeypatch, block):
    """3,000 names of one template, with one varying part, two far apart, and some long ones: whole, and far from all pairs."""
    rng = random.Random(8)
    own = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    texts = {f"the account of {own(6)} with the wholesale house" for _ in range(3000)}
    texts |= {f"{own(4)} is the one that pays for the wholesale house of {own(4)}" for _ in range(600)}
    texts |= {t.replace("wholesale", "wholesome") for t in sorted(texts)[:20]}
    df = spark.createDataFrame(list(enumerate(sorted(texts))), "ord long, name string")
    seen = []
    monkeypatch.setattr(similarity, "BLOCK", block)
    within = similarity._within
    monkeypatch.setattr(similarity, "_within", lambda found, k: (seen.append(found), within(found, k))[1])
    got = similar_pairs(df, "name", "ord", 3).collect()
    a, b = (df.select(F.col("name").alias(f"name{i}"), F.col("ord").alias(f"o{i}")) for i in (1, 2))
    pairs = a.crossJoin(b).filter("o1 < o2").withColumn("dist", F.levenshtein("name1", "name2", 2)).filter("dist >= 0")
    assert sorted(map(tuple, got)) == sorted(map(tuple, pairs.select("name1", "name2", "dist").collect()))
    assert len(got) > 20
    assert seen[0].distinct().count() < len(texts) ** 2 / 2 / 15


def test_nearest_compares_few(spark, monkeypatch):
    """20 values and 5,000 names: all as by brute force, with a small part of all comparisons."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices(string.ascii_lowercase, k=rng.randint(3, 9)))
    people = sorted({f"{word()} {word()}" for _ in range(5000)})
    values = [v[:2] + rng.choice("xyz") + v[3:] + rng.choice(["", "s", " jr"]) for v in rng.sample(people, 18)] + ["", "none"]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (values[0],)], "v string")
    universe = spark.createDataFrame([*enumerate(people), (-1, None)], "ord long, name string")
    count = []
    compared = similarity._compared

    def counted(*args):
        found = compared(*args)
        count.append(found.count())
        return found

    monkeypatch.setattr(similarity, "_compared", counted)
    got = {r["v"]: (r["name"], r["dist"]) for r in nearest_names(df, "v", universe).collect()}
    every = df.filter("v is not null").distinct().crossJoin(universe.filter("name is not null"))
    best = every.groupBy("v").agg(F.min(F.struct(F.levenshtein("v", "name").alias("d"), "ord", "name")).alias("b"))
    assert got == {r["v"]: (r["b"]["name"], r["b"]["d"]) for r in best.collect()}
    assert sum(count) < len(values) * len(people) / 8


def test_nearest_with_one_hot_cell(spark):
    """All names hold the same letters, so that letter counts tell nothing."""
    people = sorted({"".join(p) for p in itertools.permutations("abcdef")})
    universe = spark.createDataFrame(list(enumerate(people)), "ord long, name string")
    df = spark.createDataFrame([("abcfed",), ("x",), ("abcdefabcdef",)], "v string")
    got = {r["v"]: (r["dist"], r["name"]) for r in nearest_names(df, "v", universe).collect()}
    assert got == {v: (d, people[i]) for v in ("abcfed", "x", "abcdefabcdef") for d, i in [min((distance(v, p), i) for i, p in enumerate(people))]}


def test_nearest_without_names(spark):
    values = spark.createDataFrame([("a",)], "v string")
    assert nearest_names(values, "v", spark.createDataFrame([], "ord long, name string")).collect() == []


@pytest.mark.parametrize("k", [1, 2, 3])
def test_pairs_of_one_template(spark, monkeypatch, k):
    """Pairs of one template meet only within the distance, whatever their lengths, repeated letters and order."""
    monkeypatch.setattr(similarity, "BLOCK", 50)
    rnd = random.Random(k)
    own = sorted({"".join(rnd.choice("abé") for _ in range(rnd.choice([3, 4, 5, 7]))) for _ in range(140)} | {"", "a"})
    texts = [f"the account of {o} with the house" for o in own]
    orders = list(range(len(texts)))
    rnd.shuffle(orders)
    df = spark.createDataFrame(list(zip(texts, orders)), "name string, ord int")
    want = set()
    for (a, i), (b, j) in itertools.combinations(zip(texts, orders), 2):
        if (d := distance(a, b)) <= k:
            want.add((a, b, d) if i < j else (b, a, d))
    got = similarity.similar_pairs(df, "name", "ord", k + 1)
    assert "name1" in got.columns and sorted(tuple(r) for r in got.collect()) == sorted(want)
    cores = spark.createDataFrame(list(zip(own, orders)), "core string, pos long")
    one, two = (similarity._placed_keys(cores, k, 7, first).withColumnRenamed("core", f"c{first}") for first in (True, False))
    met = one.join(two.withColumnRenamed("pos", "p"), "key").select("cTrue", "cFalse").distinct().collect()
    assert {(a, b) for a, b in met} == {(a, b) for a in own for b in own if distance(a, b) <= k}
