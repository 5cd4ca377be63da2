"""Edit-distance joins without comparing all pairs.

``similar_pairs`` blocks on deletion variants: two strings within distance k become equal after at most k characters
are deleted from each (the published FastSS method). Strings that share a variant are within 2k of each other, so a
block stays small even where a third of all names share a first name or a prefix, unlike blocks on words, prefixes or
segments. Long strings are blocked on their rarest grams (the published prefix filter). A gram that many strings share, as
in strings from one template, makes a large block, and that is refined: what all its strings start and end with is taken
off, which changes no distance inside the block, and the rest is blocked on deletion variants if it is short, else cut by
length and letter counts, which are lower bounds of the distance. Where all long strings are of one template, so that little is
left of them, no grams are needed: what is left is blocked on deletion variants together with the places of the deletions,
which meet only within the distance.

``nearest_names`` has no bound on the distance. It is a best-first search: names with equal letter counts form a cell, the
counts bound the distance from below, cells are read in the order of the bound, and a value leaves as soon as its best name is
at or under the bound reached.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.operators.ordering import in_order
from feedkit.operators.skew import join_keys, join_on
from feedkit.session import cut_lineage

# Longer strings are blocked on their rarest grams instead, because the number of deletion variants grows with the
# length to the power of the distance.
VARIANT_LENGTH = 32
GRAM = 3
# Beyond this distance there are too many variants, and strings are blocked on segments.
MOST_VARIANT_EDITS = 3
# A gram that more strings share is refined; below it, comparing the pairs costs less.
BLOCK = 2048
# Strings of one template of which at most this many characters differ are blocked on these.
CORE_LENGTH = 12
# Letters are counted in this many groups.
LETTER_GROUPS = 8


def shortest_gram_border(k: int) -> int:
    """Smallest ``variant_length`` for distance k: every string on the gram path has more than GRAM * k grams."""
    return GRAM * (k + 1) + k - 1


def _deletions(texts: Column) -> Column:
    """Every text that results from deleting one character of one of the texts."""
    return F.array_distinct(
        F.flatten(
            F.transform(
                texts,
                lambda t: F.transform(
                    F.filter(F.sequence(F.lit(0), F.length(t)), lambda i: i > 0),
                    lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substr(t, i + 1)),
                ),
            )
        )
    )


def _variant_keys(c: Column, k: int) -> Column:
    """Hashes of the string and of its variants with up to k characters deleted."""
    level, levels = F.array(c), [F.array(c)]
    for _ in range(k):
        level = _deletions(level)
        levels.append(level)
    return F.transform(F.array_distinct(F.concat(*levels)), lambda t: F.xxhash64(t))


def _segments(c: Column, n: Column) -> Column:
    """``(no, start, text)`` of the string cut into n parts whose lengths differ by at most one, longer ones last."""
    size, short = F.floor(F.length(c) / n).cast("int"), (n - F.length(c) % n).cast("int")

    def part(i: Column) -> Column:
        start = (i * size + F.greatest(i - short, F.lit(0)) + 1).cast("int")
        length = size + F.when(i >= short, 1).otherwise(0)
        return F.struct(i.alias("no"), start.alias("start"), F.substr(c, start, length).alias("text"))

    return F.transform(F.sequence(F.lit(0), n - 1), part)


def _segment_index(df: DataFrame, name: str, k: int) -> DataFrame:
    """Rows (len, no, text) per segment. A string shorter than k + 1 characters is cut into single characters."""
    n = F.least(F.lit(k + 1), F.length(name)).cast("int")
    parts = df.filter(F.length(name) > 0).select("*", F.inline(_segments(F.col(name), n)))
    return parts.select(*df.columns, F.length(name).alias("_len"), F.col("no").alias("_no"), F.col("text").alias("_key"))


def _segment_probes(df: DataFrame, name: str, k: int) -> DataFrame:
    """Rows (len, no, text) under which a string within distance k would have one of its segments.

    For every length from |s| - k to |s| + k: the substrings of s that can line up with segment ``no``. In strings
    of at least k + 1 characters a segment moves at most k places; single characters may be anywhere.
    """
    s, size = F.col(name), F.length(name)
    lens = df.select("*", F.explode(F.sequence(F.greatest(size - k, F.lit(1)), F.greatest(size + k, F.lit(1)))).alias("_len"))
    n = F.least(F.lit(k + 1), F.col("_len")).cast("int")
    base, short = F.floor(F.col("_len") / n).cast("int"), (n - F.col("_len") % n).cast("int")
    lens = lens.select("*", F.explode(F.sequence(F.lit(0), n - 1)).alias("_no"))
    no = F.col("_no")
    start = no * base + F.greatest(no - short, F.lit(0)) + 1
    length = base + F.when(no >= short, 1).otherwise(0)
    wide = F.col("_len") <= k
    low = F.when(wide, F.lit(1)).otherwise(F.greatest(start - k, F.lit(1))).cast("int")
    high = F.when(wide, size).otherwise(F.least(start + k, size - length + 1)).cast("int")
    spots = F.filter(F.sequence(F.lit(0), size), lambda p: (p >= low) & (p <= high))
    keys = F.array_distinct(F.transform(spots, lambda p: F.substr(s, p, length)))
    return lens.select(*df.columns, "_len", "_no", F.explode(keys).alias("_key"))


def _rare_grams(df: DataFrame, k: int) -> DataFrame:
    """Rows (n, o, keys, key): the GRAM * k + 1 grams of each string that are rarest over all strings.

    An edit changes at most GRAM grams, so two strings within distance k share one of these. ``keys`` holds all keys
    of the string, by which a pair that shares several is taken only once.
    """
    spots = F.filter(F.sequence(F.lit(1), F.length("n")), lambda i: i <= F.length("n") - GRAM + 1)
    grams = df.withColumn("_g", F.transform(spots, lambda i: F.substr("n", i, F.lit(GRAM))))
    # The second time a gram occurs in a string it is a different key, and so on.
    numbered = F.transform(
        "_g", lambda g, i: F.concat(g, F.size(F.filter(F.slice("_g", F.lit(1), i + 1), lambda h: h == g)).cast("string"))
    )
    keys = grams.select("n", "o", F.explode(numbered).alias("key"))
    counts = keys.groupBy("key").agg(F.count(F.lit(1)).alias("_c"))
    rarest = F.slice(F.sort_array(F.collect_list(F.struct("_c", "key"))), 1, GRAM * k + 1)
    chosen = join_keys(keys, counts, ["key"], "inner").groupBy("n", "o").agg(rarest.alias("_r"))
    hashes = F.transform("_r", lambda r: F.xxhash64(r["key"]))
    return chosen.select("n", "o", hashes.alias("keys")).withColumn("key", F.explode("keys"))


def _letter_counts(c: Column) -> Column:
    """How many characters of the string fall in each of LETTER_GROUPS groups, by code point."""
    letters = F.transform(
        F.filter(F.sequence(F.lit(0), F.length(c)), lambda i: i > 0), lambda i: F.ascii(F.substr(c, i, F.lit(1))) % LETTER_GROUPS
    )
    return F.transform(
        F.sequence(F.lit(0), F.lit(LETTER_GROUPS - 1)), lambda g: F.size(F.filter(letters, lambda x: x == g))
    )


def _count_bound(a: Column, b: Column) -> Column:
    """A lower bound of the distance of two strings from their counts: an edit adds at most one letter and takes away one."""
    over = F.zip_with(a, b, lambda x, y: x - y)
    more = F.aggregate(over, F.lit(0), lambda acc, d: acc + F.greatest(d, F.lit(0)))
    less = F.aggregate(over, F.lit(0), lambda acc, d: acc + F.greatest(-d, F.lit(0)))
    return F.greatest(more, less)


def _common_start(a: Column, b: Column) -> Column:
    """Number of characters with which both strings start."""
    short = F.least(F.length(a), F.length(b))
    places = F.filter(F.sequence(F.lit(0), short), lambda i: i > 0)
    other = F.filter(places, lambda i: F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1)))
    return F.coalesce(F.array_min(other), short + 1) - 1


def _large_blocks(keyed: DataFrame, k: int, core_length: int) -> DataFrame:
    """Rows (key, same, head, tail, most) of the keys of over BLOCK strings: how many characters all of these start and end with.

    The first and the last string in their order start with what all start with; so do the reversed ones. ``most`` is the
    length up to which what is left has few variants beside the strings of the block, so that these cost less than its pairs.
    ``same`` tells apart the sets of strings: of keys with the same strings the smallest one is enough.
    """
    back = F.reverse("n")
    blocks = keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("_c"),
        F.bit_xor(F.xxhash64("n")).alias("_set"),
        F.min("n").alias("_lo"),
        F.max("n").alias("_hi"),
        F.min(back).alias("_rlo"),
        F.max(back).alias("_rhi"),
        F.min(F.length("n")).alias("_len"),
    )
    head = _common_start(F.col("_lo"), F.col("_hi"))
    tail = F.least(_common_start(F.col("_rlo"), F.col("_rhi")), F.col("_len") - F.col("head"))
    variants = F.array(*[F.lit(sum(comb(n, j) for j in range(k + 1))) for n in range(core_length + 1)])
    most = F.size(F.filter(variants, lambda v: v <= F.col("_c") / 8)) - 1
    large = blocks.filter(F.col("_c") > BLOCK).withColumn("head", head)
    return large.select("key", F.struct("_c", "_set").alias("same"), "head", tail.alias("tail"), most.alias("most"))


def _both_sides(rows: DataFrame, on: list[str], *carried: str) -> tuple[DataFrame, DataFrame]:
    """The rows as the first and the second string of a pair."""
    first, second = (
        rows.select(
            F.col("n").alias(f"name{i}"), F.col("o").alias(f"ord{i}"), *[F.col(c).alias(f"{c}{i}") for c in carried], *on
        )
        for i in (1, 2)
    )
    return first, second


_PAIR = ["name1", "ord1", "name2", "ord2"]


def _once(ordered: Column) -> Column:
    """A pair that shares several grams is taken at the smallest."""
    return ordered & (F.col("key") == F.array_min(F.array_intersect("keys1", "keys2")))


def _pairs_of_grams(keyed: DataFrame, k: int, core_length: int, ordered: Column) -> DataFrame:
    """Candidate pairs (name1, ord1, name2, ord2) of the strings that share a gram."""
    first, second = _both_sides(keyed, ["key"], "keys")
    return first.join(second, "key").filter(_once(ordered)).select(*_PAIR)


def _pairs_of_blocks(keyed: DataFrame, k: int, core_length: int, ordered: Column) -> DataFrame:
    """The same where some grams are shared by many strings; see the module's text."""
    large = _large_blocks(keyed, k, core_length)
    few = join_keys(keyed, large, ["key"], "left_anti")
    one = large.groupBy("same").agg(F.min("key").alias("key"), *[F.min_by(c, "key").alias(c) for c in ("head", "tail", "most")])
    many = join_keys(keyed, one.drop("same"), ["key"], "inner")
    core = F.substr("n", F.col("head") + 1, F.length("n") - F.col("head") - F.col("tail"))
    many = many.withColumn("core", core).withColumn("counts", _letter_counts(F.col("core")))
    near = _once(ordered) & (_count_bound(F.col("counts1"), F.col("counts2")) <= k)

    found = _pairs_of_grams(few, k, core_length, ordered)
    # Parts that differ by k characters in length meet under one kind of key, hence the overlap.
    short = many.filter(F.length("core") <= F.col("most")).withColumn("variant", F.explode(_variant_keys(F.col("core"), k)))
    first, second = _both_sides(short, ["key", "variant"], "keys", "counts")
    found = found.unionByName(first.join(second, ["key", "variant"]).filter(near).select(*_PAIR))
    # Length and count of half of the letters differ by at most k: a string meets its own cell and the cells beside it.
    long_ = many.filter(F.length("core") > F.col("most") - k)
    half = F.aggregate(F.slice("counts", 1, LETTER_GROUPS // 2), F.lit(0), lambda acc, x: acc + x)
    cells = long_.withColumns({"by_len": F.floor(F.length("core") / (k + 1)), "by_half": F.floor(half / (k + 1))})
    first, second = _both_sides(cells, ["key", "by_len", "by_half"], "keys", "counts")
    for c in ("by_len", "by_half"):
        second = second.withColumn(c, F.explode(F.sequence(F.col(c) - 1, F.col(c) + 1)))
    met = first.join(second, ["key", "by_len", "by_half"]).filter(near)
    return found.unionByName(met.select(*_PAIR))


def _template(df: DataFrame) -> tuple[int, int, int, int]:
    """How many characters all strings ``n`` start and end with, and the shortest and longest length of what is left."""
    back = F.reverse("n")
    ends = df.agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.min(back).alias("rlo"), F.max(back).alias("rhi"),
        F.min(F.length("n")).alias("short"), F.max(F.length("n")).alias("long"),
    )
    ends = ends.withColumn("head", _common_start(F.col("lo"), F.col("hi")))
    tail = F.least(_common_start(F.col("rlo"), F.col("rhi")), F.col("short") - F.col("head"))
    head, tail, short, long_ = ends.select("head", tail, "short", "long").first()
    return head, tail, short - head - tail, long_ - head - tail


def _placed_keys(cores: DataFrame, k: int, spread: int, first: bool) -> DataFrame:
    """Rows (core, pos, key), by which two strings meet just if they are within distance k, but for equal hashes.

    Strings with m1 and m2 characters deleted that are equal then, and g of whose deletions stand at the same places, are within
    m1 + m2 - g: what stood there was changed, the other characters were taken away or added. Strings within distance k meet
    in such a way with m1, m2 <= k. ``spread`` is the largest difference of two lengths, thus of m1 and m2.
    """
    level = cores.select("core", "pos", F.col("core").alias("rest"), F.array().cast("array<int>").alias("gaps"))
    out = None
    for m in range(k + 1):
        if m:
            # Deletions go from left to right. The place of one is the number of characters left before it.
            low = F.coalesce(F.get("gaps", F.lit(m - 2)), F.lit(0)) + 1
            spots = F.explode(F.sequence(low, F.length("rest"))).alias("spot")
            level = level.filter(F.length("rest") >= low).select("*", spots)
            rest = F.concat(F.substring("rest", F.lit(1), F.col("spot") - 1), F.substr("rest", F.col("spot") + 1))
            level = level.select("core", "pos", rest.alias("rest"), F.array_append("gaps", F.col("spot") - 1).alias("gaps"))
        keys = []
        for other in range(max(m - spread, 0), min(m + spread, k) + 1):
            sides = (m, other) if first else (other, m)
            for places in combinations(range(m), max(m + other - k, 0)):
                keys.append(F.xxhash64(*[F.lit(s) for s in sides], "rest", *[F.get("gaps", F.lit(p)) for p in places]))
        keyed = level.select("core", "pos", F.explode(F.array_distinct(F.array(*keys))).alias("key"))
        out = keyed if out is None else out.unionByName(keyed)
    return out


def _pairs_of_template(df: DataFrame, k: int, head: int, tail: int, spread: int) -> DataFrame:
    """Rows (name1, name2, dist) of the strings ``n`` within distance k, compared by what is left without head and tail."""
    some = df.first()["n"]
    start, end = F.lit(some[:head]), F.lit(some[len(some) - tail :])
    numbered, _ = in_order(df, ["o", "n"], "pos")
    cores = numbered.select(F.substr("n", F.lit(head + 1), F.length("n") - head - tail).alias("core"), "pos")
    one, two = (
        _placed_keys(cores, k, spread, i == 1).withColumnsRenamed({"core": f"core{i}", "pos": f"pos{i}"}) for i in (1, 2)
    )
    met = one.join(two, "key").filter("pos1 < pos2").select("core1", "core2").distinct()
    dist = F.levenshtein(F.col("core1"), F.col("core2"), k)
    near = met.withColumn("dist", dist).filter(F.col("dist").between(0, k))
    return near.select(
        F.concat(start, "core1", end).alias("name1"), F.concat(start, "core2", end).alias("name2"), "dist"
    )


def similar_pairs(names: DataFrame, name: str, order: str, limit: int, variant_length: int = VARIANT_LENGTH) -> DataFrame:
    """Pairs of different names at an edit distance under ``limit``: ``name1`` (the earlier one), ``name2``, ``dist``.

    The names are distinct and non-null. Results are whole: every pair within the distance is found. Distances beyond
    MOST_VARIANT_EDITS are found by segments: of two strings within distance k, one of the k + 1 segments of one of them
    stands in the other, at most k places away.
    """
    k = limit - 1
    if variant_length < shortest_gram_border(k) and k <= MOST_VARIANT_EDITS:
        raise ValueError(f"variant_length must be {shortest_gram_border(k)} or more for limit {limit}")
    if k > MOST_VARIANT_EDITS:
        return _within(_by_segments(names, name, order, k), k)
    df = names.select(F.col(name).alias("n"), F.col(order).alias("o"))
    ordered = (F.col("ord1") < F.col("ord2")) | ((F.col("ord1") == F.col("ord2")) & (F.col("name1") < F.col("name2")))
    # A pair of a short and a long string needs both under one kind of key, hence the overlap of k characters.
    short = df.filter(F.length("n") <= variant_length).select("n", "o", F.explode(_variant_keys(F.col("n"), k)).alias("key"))
    a, b = (short.select(F.col("n").alias(f"name{i}"), F.col("o").alias(f"ord{i}"), "key") for i in (1, 2))
    by_variant = a.join(b, "key").filter(ordered).drop("key")
    long_names = df.filter(F.length("n") > variant_length - k)
    # Up to BLOCK strings make no larger block.
    refined = long_names.limit(BLOCK + 1).count() > BLOCK
    if refined:
        head, tail, shortest, longest = _template(long_names)
        if longest <= CORE_LENGTH:
            found = _pairs_of_template(long_names, k, head, tail, longest - shortest)
            twice = (F.length("name1") <= variant_length) & (F.length("name2") <= variant_length)
            return _within(by_variant, k).unionByName(found.filter(~twice))
    long_ = _rare_grams(long_names, k)
    by_gram = (_pairs_of_blocks if refined else _pairs_of_grams)(long_, k, variant_length, ordered)
    return _within(by_variant.unionByName(by_gram), k)


def _by_segments(names: DataFrame, name: str, order: str, k: int) -> DataFrame:
    """Candidate pairs (name1, ord1, name2, ord2) for any distance k."""
    first = names.select(F.col(name).alias("name1"), F.col(order).alias("ord1"))
    second = names.select(F.col(name).alias("name2"), F.col(order).alias("ord2"))
    ordered = (F.col("ord1") < F.col("ord2")) | ((F.col("ord1") == F.col("ord2")) & (F.col("name1") < F.col("name2")))
    probes = _segment_probes(first, "name1", k).distinct()
    index = _segment_index(second, "name2", k).distinct()
    met = probes.join(index, ["_len", "_no", "_key"]).filter(ordered).select("name1", "ord1", "name2", "ord2")
    # Strings of k characters or fewer are all within k of each other, so these are results and not only candidates.
    short = first.filter(F.length("name1") <= k).withColumn("_one", F.lit(1))
    others = second.filter(F.length("name2") <= k).withColumn("_one", F.lit(1))
    return met.unionByName(short.join(others, "_one").filter(ordered).drop("_one"))


def _within(found: DataFrame, k: int) -> DataFrame:
    """Candidates within distance k; a pair is compared once, however many keys it shares."""
    return (
        found.select("name1", "name2")
        .distinct()
        .withColumn("dist", F.levenshtein(F.col("name1"), F.col("name2"), k))
        .filter(F.col("dist").between(0, k))
    )


def _shapes(df: DataFrame, name: str) -> DataFrame:
    """Adds the letter counts of a column and their sums over both halves of the groups: ``counts``, ``low``, ``high``."""
    half = LETTER_GROUPS // 2
    total = lambda part: F.aggregate(part, F.lit(0), lambda acc, x: acc + x)
    counted = df.withColumn("counts", _letter_counts(F.col(name)))
    return counted.withColumns(
        {"low": total(F.slice("counts", 1, half)), "high": total(F.slice("counts", half + 1, LETTER_GROUPS - half))}
    )


def _cells_between(open_: DataFrame, cells: DataFrame, beyond: int, upto: int) -> DataFrame:
    """Rows (value, best, cell): cells with a bound over ``beyond`` and up to ``upto`` that may hold a name as good as the best.

    Cells are found from coarse to fine: by the sum over half of the groups, by both sums, by all counts.
    """
    ends = F.greatest(F.col("low") - upto, F.lit(0)), F.col("low") + upto
    wide = open_.select("value", "counts", F.col("high").alias("_high"), "best", F.explode(F.sequence(*ends)).alias("low"))
    pairs = cells.select("low", "high").distinct()
    near = wide.join(pairs, "low").filter(F.abs(F.col("high") - F.col("_high")) <= upto)
    fine = cells.select("low", "high", F.col("counts").alias("cell"))
    bound = _count_bound(F.col("counts"), F.col("cell"))
    met = near.join(fine, ["low", "high"]).withColumn("bound", bound)
    reached = (F.col("bound") > beyond) & (F.col("bound") <= upto)
    return met.filter(reached & (F.col("best").isNull() | (F.col("bound") <= F.col("best")["dist"]))).select("value", "best", "cell")


def _compared(cells: DataFrame, people: DataFrame) -> DataFrame:
    """Rows (value, found): the distance to every name of the given cells, none where a better name is known."""
    names = people.select("name", "ord", F.col("counts").alias("_counts"))
    met = join_on(names, cells, {"_counts": "cell"}, "inner")
    # Fixed value: a bound over every distance, where no name is known yet.
    dist = F.expr("levenshtein(value, name, coalesce(best.dist, 2147483646))")
    return met.select("value", F.struct(dist.alias("dist"), "ord", "name").alias("found"))


def nearest_names(df: DataFrame, value: str, universe: DataFrame) -> DataFrame:
    """The name of the universe (``name``, ``ord``) nearest to each distinct value, the first one on a tie.

    Adds ``name`` and ``dist``. Null values and names are left out; without names there are no rows. The bound doubles until no
    value is left; a value is compared once with each name whose letter counts allow for a distance up to the bound and
    up to its best so far.
    """
    people = _shapes(universe.filter(F.col("name").isNotNull()).groupBy("name").agg(F.min("ord").alias("ord")), "name")
    people = cut_lineage(people)
    best_type = f"struct<dist:int,ord:{dict(people.dtypes)['ord']},name:string>"
    values = _shapes(df.select(F.col(value).alias("value")).filter(F.col(value).isNotNull()).distinct(), "value")
    open_ = cut_lineage(values.withColumn("best", F.lit(None).cast(best_type)))
    longest = people.agg(F.max(F.length("name"))).first()[0]
    done = open_.limit(0)
    if longest is not None:
        cells = people.select("low", "high", "counts").distinct()
        longest = max(longest, open_.agg(F.max(F.length("value"))).first()[0] or 0)
        beyond, upto = -1, 2
        while not open_.isEmpty():
            compared = _compared(_cells_between(open_, cells, beyond, upto), people).filter("found.dist >= 0")
            found = compared.groupBy("value").agg(F.min("found").alias("found"))
            state = join_keys(open_, found, ["value"]).withColumn("best", F.least("best", "found")).drop("found")
            state = cut_lineage(state)
            settled = F.col("best").isNotNull() & ((F.col("best")["dist"] <= upto) | F.lit(upto >= longest))
            done = done.unionByName(state.filter(settled))
            open_ = state.filter(~settled)
            beyond, upto = upto, 2 * upto
    return done.select(F.col("value").alias(value), "best.name", "best.dist")
