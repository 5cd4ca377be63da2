"""N-gram Jaccard join by parity sketches.

A document is the set of its word shingles. Two sets of a and b shingles with a similarity of at least s differ in at most
T = (1 - s)(a + b) / (1 + s) shingles. A parity sketch throws every shingle at a bit and flips it; the bits in which two
sketches differ are at most as many as the shingles in which the sets do. A sketch of B > T words of 64 bits therefore
agrees in at least B - T words with that of any partner: documents of one size band are joined on (band, place, word).

Words that are zero say nothing and would meet everywhere. B is larger than T + 1, so that a document with few zero words
shares another word with each partner; one with B - T or more of them joins on the zeros too, as all its partners that
lack another common word do. Nearly every document shares two words or more with each partner, and knows if it may not; two
that stand as smallest and other member of a single bucket only are then no partners, or meet in a bucket between others.

So B - T - 2 words more than needed may be left out, and a document leaves out its poorest ones: words with few bits are shared by
chance and would make most of the buckets. They go in one order of words and places for all documents, by bits and then by hash.
What a document leaves out is the beginning of that order, so that of the words two partners share the one that leaves out more
decides, and two are left.

Candidates pass two bounds, the sizes and the Hamming distance of a second, short sketch, before the sets themselves are
compared. Equal sets are one class from the start. A bucket of the join is first compared with its smallest and its
largest member only; what these links connect is left out when the rest of the bucket is compared.

Shingles are 64-bit hashes of their words. Classes are told apart by 64 bits of a hash over the set within the join.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedkit.llm.components import components
from feedkit.llm.scratch import Scratch
from feedkit.llm.text import pieces, utf8
from feedkit.operators.skew import join_on
from feedkit.session import written

WORDS = 5
PERCENT = 80
# Largest over smallest size of a band, about.
BAND = 1.4
SIGNATURE = 8
# Keys, and pairs, are dealt out by their hash and go through the join one part after the other, so that the shuffle files of one
# part alone are on disk. Shingles are made again for every part of the keys.
KEY_GOES = 2
PAIR_GOES = 4
CACHE_WORDS = 200_000
CACHE_SETS = 200_000

_P = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * _P[0]
    x = x ^ (x >> np.uint64(29))
    x = x * _P[3]
    return x ^ (x >> np.uint64(32))


def shingles(data: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words, A-Z in lower case; of all words if there are fewer."""
    words = data.lower().split()
    if len(_hashes) > CACHE_WORDS:
        _hashes.clear()
    numbers = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    if not words:
        return numbers
    length = min(size, len(words))
    total = np.full(len(words) - length + 1, length, np.uint64)
    for i in range(length):
        # An odd factor for each place.
        factor = _mix(np.array([i + 1], np.uint64))[0] | np.uint64(1)
        total += numbers[i : len(words) - length + 1 + i] * factor
    return np.unique(_mix(total))


def differences(a: int, b: int, percent: int) -> int:
    """Shingles in which two linked sets of sizes a and b can differ at most."""
    return (100 - percent) * (a + b) // (100 + percent)


class Bands:
    """Size bands: ``low[k]`` to ``low[k + 1] - 1``. A pair is met in the band of its larger set."""

    def __init__(self, percent: int):
        self.percent = percent
        self.low = [1]

    def _band(self, n: int) -> int:
        while self.low[-1] <= n:
            self.low.append(max(self.low[-1] + 1, int(self.low[-1] * BAND) + 1))
        return int(np.searchsorted(self.low, n, side="right")) - 1

    def of(self, n: int) -> Iterator[tuple[int, int, int]]:
        """(band, T, B) of every band in which a set of n shingles can meet a partner that differs from it."""
        for k in range(self._band(n), self._band(100 * n // self.percent) + 1):
            self._band(self.low[k] + 1)
            most = self.low[k + 1] - 1 if k + 1 < len(self.low) else self.low[k]
            t = differences(most, most, self.percent)
            if t:
                yield k, t, t + 2 + t // 8


def _parity(places: np.ndarray, words: int) -> np.ndarray:
    """Sketch of so many 64-bit words; a place is a bit number."""
    odd = (np.bincount(places, minlength=64 * words) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<u8")


def sketch_keys(hashes: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Join keys of a set: one for every word of its sketches but the poorest, for some zero ones as well if they are many.

    A key is lone if the set may share but this one with a partner of its band. At least size - t words of partners agree,
    and if zero words have no keys, as many less may be left; without that, size - t is two or more. Of other poor words as
    many are left out as leaves two.
    """
    out, lone = [], []
    bit = hashes & np.uint64(63)
    for band, t, size in bands.of(len(hashes)):
        place = (hashes >> np.uint64(24)) % np.uint64(size)
        sketch = _parity((place * np.uint64(64) + bit).astype(np.int64), size)
        at = np.arange(size, dtype=np.uint64)
        zeros = np.count_nonzero(sketch == 0)
        sure = size - t
        less = max(zeros if zeros < sure else 0, sure - 2)
        keys = _mix(sketch * _P[1] + at * _P[2] + np.array([band + 1], np.uint64) * _P[4])
        if less:
            keys = keys[np.lexsort((keys, np.bitwise_count(sketch)))[less:]]
        out.append(keys)
        lone.append(np.full(len(keys), sure - less < 2))
    return (np.concatenate(out), np.concatenate(lone)) if out else (np.zeros(0, np.uint64), np.zeros(0, bool))


def signature(hashes: np.ndarray) -> np.ndarray:
    """Short parity sketch, by other bits of the hashes."""
    return _parity(((hashes >> np.uint64(6)) % np.uint64(64 * SIGNATURE)).astype(np.int64), SIGNATURE)


def wide_signature(hashes: np.ndarray) -> np.ndarray | None:
    """The same sketch with four bits or more for each shingle, for sets that the short one says little about.

    Its length is a power of two, so it folds to a shorter one by XOR.
    """
    words = 1 << (len(hashes) // 16).bit_length()
    if words <= SIGNATURE:
        return None
    return _parity(((hashes >> np.uint64(6)) % np.uint64(64 * words)).astype(np.int64), words)


SETS = "id long, n_shingles long, fp long, fp2 long, sig array<long>, wide array<long>"


def _fingerprint(hashes: np.ndarray) -> list[int]:
    return np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), "<i8").tolist()


def sketched(docs: DataFrame, words: int, id_: str, text: str) -> DataFrame:
    """Rows of SETS. ``wide`` is null where the task has met the set before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in pieces(batches, "data"):
            rows = []
            for data in batch.column("data").to_pylist():
                hashes = shingles(data, words)
                if not len(hashes):
                    rows.append((0, None, None, None, None))
                    continue
                one, two = _fingerprint(hashes)
                wide = None if one in seen else wide_signature(hashes)
                seen.add(one)
                rows.append((len(hashes), one, two, signature(hashes).view(np.int64), None if wide is None else wide.view(np.int64)))
            if len(seen) > CACHE_SETS:
                seen.clear()
            n, first, second, sigs, wides = zip(*rows, strict=True)
            columns = [batch.column("id"), *(pa.array(x, pa.int64()) for x in (n, first, second))]
            columns += [pa.array(x, pa.list_(pa.int64())) for x in (sigs, wides)]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in SETS.split(", ")])
        # A worker goes on with tasks of other kinds, which need the memory.
        _hashes.clear()

    rows = docs.select(F.col(id_).cast("long").alias("id"), utf8(text).alias("data"))
    return rows.mapInArrow(run, SETS)


def keyed(docs: DataFrame, words: int, percent: int, text: str, go: int = 0, goes: int = 1) -> DataFrame:
    """Rows (key, fp, lone): the join keys of every set, which a task gives once. They go straight into the join's shuffle.

    Of ``goes`` parts of the keys only the one numbered ``go``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(percent), set()
        for batch in pieces(batches, "data"):
            keys, fps, alone = [], [], []
            for data in batch.column("data").to_pylist():
                hashes = shingles(data, words)
                one = _fingerprint(hashes)[0] if len(hashes) else None
                if one is None or one in seen:
                    continue
                seen.add(one)
                own, lone = sketch_keys(hashes, bands)
                if goes > 1:
                    now = (own >> np.uint64(32)) % np.uint64(goes) == go
                    own, lone = own[now], lone[now]
                keys.append(own.view(np.int64))
                alone.append(lone)
                fps.append(np.full(len(own), one, np.int64))
            if len(seen) > CACHE_SETS:
                seen.clear()
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, fps, alone)], ["key", "fp", "lone"])
        _hashes.clear()

    return docs.select(utf8(text).alias("data")).mapInArrow(run, "key long, fp long, lone boolean")


def _sets_of(scratch: Scratch, docs: DataFrame, nodes: DataFrame, words: int, id_: str, text: str) -> DataFrame:
    """Rows (fp, hashes) of the classes in ``nodes`` (fp, id), from the text of one document each; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "data"):
            sets = [shingles(x, words) for x in batch.column("data").to_pylist()]
            # Rows that share an id may hold other texts; the class says which is meant.
            fps = [int(np.frombuffer(xxhash.xxh3_128_digest(x.tobytes()), "<i8")[0]) for x in sets]
            columns = [pa.array(fps, pa.int64()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["fp", "hashes"])
        _hashes.clear()

    wanted = nodes.select(F.col("id").alias("w_id"), F.col("fp").alias("w_fp"))
    rows = docs.select(F.col(id_).cast("long").alias("id"), utf8(text).alias("data"))
    # Classes whose rows all lack an id are looked for among the rows without one.
    nameless = rows.filter("id IS NULL")
    rows = rows.join(wanted.select("w_id").distinct(), F.col("id") == F.col("w_id"), "left_semi")
    if not wanted.filter("w_id IS NULL").isEmpty():
        rows = rows.union(nameless)
    sets = rows.mapInArrow(run, "fp long, hashes array<long>")
    return scratch.written(sets.join(wanted, F.col("fp") == F.col("w_fp"), "left_semi").dropDuplicates(["fp"]))


def _could_link(percent: int) -> Column:
    """Whether the sizes and signatures of nodes a and b allow a link."""
    small, large = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    differ = reduce(lambda x, y: x + y, (F.bit_count(F.col(f"a_s{i}").bitwiseXOR(F.col(f"b_s{i}"))) for i in range(SIGNATURE)))
    most = F.floor((100 - percent) * (F.col("a_n") + F.col("b_n")) / F.lit(100 + percent))
    return (100 * small >= percent * large) & (differ <= most)


def _sided(nodes: DataFrame, side: str) -> DataFrame:
    """The columns of nodes (fp, n, s0...) under the names of one side of a pair."""
    return nodes.select(
        F.col("fp").alias(f"{side}_fp"), F.col("n").alias(f"{side}_n"), *[F.col(f"s{i}").alias(f"{side}_s{i}") for i in range(SIGNATURE)]
    )


def _folded(wide: str, size: Column) -> Column:
    """A wide signature folded to ``size`` words."""
    words = F.col(wide)

    def word(i: Column) -> Column:
        same = F.transform(F.sequence(i, F.size(words) - 1, size), lambda j: F.get(words, j))
        return F.aggregate(same, F.lit(0).cast("long"), lambda x, y: x.bitwiseXOR(y))

    return F.transform(F.sequence(F.lit(0), size - 1), word)


def _wide_enough(scratch: Scratch, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose wide signatures allow a link as well."""
    ends = pairs.select(F.col("a").alias("e")).union(pairs.select(F.col("b").alias("e"))).distinct()
    wides = sets.filter("wide IS NOT NULL").join(scratch.written(ends), F.col("fp") == F.col("e"), "left_semi")
    wides = scratch.written(wides.select("fp", "n_shingles", "wide").dropDuplicates(["fp"]))
    for side in ("a", "b"):
        own = wides.select(F.col("fp").alias(f"{side}_fp"), F.col("n_shingles").alias(f"{side}_n"), F.col("wide").alias(f"{side}_wide"))
        pairs = join_on(pairs, own, {side: f"{side}_fp"})
    size = F.least(F.size("a_wide"), F.size("b_wide"))
    differ = F.zip_with(_folded("a_wide", size), _folded("b_wide", size), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(differ, F.lit(0), lambda x, y: x + y)
    most = F.floor((100 - percent) * (F.col("a_n") + F.col("b_n")) / F.lit(100 + percent))
    unknown = F.col("a_wide").isNull() | F.col("b_wide").isNull()
    return pairs.filter(F.when(unknown, True).otherwise(differ <= most)).select("a", "b")


def _links(
    scratch: Scratch,
    pairs: DataFrame,
    nodes: DataFrame,
    sets: DataFrame,
    docs: DataFrame,
    words: int,
    percent: int,
    id_: str,
    text: str,
) -> DataFrame:
    """Those of the pairs (a, b) of classes that are similar enough, compared on whole sets; written."""
    pairs = scratch.written(_wide_enough(scratch, scratch.written(pairs), sets, percent))
    ends = pairs.select(F.col("a").alias("e")).union(pairs.select(F.col("b").alias("e"))).distinct()
    involved = scratch.written(nodes.join(ends, F.col("fp") == F.col("e"), "left_semi").select("fp", "id"))
    hashes = _sets_of(scratch, docs, involved, words, id_, text)
    a = hashes.select(F.col("fp").alias("a_fp"), F.col("hashes").alias("a_set"))
    b = hashes.select(F.col("fp").alias("b_fp"), F.col("hashes").alias("b_set"))
    both = join_on(join_on(pairs, a, {"a": "a_fp"}, "inner"), b, {"b": "b_fp"}, "inner")
    common = F.size(F.array_intersect("a_set", "b_set"))
    union = F.size("a_set") + F.size("b_set") - F.col("common")
    near = both.withColumn("common", common).filter(100 * F.col("common") >= percent * union)
    return scratch.written(near.select("a", "b"))


def _buckets(keys: DataFrame) -> DataFrame:
    """Buckets of the join with more than one class, and their smallest and largest member. One of two members says it all."""
    bucket = Window.partitionBy("key")
    one = F.struct("fp", "lone")
    sides = {"low": F.min(one).over(bucket), "high": F.max(one).over(bucket), "size": F.count(F.lit(1)).over(bucket)}
    members = keys.withColumns(sides).filter("low.fp < high.fp AND (size > 2 OR fp = high.fp)")
    lone = [F.col("lone") | F.col(f"{side}.lone") for side in ("low", "high")]
    # Most buckets are of two, which need neither their key nor a member of their own: null costs no space.
    large = F.col("size") > 2
    return members.select(
        F.when(large, F.col("key")).alias("key"), F.when(large, F.col("fp")).alias("fp"),
        F.col("low.fp").alias("low"), F.col("high.fp").alias("high"), lone[0].alias("f"), lone[1].alias("g")
    )


def near_duplicates(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: id, n_shingles (size of its set) and component_id, the smallest id that links lead to.

    Documents link when 100 * intersection >= percent * union of their shingle sets. A null or wordless text is linked
    with nothing. Rows that share an id are one document as to what their sets link to. A row without an id takes part
    like any other, but is never the smallest; alone it has no component. Other columns are left out.
    """
    scratch = Scratch(docs.sparkSession, "ngram-join")
    sets = scratch.written(sketched(docs, words, id_, text))
    classes = sets.filter("fp IS NOT NULL").groupBy("fp").agg(
        F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")
    )
    nodes = scratch.written(classes.select("fp", "id", "n", *[F.get("sig", i).alias(f"s{i}") for i in range(SIGNATURE)]))

    buckets = []
    for go in range(KEY_GOES):
        buckets.append(scratch.written(_buckets(keyed(docs, words, percent, text, go, KEY_GOES))))
        scratch.sweep()
    members = reduce(DataFrame.union, buckets)

    # Every member with the smallest and the largest one. Partners agree in two keys or more, unless one of them has a lone
    # one. A pair that stands so in a single bucket is none, or shares a bucket with two others that lie below and above it,
    # where it is met later.
    ends = members.select(F.col("low").alias("a"), F.coalesce("fp", "high").alias("b"), F.col("f").alias("lone")).filter("a < b")
    ends = ends.union(members.filter("low < fp AND fp < high").select("fp", "high", "g"))
    found = []
    for go in range(PAIR_GOES):
        part = ends.filter(F.pmod(F.xxhash64("a", "b"), F.lit(PAIR_GOES)) == go)
        stars = part.groupBy("a", "b").agg(F.count(F.lit(1)).alias("met"), F.bool_or("lone").alias("lone"))
        # Written alone: what was shuffled to count the pairs is gone before their signatures are shuffled with them.
        stars = scratch.written(stars.filter("met > 1 OR lone").select("a", "b"))
        scratch.sweep()
        stars = join_on(join_on(stars, _sided(nodes, "a"), {"a": "a_fp"}, "inner"), _sided(nodes, "b"), {"b": "b_fp"}, "inner")
        found.append(scratch.written(stars.filter(_could_link(percent)).select("a", "b")))
        scratch.sweep()
    links = _links(scratch, reduce(DataFrame.union, found), nodes, sets, docs, words, percent, id_, text)
    labels = components(links, "a", "b", scratch.written)
    scratch.sweep()

    # What is left of the buckets of three or more: members that the links do not connect with the smallest one, against all others.
    named = labels.select(F.col("node"), F.col("root"))
    left = join_on(members.filter("key IS NOT NULL").select("key", "fp", "low").distinct(), named.withColumnRenamed("node", "m"), {"fp": "m"})
    left = join_on(left.withColumnRenamed("root", "r"), named.withColumnRenamed("node", "m"), {"low": "m"})
    left = scratch.written(left.select("key", "fp", F.coalesce("r", "fp").alias("label"), F.coalesce("root", "low").alias("main")))
    unsolved = left.filter("label <> main").select(F.col("key").alias("k")).distinct()
    left = join_on(left, unsolved, {"key": "k"}, "left_semi")
    marks = nodes.select(F.col("fp").alias("n_fp"), "n", *[f"s{i}" for i in range(SIGNATURE)])
    left = scratch.written(join_on(left, marks, {"fp": "n_fp"}, "inner"))
    one, two = _as_side(left.filter("label <> main"), "a"), _as_side(left, "b")
    # Both outside the main component: taken once, by order.
    order = (F.col("b_label") == F.col("b_main")) | (F.col("a_fp") < F.col("b_fp"))
    met = one.join(two, (F.col("a_key") == F.col("b_key")) & (F.col("a_label") != F.col("b_label")) & order & _could_link(percent))
    rest = met.select(F.least("a_fp", "b_fp").alias("a"), F.greatest("a_fp", "b_fp").alias("b")).distinct()
    more = _links(scratch, rest, nodes, sets, docs, words, percent, id_, text)
    labels = components(links.union(more), "a", "b", scratch.written)

    # From classes back to documents.
    ids = nodes.select(F.col("fp").alias("c"), F.col("id").alias("c_id"))
    linked = join_on(labels, ids, {"node": "c"}, "inner")
    least = linked.groupBy("root").agg(F.min("c_id").alias("least")).withColumnRenamed("root", "t")
    linked = scratch.written(join_on(linked, least, {"root": "t"}, "inner").select(F.col("node").alias("l"), "least"))
    placed = join_on(sets.select("id", "n_shingles", "fp"), ids, {"fp": "c"})
    placed = join_on(placed, linked, {"fp": "l"})
    out = written(placed.select(F.col("id").alias(id_), "n_shingles", F.coalesce("least", "c_id", "id").alias("component_id")))
    scratch.drop()
    return out


def _as_side(rows: DataFrame, side: str) -> DataFrame:
    return rows.select(*[F.col(c).alias(f"{side}_{c}") for c in rows.columns])
