"""Top rows, outliers, exact quantiles."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.errors import TooFewRows


def top_rows(df: DataFrame, column: str, n: int, key: str) -> DataFrame:
    """The n rows with the highest value, nulls last, ties by key."""
    if n < 0:
        raise ValueError("n must not be negative")
    return df.orderBy(F.desc_nulls_last(column), F.asc(key)).limit(n)


def top_keys(df: DataFrame, column: str, n: int, key: str) -> DataFrame:
    """Keys of the n rows with the highest value."""
    return top_rows(df.select(key, column), column, n, key).select(key)


def top_pairs(pairs: DataFrame, n: int, mode: str = "pos") -> DataFrame:
    """The n largest correlations (``pos``), lowest (``neg``) or largest magnitudes (``abs``), nulls last."""
    if mode not in ("pos", "neg", "abs"):
        raise ValueError(f"unknown mode {mode}")
    if mode == "abs":
        pairs = pairs.withColumn("corr", F.abs("corr"))
    order = F.asc_nulls_last("corr") if mode == "neg" else F.desc_nulls_last("corr")
    return pairs.orderBy(order, "col_a", "col_b").limit(n)


def rank_by_distance(df: DataFrame, name: str, reference: str, order: str) -> DataFrame:
    """Names with their edit distance to one reference, nearest first."""
    return df.withColumn("dist", F.levenshtein(F.col(name), F.lit(reference))).orderBy("dist", order)


@dataclass
class _Bracket:
    """Open interval known to hold the values of some ranks.

    ``below`` values are at or under its low end and ``inside`` values in it.
    """

    ranks: list[int]
    low: float | None
    high: float | None
    below: int
    inside: int

    def holds(self, c: Column) -> Column:
        cond = F.lit(True)
        if self.low is not None:
            cond = cond & (c > F.lit(self.low))
        if self.high is not None:
            cond = cond & (c < F.lit(self.high))
        return cond


def exact_quantiles(
    df: DataFrame, column: str, probs: Sequence[float], gather: int = 100_000, accuracy: int = 10_000
) -> list[float | None]:
    """Quantiles with linear interpolation, exact at any size. Nulls and NaN are skipped.

    A built-in exact percentile gathers every distinct value in one task. Here an approximate sketch gives narrow
    brackets around the wanted ranks, exact counts confirm on which side of an end each rank lies, and the search
    goes on inside until a bracket has at most ``gather`` values. Each round shrinks a bracket about
    ``accuracy / 4`` times, so even 10**12 rows need two or three. Only counts and bracket ends reach the driver.
    """
    c = F.col("_v")
    values = df.select(F.col(column).cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    n = values.count()
    if n == 0:
        return [None] * len(probs)
    places = [(n - 1) * p for p in probs]
    ranks = sorted({r for h in places for r in (math.floor(h), math.ceil(h))})
    found: dict[int, float] = {}
    brackets = [_Bracket(ranks, None, None, 0, n)]
    while large := [b for b in brackets if b.inside > gather]:
        small = [b for b in brackets if b.inside <= gather]
        brackets = small + _narrow(values, c, large, accuracy, found)
    if brackets:
        picks = []
        for b in brackets:
            ordered = F.sort_array(F.collect_list(F.when(b.holds(c), c)))
            picks += [F.element_at(ordered, r - b.below + 1).alias(str(r)) for r in b.ranks]
        near = reduce(lambda x, y: x | y, [b.holds(c) for b in brackets])
        found.update({int(r): v for r, v in values.filter(near).agg(*picks).first().asDict().items()})
    out = []
    for h in places:
        lo, hi = found[math.floor(h)], found[math.ceil(h)]
        out.append(lo + (hi - lo) * (h - math.floor(h)))
    return out


def _narrow(
    values: DataFrame, c: Column, brackets: list[_Bracket], accuracy: int, found: dict[int, float]
) -> list[_Bracket]:
    """One sketch pass and one counting pass over all brackets; ranks hit on a bracket end are done."""
    slack = 2.0 / accuracy
    clusters: list[list[tuple[list[int], float, float]]] = []
    for b in brackets:
        own: list[tuple[list[int], float, float]] = []
        for r in b.ranks:
            at = (r - b.below) / max(b.inside - 1, 1)
            if own and at - slack <= own[-1][2]:
                own[-1] = ([*own[-1][0], r], own[-1][1], min(at + slack, 1.0))
            else:
                own.append(([r], max(at - slack, 0.0), min(at + slack, 1.0)))
        clusters.append(own)
    sketches = [
        F.percentile_approx(F.when(b.holds(c), c), [p for _, lo, hi in own for p in (lo, hi)], accuracy).alias(str(i))
        for i, (b, own) in enumerate(zip(brackets, clusters, strict=True))
    ]
    ends = values.agg(*sketches).first()
    cuts = [
        (b, ranks, ends[i][2 * j], ends[i][2 * j + 1])
        for i, (b, own) in enumerate(zip(brackets, clusters, strict=True))
        for j, (ranks, _, _) in enumerate(own)
    ]
    counts = []
    for i, (b, _, lo, hi) in enumerate(cuts):
        inside = b.holds(c)
        counts += [
            F.count_if(inside & (c < lo)).alias(f"under{i}"),
            F.count_if(inside & (c == lo)).alias(f"lo{i}"),
            F.count_if(inside & (c > lo) & (c < hi)).alias(f"mid{i}"),
            F.count_if(inside & (c == hi)).alias(f"hi{i}"),
        ]
    row = values.agg(*counts).first()
    left: dict[tuple, _Bracket] = {}

    def keep(rank: int, low: float | None, high: float | None, below: int, inside: int) -> None:
        left.setdefault((low, high), _Bracket([], low, high, below, inside)).ranks.append(rank)

    for i, (b, ranks, lo, hi) in enumerate(cuts):
        # Number of values of the bracket before each boundary.
        to_lo = row[f"under{i}"]
        past_lo = to_lo + row[f"lo{i}"]
        to_hi = past_lo + row[f"mid{i}"]
        past_hi = to_hi + (row[f"hi{i}"] if hi > lo else 0)
        for r in ranks:
            place = r - b.below
            if place < to_lo:
                keep(r, b.low, lo, b.below, to_lo)
            elif place < past_lo:
                found[r] = lo
            elif place < to_hi:
                keep(r, lo, hi, b.below + past_lo, to_hi - past_lo)
            elif place < past_hi:
                found[r] = hi
            else:
                keep(r, hi, b.high, b.below + past_hi, b.inside - past_hi)
    return list(left.values())


def remove_outliers_pct(df: DataFrame, column: str, top: float = 0, bottom: float = 0, **options) -> DataFrame:
    """Rows between the ``bottom`` and the ``1 - top`` quantile, both included. Null values are always dropped.

    The bounds are literals in the result's filter, so they reach the file scan.
    """
    low, high = exact_quantiles(df, column, [bottom, 1 - top], **options)
    if low is None:
        return df.limit(0)
    return df.filter((F.col(column) >= F.lit(low)) & (F.col(column) <= F.lit(high)))


def remove_outliers_count(df: DataFrame, column: str, top: int, bottom: int, key: str) -> DataFrame:
    """Without the ``top`` highest and then the ``bottom`` lowest of the remaining rows. Null values stay.

    Ties go by ``key``, a unique column. The picked rows are few, so the table itself is not shuffled.
    """
    if df.select(key).limit(top + bottom).count() < top + bottom:
        raise TooFewRows(f"the table has fewer than the {top + bottom} rows to be removed")
    # NaN is a missing value and is never picked.
    usable = df.select(key, column).filter(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
    highest = usable.orderBy(F.desc(column), F.asc(key)).limit(top).select(key)
    # Enough candidates to still have ``bottom`` of them after those that are among the highest are gone.
    lowest = usable.orderBy(F.asc(column), F.asc(key)).limit(top + bottom)
    lowest = lowest.join(highest, key, "left_anti").orderBy(F.asc(column), F.asc(key)).limit(bottom).select(key)
    return df.join(highest.unionByName(lowest), key, "left_anti").select(*df.columns)


def remove_outliers(df: DataFrame, column: str, key: str, top: float = 0, bottom: float = 0, **options) -> DataFrame:
    """Shares of the rows if both arguments are under 1; otherwise both are cut to whole numbers of rows."""
    if top >= 1 or bottom >= 1:
        return remove_outliers_count(df, column, int(top), int(bottom), key)
    return remove_outliers_pct(df, column, top, bottom, **options)
