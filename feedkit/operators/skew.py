"""Joins that stay balanced when one key holds much of the left side."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.errors import FeedkitError


def join_on(left: DataFrame, right: DataFrame, on: Mapping[str, str], how: str = "left") -> DataFrame:
    """Equality join; ``on`` maps left to right columns, which are named differently. Right keys are dropped.

    Adaptive execution splits the partition of a hot key only where both sides of a sort-merge join come straight from
    a shuffle. A right side that was just aggregated by the same key does not: Spark joins it as it is partitioned.
    Comparing a hash of the keys as well changes the partitioning that the join asks for, so both sides are shuffled
    for it and a hot key of the left side is spread over many tasks. The right side is reduced and small beside the
    left one. Where it is small enough to be broadcast, Spark still does so and shuffles nothing.
    """
    types = dict(left.dtypes), dict(right.dtypes)
    for a, b in on.items():
        if types[0][a] != types[1][b]:
            raise FeedkitError(f"join columns differ in type: {a} {types[0][a]}, {b} {types[1][b]}")
    same = reduce(lambda x, y: x & y, [F.col(a) == F.col(b) for a, b in on.items()])
    joined = left.join(right, same & (F.xxhash64(*on.keys()) == F.xxhash64(*on.values())), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*on.values())


def join_keys(left: DataFrame, right: DataFrame, keys: list[str] | tuple[str, ...], how: str = "left") -> DataFrame:
    """``join_on`` for columns that have the same names on both sides."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    return join_on(left, renamed, {k: f"_r_{k}" for k in keys}, how)
