"""Expressions over array and map columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def flatten_once(c: Column) -> Column:
    """Array of arrays, one level flattened."""
    return F.flatten(c)


def common_elements(*arrays: Column) -> Column:
    """Distinct elements found in every one of the given array columns."""
    return reduce(F.array_intersect, arrays[1:], F.array_distinct(arrays[0]))


def contains_all(a: Column, b: Column) -> Column:
    """True where every element of ``b`` is in ``a``; an empty ``b`` is always contained."""
    return F.size(F.array_except(b, a)) == 0


def sequences_equal(a: Column, b: Column, order: bool = False) -> Column:
    """Same elements: as ordered lists, or with their number of occurrences when order does not matter."""
    return a == b if order else F.sort_array(a) == F.sort_array(b)


def all_equal(a: Column) -> Column:
    """True where all elements are the same; null for an empty array."""
    return F.when(F.size(a) > 0, F.size(F.array_distinct(a)) == 1)


def maps_equal(a: Column, b: Column) -> Column:
    """Same keys with the same values, whatever their order."""
    return F.sort_array(F.map_entries(a)) == F.sort_array(F.map_entries(b))
