"""Row filters, casts and column changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.errors import FeedkitError


def between_marks(column: str, low: Column, high: Column) -> Column:
    """After ``low`` and up to ``high``."""
    return (F.col(column) > low) & (F.col(column) <= high)


def criteria(df: DataFrame, wanted: Mapping[str, Sequence[Any]]) -> Column:
    """True where every named column has one of its wanted values.

    A null among the wanted values stands for null cells, no criteria match every row, and a column that the table
    does not have matches none.
    """
    terms = []
    for name, values in wanted.items():
        if name not in df.columns:
            return F.lit(False)
        present = [v for v in values if v is not None]
        term = F.coalesce(F.col(name).isin(present), F.lit(False)) if present else F.lit(False)
        if len(present) < len(values):
            term = term | F.col(name).isNull()
        terms.append(term)
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def filter_criteria(df: DataFrame, wanted: Mapping[str, Sequence[Any]]) -> DataFrame:
    """Rows that meet all the criteria."""
    return df.filter(criteria(df, wanted))


def single_match(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key combination occurs exactly once.

    Counts and keeps one row per key in the same aggregation: a hot key shrinks to one row before the shuffle, and
    no join back is needed.
    """
    rest = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*rest)).alias("_row"))
    return kept.filter("_n = 1").select(*[c if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def repeated_matches(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def missing_link(df: DataFrame, link: str, period: str, value: Any) -> DataFrame:
    """Rows of one period whose foreign key is not set yet."""
    return df.filter((F.col(period) == value) & F.col(link).isNull())


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the given columns, only the rows where none of them is null."""
    return df.select(*columns).dropna("any")


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Columns cast to the given types.

    Strict casts fail on the first bad value. Otherwise a bad value becomes null; the source stays beside it as
    ``<name>_raw``, for ``cast_failures``.
    """
    if strict:
        return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
    raw = df.withColumnsRenamed({c: f"{c}_raw" for c in types})
    return raw.withColumns({c: F.col(f"{c}_raw").try_cast(t) for c, t in types.items()})


def cast_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per leniently cast column: how many values could not be cast."""
    counts = df.agg(*[F.count_if(F.col(c).isNull() & F.col(f"{c}_raw").isNotNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "failures")


def explode_sequence(df: DataFrame, column: str) -> DataFrame:
    """One row per element of an array column, the element in the array's place. Empty and null give no row."""
    return df.withColumn(column, F.explode(column))


def common_across(df: DataFrame, group: str, element: str, groups: Sequence[Any]) -> DataFrame:
    """Distinct elements found in every one of the given groups."""
    if not groups:
        raise FeedkitError("no groups given")
    pairs = df.filter(F.col(group).isin(list(groups))).select(group, element).distinct()
    return pairs.groupBy(element).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == len(set(groups))).drop("_n")
