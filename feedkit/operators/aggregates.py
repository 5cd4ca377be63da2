"""Aggregations."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# More pairs of columns than this are computed from matrix products.
WIDE_PAIRS = 50


def date_range(df: DataFrame, column: str) -> DataFrame:
    """One row: number of different dates, first and last date. An empty table gives (0, null, null)."""
    return df.agg(
        F.count_distinct(column).alias("num_dates"), F.min(column).alias("min_date"), F.max(column).alias("max_date")
    )


def group_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def flagged_count(df: DataFrame, keys: Sequence[str], flag: Column) -> DataFrame:
    """Rows per group where the flag is true; null is not true."""
    return df.groupBy(*keys).agg(F.count_if(flag).alias("n"))


def distinct_per_group(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Number of different values per group, null counted as a value."""
    return df.groupBy(*keys).agg(
        *[
            (F.count_distinct(c) + F.max(F.when(F.col(c).isNull(), 1).otherwise(0))).cast("long").alias(f"n_{c}")
            for c in columns
        ]
    )


def audit_counts(df: DataFrame, accepted: str = "accepted") -> DataFrame:
    """One row: how many rows were accepted and how many failed."""
    ok = F.coalesce(F.col(accepted), F.lit(False))
    return df.agg(F.count_if(ok).alias("successes"), F.count_if(~ok).alias("failures"))


def _corr(a: Column, b: Column) -> Column:
    """Pearson correlation, null where one side does not vary (the built-in one raises there in ANSI mode)."""
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.try_divide(F.covar_pop(a, b), spread)


# A pair whose spread is less than this part of its sum of squares does not vary; what is left is rounding.
NO_SPREAD = 1e-13
_SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy", "nans")


def _pair_sums(values: np.ndarray, present: np.ndarray) -> np.ndarray:
    """Sums over the rows in which both columns of a pair are present, as an array (sum, column, column)."""
    odd = np.isnan(values) & present
    x = np.where(present & ~odd, values, 0.0)
    there = present.astype(np.float64)
    sx, sxx, nans = x.T @ there, (x * x).T @ there, odd.astype(np.float64).T @ there
    return np.stack([there.T @ there, sx, sx.T, sxx, sxx.T, x.T @ x, nans + nans.T])


def _corr_gram(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """All pairs from matrix products: a task adds up k x k sums and gives one row per pair, which are summed again."""
    names = list(columns)
    k = len(names)
    upper = np.triu_indices(k, 1)
    # Sums are taken around the means, k numbers, so that large values with a small spread lose no digits.
    wide = df.select(F.array(*[c.cast("double") for c in columns.values()]).alias("v"))
    means = wide.agg(*[F.avg(F.when(~F.isnan(F.get("v", F.lit(i))), F.get("v", F.lit(i)))) for i in range(k)]).first()
    centre = np.array([0.0 if m is None or not np.isfinite(m) else m for m in means])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(_SUMS), k, k))
        for batch in batches:
            flat = batch.column("v").flatten()
            present = flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, k)
            values = flat.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, k) - centre
            total += _pair_sums(values, present)
        places = [pa.array(at.astype(np.int32)) for at in upper]
        yield pa.RecordBatch.from_arrays([*places, *[pa.array(t[upper]) for t in total]], ["i", "j", *_SUMS])

    sums = wide.mapInArrow(run, "i int, j int, " + ", ".join(f"{c} double" for c in _SUMS))
    sums = sums.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in _SUMS])
    xx, yy = (F.col(f"s{c}{c}") - F.try_divide(F.col(f"s{c}") * F.col(f"s{c}"), F.col("n")) for c in "xy")
    xy = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n"))
    varies = (xx > F.col("sxx") * NO_SPREAD) & (yy > F.col("syy") * NO_SPREAD)
    corr = F.when(F.col("nans") > 0, F.lit(float("nan"))).when(varies, xy / F.sqrt(xx * yy))
    listed = F.array(*[F.lit(n) for n in names])
    return sums.select(F.get(listed, F.col("i")).alias("col_a"), F.get(listed, F.col("j")).alias("col_b"), corr.alias("corr"))


def corr_pairs(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Pearson correlation of each pair of columns over the rows where both are present, in long form.

    Only the upper triangle is produced: ``col_a`` comes before ``col_b``. Few pairs are aggregates of one pass. Of many
    columns, tasks add up matrix products, so that neither the plan nor the rows grow with the number of pairs.
    """
    pairs = list(combinations(columns, 2))
    if len(pairs) > WIDE_PAIRS:
        return _corr_gram(df, columns)
    row = df.agg(*[_corr(columns[a], columns[b]).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    entries = [
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"_{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*entries)))
