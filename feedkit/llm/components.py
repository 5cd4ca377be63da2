"""Connected components of a graph given by its edges, by alternating large and small stars.

Every round hangs neighbours on the smallest node of their neighbourhood. A component becomes a star after a number of
rounds that grows with the logarithm of its size; nothing but the two sums that tell the end comes to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.operators.skew import join_on
from feedkit.session import written


def _hung(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Edges from every node's neighbours to the smallest node of its neighbourhood.

    Large star: neighbours on both sides count and the larger ones are hung. Small star: only smaller neighbours count,
    and they and the node itself are hung. Edges point from the larger node (u) to the smaller one (v).
    """
    if larger_only:
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).withColumnRenamed("u", "c")
        hung = join_on(both.filter("v > u"), least, {"u": "c"}, "inner").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "c")
        joined = join_on(edges, least, {"u": "c"}, "inner")
        hung = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m")))
    return hung.filter("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str, write: Callable[[DataFrame], DataFrame] = written) -> DataFrame:
    """Rows (node, root): the smallest node of the component of every node that has an edge. Loops and nulls are nothing.

    ``write`` writes what a round has found, so that the next one starts from a table.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    now = write(now.filter("u <> v").distinct())
    before = None
    # The sums are of hashes, so that they change when the edges do.
    while (after := now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()) != before:
        before = after
        if not after[0]:
            break
        now = write(_hung(write(_hung(now, True)), False))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
