"""Positions and running values in an order, safe when one group holds much of the data.

A window over a hot group would sort that group in one task. Here rows are cut into ranges of their order instead: Spark
samples the order columns, states cuts of about as many rows each, whatever the gaps between the values are, and sorts each
range in a task of its own. A row's partition is its chunk and its place there comes for nothing. One small row per chunk,
or per chunk and group, carries the result of the chunks before it. What the tasks made is written once, so that a row's
chunk cannot change between its uses.

How many ranges there are is up to the session's shuffle settings, as for any sort, or to the parameter ``parts``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedkit.operators.columns import unused
from feedkit.operators.skew import join_keys
from feedkit.session import written

# The place of a row in its partition is in the lower bits of ``monotonically_increasing_id``.
_PLACE_BITS = 33


def before(keys: Sequence[str], order: str):
    """All earlier chunks of the group."""
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def so_far(keys: Sequence[str], order: str):
    """All rows of the group up to this one."""
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def in_ranges(
    df: DataFrame,
    by: Sequence[Column | str],
    chunk: str,
    place: str,
    parts: int | None = None,
    write: Callable[[DataFrame], DataFrame] = written,
) -> DataFrame:
    """The rows, written in ranges of ``by``, with the number of their range and their 0-based place in it.

    Equal rows may stand in any order, but in one range; a last column that tells them apart lets them be cut. ``write`` writes
    the rows, for a caller that deletes them when it has made something else of them.
    """
    (at,) = unused([*df.columns, chunk, place], "_at")
    cut = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
    placed = write(cut.sortWithinPartitions(*by).withColumn(at, F.monotonically_increasing_id()))
    return placed.withColumns(
        {chunk: F.shiftright(at, _PLACE_BITS), place: F.col(at).bitwiseAND((1 << _PLACE_BITS) - 1)}
    ).drop(at)


def in_order(
    df: DataFrame,
    by: Sequence[Column | str],
    name: str,
    marked: Column | None = None,
    parts: int | None = None,
    write: Callable[[DataFrame], DataFrame] = written,
) -> tuple[DataFrame, DataFrame]:
    """The rows with their 1-based position in the order ``by``, and rows (chunk, n, marked) of the ranges.

    ``marked`` counts the rows of a range for which it is true. A column ``name`` is replaced.
    """
    chunk, place, of, base = unused([*df.columns, name], "_chunk", "_place", "_of", "_base")
    placed = in_ranges(df, by, chunk, place, parts, write)
    counts = placed.groupBy(F.col(chunk).alias("chunk")).agg(
        F.count(F.lit(1)).alias("n"),
        (F.count_if(marked) if marked is not None else F.lit(0).cast("long")).alias("marked"),
    )
    stood = F.coalesce(F.sum("n").over(before([], "chunk")), F.lit(0))
    offsets = counts.select(F.col("chunk").alias(of), stood.alias(base))
    # One small row per range. Without the hint Spark may shuffle all rows by their range to meet it.
    joined = placed.join(F.broadcast(offsets), F.col(chunk) == F.col(of))
    position = F.col(base) + F.col(place) + 1
    return joined.withColumn(name, position).select(*[c for c in df.columns if c != name], name), counts


def rank_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    rank: str = "rank",
    size: str | None = None,
    first_of: Mapping[str, str] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Adds the 1-based position of each row in its group, ordered by a unique column.

    ``size`` adds the number of rows of the group, ``first_of`` the group's first value of other columns
    (new name -> column). Rows with a null key belong to no group and are left out, as in a pandas group-by.

    Rows stand in ranges of (keys, order), so a group is a stretch of one range or goes on over several. Per group and range
    one row says where the stretch begins and how many rows of the group stand before it.
    """
    first_of = dict(first_of or {})
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    names = [*df.columns, rank, *([size] if size else []), *first_of]
    chunk, place, n, shift = unused(names, "_chunk", "_place", "_n", "_shift")
    placed = in_ranges(df, [*keys, order], chunk, place, parts)
    group = [*keys, chunk]
    stretches = placed.groupBy(*group).agg(
        F.count(F.lit(1)).alias(n), F.min(place).alias(shift), *[F.min_by(c, place).alias(k) for k, c in first_of.items()]
    )
    whole = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stretches = stretches.select(
        *group,
        (F.coalesce(F.sum(n).over(before(keys, chunk)), F.lit(0)) - F.col(shift) + 1).alias(shift),
        *([F.sum(n).over(whole).alias(size)] if size else []),
        *[F.first(k).over(whole).alias(k) for k in first_of],
    )
    joined = join_keys(placed, stretches, group, "inner")
    return joined.withColumn(rank, F.col(place) + F.col(shift)).drop(chunk, place, shift)


def last_so_far(
    df: DataFrame, keys: Sequence[str], order: str, value: str, name: str, parts: int | None = None
) -> DataFrame:
    """Adds the latest non-null ``value`` at or before each row of its group."""
    chunk, place, inside, carried = unused([*df.columns, name], "_chunk", "_place", "_inside", "_carried")
    placed = in_ranges(df, [*keys, order], chunk, place, parts)
    group = [*keys, chunk]
    chunks = placed.groupBy(*group).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(place))).alias(carried))
    earlier = chunks.select(*group, F.last(carried, ignorenulls=True).over(before(keys, chunk)).alias(carried))
    latest = F.last(value, ignorenulls=True).over(so_far(group, place))
    return (
        join_keys(placed.withColumn(inside, latest), earlier, group, "inner")
        .withColumn(name, F.coalesce(inside, carried))
        .drop(chunk, place, inside, carried)
    )


def number_rows(
    df: DataFrame,
    order: str,
    name: str,
    start: Column,
    parts: int | None = None,
    write: Callable[[DataFrame], DataFrame] = written,
) -> DataFrame:
    """Numbers all rows in the order of a unique column, from ``start`` + 1 on."""
    placed, _ = in_order(df, [order], name, parts=parts, write=write)
    return placed.withColumn(name, start + F.col(name))
