"""Nested spans from a log of start and end marks: depth, matching end, parent, duration.

An end mark closes the innermost open span. Depth is the running sum of +1 and -1, kept from falling below zero:
an end with nothing open is rejected and changes nothing. At one depth starts and ends alternate, so the k-th start
of a run at a depth is closed by the k-th end there, which makes the match an equality on (run, depth, k).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.operators.columns import unused
from feedkit.operators.ordering import before, in_ranges, last_so_far, rank_in_group, so_far
from feedkit.operators.skew import join_keys


def widen_ends(
    df: DataFrame, keys: Sequence[str], order: str, layers: str, into: str = "mark_no", parts: int | None = None
) -> DataFrame:
    """An end mark that closes n layers becomes n end marks, numbered in ``into``, the order of the wider log.

    The order column keeps its values, so that it may also be the time. A mark without layers is one mark.
    """
    chunk, place, copies, base, layer = unused([*df.columns, into], "_chunk", "_place", "_copies", "_base", "_layer")
    grown = df.withColumn(copies, F.greatest(F.coalesce(F.col(layers), F.lit(1)), F.lit(1)).cast("long"))
    placed = in_ranges(grown, [*keys, order], chunk, place, parts)
    group = [*keys, chunk]
    chunks = placed.groupBy(*group).agg(F.sum(copies).alias(base))
    chunks = chunks.select(*group, F.coalesce(F.sum(base).over(before(keys, chunk)), F.lit(0)).alias(base))
    # All copies of one mark stay together: they begin after those of the marks before it.
    inside = F.sum(copies).over(so_far(group, place)) - F.col(copies)
    started = join_keys(placed.withColumn(place, inside), chunks, group, "inner")
    wide = started.withColumn(layer, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return wide.withColumn(into, F.col(base) + F.col(place) + F.col(layer)).drop(chunk, place, copies, base, layer)


def span_depth(df: DataFrame, run: str, order: str, is_start: Column, parts: int | None = None) -> DataFrame:
    """Adds ``is_start``, ``depth`` (of the span that a mark opens or closes) and ``rejected`` to every mark."""
    names = [*df.columns, "is_start", "depth", "rejected"]
    chunk, place, total, low, base, floor = unused(names, "_chunk", "_place", "_sum", "_low", "_base", "_floor")
    step = F.when(F.col("is_start"), F.lit(1)).otherwise(F.lit(-1)).cast("long")
    marks = in_ranges(df.withColumn("is_start", is_start), [run, order], chunk, place, parts)
    group = [run, chunk]
    marks = marks.withColumn(total, F.sum(step).over(so_far(group, place)))
    # Lowest point of the chunk before this mark.
    marks = marks.withColumn(low, F.min(total).over(before(group, place)))
    # Per chunk: its total and its lowest point. Across chunks: where each one begins, and the lowest point so far.
    chunks = marks.groupBy(*group).agg(F.max_by(total, place).alias("_total"), F.min(total).alias("_lowest"))
    chunks = chunks.withColumn(base, F.coalesce(F.sum("_total").over(before([run], chunk)), F.lit(0)))
    chunks = chunks.withColumn(floor, F.min(F.col(base) + F.col("_lowest")).over(before([run], chunk)))
    chunks = chunks.select(*group, base, F.least(F.coalesce(floor, F.lit(0)), F.lit(0)).alias(floor))
    level = F.col(base) + F.col(total)
    # least skips nulls: the first mark of a chunk has no earlier point in it.
    lowest = F.least(F.col(floor), F.col(base) + F.col(low))
    height = (level - lowest + F.when(F.col("is_start"), 0).otherwise(1)).cast("int")
    return (
        join_keys(marks, chunks, group, "inner")
        .withColumn("rejected", level < lowest)
        .withColumn("depth", F.when(~F.col("rejected"), height))
        .drop(chunk, place, total, low, base, floor)
    )


def match_spans(
    df: DataFrame,
    run: str,
    order: str,
    time: str,
    is_start: Column,
    now: Column,
    carry: Sequence[str] = (),
    parts: int | None = None,
) -> DataFrame:
    """One row per span: ``start_at``, ``end_at`` (null while open) and ``seconds``, open spans measured to ``now``."""
    marks = span_depth(df, run, order, is_start, parts).filter(~F.col("rejected"))
    marks = rank_in_group(marks, [run, "depth", "is_start"], order, "_k", parts=parts)
    start = F.col("is_start")
    spans = marks.groupBy(run, "depth", "_k").agg(
        F.max(F.when(start, F.col(order))).alias(order),
        F.max(F.when(start, F.col(time))).alias("start_at"),
        F.max(F.when(~start, F.col(time))).alias("end_at"),
        *[F.max(F.when(start, F.col(c))).alias(c) for c in carry],
    )
    return spans.select(
        run,
        order,
        *carry,
        "depth",
        "start_at",
        "end_at",
        (F.coalesce("end_at", now) - F.col("start_at")).cast("double").alias("seconds"),
    )


def span_parents(df: DataFrame, run: str, order: str, is_start: Column, parts: int | None = None) -> DataFrame:
    """Every start with ``uid``, ``depth`` and ``pid``: the nearest earlier start still open, null at the top."""
    marks = span_depth(df, run, order, is_start, parts).filter("is_start").select(run, order, "depth")
    marks = rank_in_group(marks, [run], order, "uid", parts=parts)
    # Each start speaks at its own depth and asks at the depth above it.
    roles = F.array(
        F.struct(F.col("depth").alias("level"), F.col("uid").alias("said"), F.lit(False).alias("asks")),
        F.struct((F.col("depth") - 1).alias("level"), F.lit(None).cast("long").alias("said"), F.lit(True).alias("asks")),
    )
    asked = marks.select(run, order, "uid", "depth", F.inline(roles))
    answered = last_so_far(asked, [run, "level"], order, "said", "pid", parts)
    return answered.filter("asks").select(run, order, "uid", "depth", "pid")
