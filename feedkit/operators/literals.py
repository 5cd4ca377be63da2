"""Groups written as list, dict and matrix expressions.

One expression per group would gather a whole group in one cell. Expressions come in pieces instead: rows
``(keys…, part, text)`` whose texts, joined in the order of ``part``, are the expression. A group of up to
``part_size`` rows is one piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.functions.scalars import is_number
from feedkit.operators.ordering import rank_in_group

PART_SIZE = 10_000


def _text(c: Column, decider: Column, plain: bool = False) -> Column:
    """A value as text, quoted unless the deciding first value reads as a number or quoting is off."""
    shown = F.coalesce(c.cast("string"), F.lit(""))
    if plain:
        return shown
    return F.when(F.coalesce(is_number(decider.cast("string")), F.lit(False)), shown).otherwise(
        F.concat(F.lit("'"), shown, F.lit("'"))
    )


def _pieces(ranked: DataFrame, keys: Sequence[str], element: Column, open_: Column, close: str, part_size: int):
    """Elements of ranked rows joined into pieces; the first piece opens the expression, the last one closes it."""
    rows = ranked.select(
        *keys,
        F.expr(f"(_rank - 1) div {part_size}").alias("part"),
        (F.col("_rank") == 1).alias("_first"),
        (F.col("_rank") == F.col("_size")).alias("_last"),
        F.struct(F.col("_rank").alias("r"), element.alias("t")).alias("_e"),
        open_.alias("_open"),
    )
    parts = rows.groupBy(*keys, "part").agg(
        F.bool_or("_first").alias("_first"),
        F.bool_or("_last").alias("_last"),
        F.any_value("_open").alias("_open"),
        F.sort_array(F.collect_list("_e")).alias("_es"),
    )
    body = F.array_join(F.transform("_es", lambda e: e["t"]), ", ")
    return parts.select(
        *keys,
        "part",
        F.concat(
            F.when(F.col("_first"), F.col("_open")).otherwise(F.lit("")),
            body,
            F.when(F.col("_last"), F.lit(close)).otherwise(F.lit(", ")),
        ).alias("text"),
    )


def _ranked(df: DataFrame, keys: Sequence[str], order: str, first_of: dict[str, str], parts: int | None) -> DataFrame:
    return rank_in_group(df, keys, order, "_rank", "_size", first_of, parts)


def list_literal(
    df: DataFrame, keys: Sequence[str], order: str, value: str, plain: bool = False, part_size: int = PART_SIZE,
    parts: int | None = None,
) -> DataFrame:
    """``[a, b]`` per group; the group's first value decides whether values are quoted."""
    ranked = _ranked(df.select(*keys, order, value), keys, order, {"_v": value}, parts)
    return _pieces(ranked, keys, _text(F.col(value), F.col("_v"), plain), F.lit("["), "]", part_size)


def dict_literal(
    df: DataFrame, keys: Sequence[str], order: str, key: str, value: str, plain_keys: bool = False,
    plain_values: bool = False, part_size: int = PART_SIZE, parts: int | None = None,
) -> DataFrame:
    """``{k:v, …}`` per group."""
    columns = [*keys, order, *[c for c in dict.fromkeys((key, value)) if c not in (*keys, order)]]
    ranked = _ranked(df.select(*columns), keys, order, {"_k": key, "_v": value}, parts)
    element = F.concat(
        _text(F.col(key), F.col("_k"), plain_keys), F.lit(":"), _text(F.col(value), F.col("_v"), plain_values)
    )
    return _pieces(ranked, keys, element, F.lit("{"), "}", part_size)


def dict_maps(
    df: DataFrame, keys: Sequence[str], order: str, key: str, value: str, part_size: int = PART_SIZE, parts: int | None = None
) -> DataFrame:
    """Typed maps of each group in pieces (keys…, part, entries): a map from ``key`` to ``value`` as they are.

    Of a key that a group has twice the value of the last row counts, and the key stands where it came first, as in an
    ordered dictionary. Rows with a null key have no entry. A group of up to ``part_size`` keys is one map.
    """
    rows = df.filter(F.col(key).isNotNull()).select(*keys, F.col(order).alias("_o"), F.col(key).alias("_k"), F.col(value).alias("_v"))
    entries = rows.groupBy(*keys, "_k").agg(F.min("_o").alias("_o"), F.max_by("_v", "_o").alias("_v"))
    ranked = rank_in_group(entries, keys, "_o", "_rank", parts=parts)
    element = F.struct(F.col("_rank").alias("r"), F.col("_k").alias("k"), F.col("_v").alias("v"))
    pieces = ranked.groupBy(*keys, F.expr(f"(_rank - 1) div {part_size}").alias("part")).agg(
        F.sort_array(F.collect_list(element)).alias("_e")
    )
    made = F.map_from_arrays(F.transform("_e", lambda e: e["k"]), F.transform("_e", lambda e: e["v"]))
    return pieces.select(*keys, "part", made.alias("entries"))


def columns_literal(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], part_size: int = PART_SIZE,
    parts: int | None = None,
) -> DataFrame:
    """``{'col':[…], …}`` per group. Pieces are ordered by ``col_no`` and ``part``."""
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("col_no"), F.lit(c).alias("_name"), F.col(c).cast("string").alias("_value"))
            for i, c in enumerate(columns)
        ]
    )
    # The order column is kept under a name of its own, since it may also be one of the listed columns.
    long = df.select(*keys, F.col(order).alias("_order"), F.inline(cells))
    ranked = _ranked(long, [*keys, "col_no"], "_order", {"_v": "_value"}, parts)
    head = F.concat(
        F.when(F.col("col_no") == 0, F.lit("{'")).otherwise(F.lit(", '")), F.col("_name"), F.lit("':[")
    )
    pieces = _pieces(ranked, [*keys, "col_no"], _text(F.col("_value"), F.col("_v")), head, "]", part_size)
    last = (F.col("col_no") == len(columns) - 1) & F.col("text").endswith("]")
    # Only the closing piece of the last column ends the expression; its rows are marked by the closing bracket
    # of the list, which no inner piece has at its end (those end with a comma and a space).
    return pieces.withColumn("text", F.when(last, F.concat("text", F.lit("}"))).otherwise(F.col("text")))


def matrix_literal(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], plain: bool = False,
    part_size: int = PART_SIZE, parts: int | None = None,
) -> DataFrame:
    """``[[…], […]]`` per group, one inner list per row; the first cell of a row decides on its quotes."""
    cells = [_text(F.col(c), F.col(columns[0]), plain) for c in columns]
    row = F.concat(F.lit("["), F.concat_ws(", ", *cells), F.lit("]"))
    rows = df.select(*keys, F.col(order).alias("_order"), row.alias("_row"))
    ranked = _ranked(rows, keys, "_order", {}, parts)
    return _pieces(ranked, keys, F.col("_row"), F.lit("["), "]", part_size)


def id_lists(
    df: DataFrame, keys: Sequence[str], id_: str, part_size: int = PART_SIZE, parts: int | None = None
) -> DataFrame:
    """Ascending ids of each group as arrays ``ids``, in pieces of up to ``part_size`` ids."""
    ranked = rank_in_group(df.select(*keys, id_), keys, id_, "_rank", parts=parts)
    return ranked.groupBy(*keys, F.expr(f"(_rank - 1) div {part_size}").alias("part")).agg(
        F.sort_array(F.collect_list(id_)).alias("ids")
    )
