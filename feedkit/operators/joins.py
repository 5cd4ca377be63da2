"""Joins against lookups and parent tables.

No side is forced into a broadcast. Spark broadcasts a side whose size, estimated from its files or measured at run
time, is under ``spark.sql.autoBroadcastJoinThreshold``; larger sides are shuffled, and adaptive execution splits the
partitions of hot keys (see ``skew``). Right sides are reduced to one row per key first, so no join multiplies rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.errors import MissingLinks, UnhandledName
from feedkit.operators.skew import join_keys, join_on


def map_values(df: DataFrame, column: str, lookup: DataFrame, into: str | None = None) -> DataFrame:
    """Values mapped through a lookup (``old_name``, ``new_name``), null where not listed."""
    into = into or column
    pairs = lookup.select(F.col("old_name").alias("_old"), F.col("new_name").alias("_new"))
    return join_on(df, pairs, {column: "_old"}).withColumn(into, F.col("_new")).drop("_new")


def mapped_only(df: DataFrame, column: str, lookup: DataFrame, into: str) -> DataFrame:
    """Only the rows whose value the lookup lists, with what it is mapped to."""
    pairs = lookup.select(F.col("old_name").alias("_old"), F.col("new_name").alias(into))
    return join_on(df, pairs, {column: "_old"}, "inner")


def unmapped(df: DataFrame, column: str, lookup: DataFrame) -> DataFrame:
    """Rows whose value the lookup does not list, with the reason."""
    return join_on(df, lookup, {column: "old_name"}, "left_anti").withColumn(
        "reason", F.concat(F.lit(f"{column} not in lookup: "), F.coalesce(F.col(column).cast("string"), F.lit("null")))
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """First row per key in the given order, as one aggregation with a map-side part."""
    return df.groupBy(*keys).agg(*[F.min_by(v, order).alias(v) for v in values])


def link_first(
    child: DataFrame,
    parent: DataFrame,
    keys: Sequence[str],
    parent_id: str,
    into: str,
    strict: bool = False,
    order: str | None = None,
) -> DataFrame:
    """Adds the id of the first parent row with the same keys, in the given order (by id if none is given).

    Strict mode stops at any row without a parent and names up to ten of the keys.
    """
    parents = parent.groupBy(*keys).agg(F.min_by(parent_id, order or parent_id).alias(into))
    if strict:
        lost = join_keys(child.select(*keys).distinct(), parents, keys, "left_anti").limit(10).collect()
        if lost:
            raise MissingLinks("no parent row for: " + "; ".join(str(tuple(r)) for r in lost))
    return join_keys(child, parents, keys)


def groups_without_flag(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Key combinations in which no row has the flag set. A null flag is not set; null keys form no group."""
    groups = df.dropna("any", subset=list(keys)).groupBy(*keys).agg(F.count_if(F.col(flag)).alias("_set"))
    return groups.filter("_set = 0").drop("_set")


def rows_without_flag(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Rows of the groups in which no row has the flag set."""
    return join_keys(df, groups_without_flag(df, keys, flag), keys, "left_semi")


def listed_members(
    df: DataFrame, parent: DataFrame, keys: Sequence[str], member: str, slots: Sequence[str]
) -> DataFrame:
    """Rows whose member is named in one of the slot columns of the parent row.

    The slots become rows, so the join is on (keys, member) and a large group spreads over many tasks.
    """
    named = (
        parent.select(*keys, F.explode(F.array(*[F.col(s) for s in slots])).alias(member))
        .filter(F.col(member).isNotNull())
        .distinct()
    )
    return join_keys(df, named, [*keys, member], "left_semi")


def resolve_names(
    df: DataFrame, name: str, conversions: DataFrame, missing: DataFrame, known: DataFrame, strict: bool = False
) -> DataFrame:
    """Adds ``clean`` and ``status``: converted, known missing, known, or unhandled (clean is null).

    Strict mode stops if a name is unhandled, and names up to ten of them.
    """
    joined = _with_lists(df, name, conversions, missing, known)
    if strict and (lost := joined.filter(_status() == "unhandled").select(name).distinct().orderBy(name).take(10)):
        raise UnhandledName(f"names that no list knows: {[r[0] for r in lost]}")
    return joined.select(
        *df.columns,
        F.when(F.col("_new").isNotNull(), F.col("_new"))
        .when(F.col("_missing") | F.col("_known"), F.col(name))
        .alias("clean"),
        _status().alias("status"),
    )


def keep_unhandled(df: DataFrame, name: str, conversions: DataFrame) -> DataFrame:
    """The name column resolved in place. Only a converted name changes: known, missing and unhandled ones stay."""
    mapped = map_values(df, name, conversions, into="_clean")
    return mapped.withColumn(name, F.coalesce("_clean", name)).drop("_clean")


def name_status(df: DataFrame, name: str, conversions: DataFrame, missing: DataFrame, known: DataFrame) -> DataFrame:
    """Adds ``problematic`` and ``info``, the message that explains it."""
    status = F.col("_status")
    joined = _with_lists(df, name, conversions, missing, known).withColumn("_status", _status())
    # The four messages.
    return joined.select(
        *df.columns,
        status.isin("converted", "unhandled").alias("problematic"),
        F.when(status == "converted", F.concat(F.lit("Should be "), F.col("_new"), F.lit(".")))
        .when(status == "known missing", "Known to be missing from PStats.")
        .when(status == "known", "In PStats.")
        .otherwise("Not in PStats, no associated name, and not known to be missing.")
        .alias("info"),
    )


def _status() -> Column:
    return (
        F.when(F.col("_new").isNotNull(), "converted")
        .when(F.col("_missing"), "known missing")
        .when(F.col("_known"), "known")
        .otherwise("unhandled")
    )


def _with_lists(df: DataFrame, name: str, conversions: DataFrame, missing: DataFrame, known: DataFrame) -> DataFrame:
    """The rows with what the three lists say about their name, from one join against the lists put together."""
    def entry(new: Column, is_missing: bool, is_known: bool) -> list[Column]:
        return [new.alias("_new"), F.lit(is_missing).alias("_missing"), F.lit(is_known).alias("_known")]

    nothing = F.lit(None).cast("string")
    lists = (
        conversions.select(F.col("old_name").alias("_name"), *entry(F.col("new_name"), False, False))
        .unionByName(missing.select(F.col("name").alias("_name"), *entry(nothing, True, False)))
        .unionByName(known.select(F.col("name").alias("_name"), *entry(nothing, False, True)))
        .groupBy("_name")
        .agg(F.max("_new").alias("_new"), F.bool_or("_missing").alias("_missing"), F.bool_or("_known").alias("_known"))
    )
    return join_on(df, lists, {name: "_name"}).withColumns(
        {c: F.coalesce(c, F.lit(False)) for c in ("_missing", "_known")}
    )


def unhandled_names(df: DataFrame, name: str, conversions: DataFrame, missing: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct names found in none of the lists."""
    listed = conversions.select(F.col("old_name").alias(name)).unionByName(
        missing.unionByName(known).select(F.col("name").alias(name))
    )
    return df.select(name).distinct().join(listed, name, "left_anti")


def extend_universe(known: DataFrame, extra: DataFrame) -> DataFrame:
    """Known names together with further accepted names, each once."""
    return known.unionByName(extra).distinct()


def aliases_of(df: DataFrame, value: str, nicknames: DataFrame) -> DataFrame:
    """One row per value and alias (null where there is none).

    A regular name gives its nicknames; a value that is only a nickname gives its names. Aliases stay rows, so a
    value with very many of them is never gathered in one cell.
    """
    both = alias_rows(nicknames).select(F.col("value").alias("_value"), "alias")
    return join_on(df, both, {value: "_value"})


def alias_rows(nicknames: DataFrame) -> DataFrame:
    """(``value``, ``alias``, ``ord``) for each value that has aliases, the name side winning.

    ``nicknames`` holds ``name``, ``nickname`` and an order column ``ord``.
    """
    names = nicknames.select("name").distinct()
    forward = nicknames.select(F.col("name").alias("value"), F.col("nickname").alias("alias"), "ord")
    back = nicknames.select(F.col("nickname").alias("value"), F.col("name").alias("alias"), "ord")
    only_nick = back.join(names.withColumnRenamed("name", "value"), "value", "left_anti")
    return forward.unionByName(only_nick).groupBy("value", "alias").agg(F.min("ord").alias("ord"))


def has_alias(df: DataFrame, value: str, nicknames: DataFrame) -> DataFrame:
    """Rows whose value is a name or a nickname."""
    listed = nicknames.select(F.explode(F.array("name", "nickname")).alias("_value")).distinct()
    return join_on(df, listed, {value: "_value"}, "left_semi")


def without_known_pairs(pairs: DataFrame, a: str, b: str, known: DataFrame) -> DataFrame:
    """Pairs not listed as known, in either order."""
    return pairs.join(
        known, (F.least(a, b) == F.col("name_lo")) & (F.greatest(a, b) == F.col("name_hi")), "left_anti"
    )


def opposing_groups(
    groups: DataFrame, keys: Sequence[str], other: str, values: Sequence[str], prefix: str = "opp_"
) -> DataFrame:
    """Per-group rows with the values of the group they face: same first key, ``other`` equal to the second key.

    The groups are computed twice, once per side of the join; write them first if that is dear.
    """
    common, own = keys
    facing = groups.select(
        F.col(common).alias("_common"), F.col(own).alias("_own"), *[F.col(v).alias(prefix + v) for v in values]
    )
    return join_on(groups, facing, {common: "_common", other: "_own"})


def count_parents(child: DataFrame, link: str, parent: DataFrame, parent_id: str, into: str = "n_parents") -> DataFrame:
    """Adds how many parent rows have the id that a row points at; zero for a null link."""
    counts = parent.groupBy(F.col(parent_id).alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    return join_on(child, counts, {link: "_id"}).withColumn(into, F.coalesce("_n", F.lit(0)).cast("long")).drop("_n")
