"""Name parsing and resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.functions.scalars import abbrev_initial, abbrev_last
from feedkit.operators.joins import alias_rows
from feedkit.operators.similarity import nearest_names
from feedkit.operators.skew import join_on

# Patterns of a full name (first, last, optional suffix) and of initials used as a first name.
FULL_NAME = r"^(.+?)\s([^\s,]+)(,?\s([JS]r\.?|III?|IV|V))?$"
# White space is that of Unicode.
UNICODE = "(?U)"
INITIALS_DOTTED = r"^[A-Z]\.[A-Z]\."
INITIALS_PLAIN = r"^[A-Z][A-Z]"


def name_parts(c: Column) -> dict[str, Column]:
    """``first``, ``last`` and ``suffix`` of a full name; all null where it has no such form."""
    return {
        part: F.nullif(F.regexp_extract(c, UNICODE + FULL_NAME, group), F.lit(""))
        for part, group in (("first", 1), ("last", 2), ("suffix", 4))
    }


def parse_names(df: DataFrame, name: str) -> DataFrame:
    """Stripped name with its parts; names without the form of a full name are skipped."""
    stripped = df.withColumn(name, F.regexp_replace(F.col(name), UNICODE + r"^\s+|\s+$", ""))
    return stripped.filter(F.col(name).rlike(UNICODE + FULL_NAME)).withColumns(name_parts(F.col(name)))


def full_name_of_abbrev(df: DataFrame, abbrev: str, universe: DataFrame) -> DataFrame:
    """Adds ``full_name`` for names such as ``J. Smith``, null where initial and last name fit nobody.

    ``universe`` holds ``name`` and its order ``ord``; the first fitting name wins.
    """
    people = parse_names(universe, "name").groupBy(F.col("last").alias("_last"), F.substring("first", 1, 1).alias("_i"))
    first = people.agg(F.min_by("name", "ord").alias("full_name"))
    split = df.withColumns({"_al": abbrev_last(F.col(abbrev)), "_ai": abbrev_initial(F.col(abbrev))})
    return join_on(split, first, {"_al": "_last", "_ai": "_i"}).drop("_al", "_ai")


def resolve_abbrevs(df: DataFrame, abbrev: str, universe: DataFrame) -> DataFrame:
    """Each different abbreviation with ``full_name`` and ``by_distance``.

    Where initial and last name fit nobody, the name with the smallest edit distance is taken and flagged.
    """
    tried = full_name_of_abbrev(df.select(abbrev).distinct(), abbrev, universe)
    hit = tried.filter(F.col("full_name").isNotNull()).withColumn("by_distance", F.lit(False))
    open_ = tried.filter(F.col("full_name").isNull()).select(abbrev)
    near = nearest_names(open_, abbrev, universe).select(
        abbrev, F.col("name").alias("full_name"), F.lit(True).alias("by_distance")
    )
    return hit.unionByName(near)


def _candidates(name: Column, first: Column, last: Column, suffix: Column) -> Column:
    """Spellings to look up, as ``(prio, sub, cand, alias_of)``, in the order in which they are tried; null where not tried.

    Initials and a suffix settle the matter: if their own spelling is unknown nothing else is tried.
    """

    def join(f: Column, rest: Column) -> Column:
        return F.concat(f, F.lit(" "), rest)

    def bare(c: Column) -> Column:
        return F.replace(c, F.lit("'"), F.lit(""))

    plain, dotted = first.rlike(INITIALS_PLAIN), first.rlike(INITIALS_DOTTED)
    loose = ~plain & ~dotted & suffix.isNull()
    with_dots = F.concat(F.substring(first, 1, 1), F.lit("."), F.substring(first, 2, 1), F.lit("."))
    tried = [
        name,
        F.when(plain, join(with_dots, last)),
        F.when(~plain & dotted, join(F.replace(first, F.lit("."), F.lit("")), last)),
        F.when(~plain & ~dotted & suffix.isNotNull(), join(first, last)),
        F.when(loose & first.contains("'"), join(bare(first), last)),
        F.when(loose & last.contains("'"), join(first, bare(last))),
    ]
    # The hyphenated parts are alternatives of the same step, in their own order.
    parts = F.when(loose & last.contains("-"), F.split(last, "-"))

    nothing = F.lit(None).cast("string")

    def entry(prio: Column, sub: Column, cand: Column, alias_of: Column = nothing) -> Column:
        return F.struct(
            prio.alias("prio"), sub.cast("long").alias("sub"), cand.alias("cand"), alias_of.alias("alias_of")
        )

    single = F.transform(F.array(*tried), lambda c, i: entry(i, F.lit(0), c))
    several = F.transform(F.coalesce(parts, F.array().cast("array<string>")), lambda c, i: entry(F.lit(6), i, join(first, c)))
    # The last name alone, to be put after each alias of the first name.
    aliased = F.array(entry(F.lit(7), F.lit(0), F.when(loose, last), first))
    return F.concat(single, several, aliased)


def resolve_best_names(df: DataFrame, name: str, universe: DataFrame, nicknames: DataFrame) -> DataFrame:
    """Each different name with ``best``, the ``step`` that found it and ``status`` (found, missing, unparsed).

    Steps: 0 the name itself, 1 plain initials dotted, 2 dotted initials plain, 3 without suffix, 4 and 5 without
    apostrophes in the first or last name, 6 a part of a hyphenated last name, 7 an alias of the first name. Every
    spelling is one row looked up by an equality join; the earliest known spelling wins. ``nicknames`` has ``name``,
    ``nickname`` and ``ord``.
    """
    parts = name_parts(F.col(name))
    wanted = df.select(name).filter(F.col(name).isNotNull()).distinct().withColumns({f"_{k}": c for k, c in parts.items()})
    first, last, suffix = F.col("_first"), F.col("_last"), F.col("_suffix")
    spelled = wanted.select(
        name, first.isNotNull().alias("parsed"), F.inline(_candidates(F.col(name), first, last, suffix))
    ).filter("cand is not null")
    ready = spelled.filter("prio < 7").drop("alias_of")
    aliased = (
        spelled.filter("prio = 7")
        .join(alias_rows(nicknames), F.col("alias_of") == F.col("value"))
        .select(name, "parsed", "prio", F.col("ord").cast("long").alias("sub"), F.concat_ws(" ", "alias", "cand").alias("cand"))
    )
    known = universe.select(F.col("name").alias("_cand")).distinct().withColumn("_known", F.lit(True))
    # Every name has a row of its own spelling, so one aggregation also tells which names were not found.
    place = F.when(F.col("_known"), F.struct("prio", "sub", "cand"))
    best = (
        join_on(ready.unionByName(aliased), known, {"cand": "_cand"})
        .groupBy(name)
        .agg(F.min(place).alias("_best"), F.bool_or("parsed").alias("_parsed"))
    )
    found = F.col("_best")
    status = F.when(found.isNotNull(), "found").when(~F.col("_parsed"), "unparsed").otherwise("missing")
    return best.select(name, found["cand"].alias("best"), found["prio"].alias("step"), status.alias("status"))
