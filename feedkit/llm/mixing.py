"""Mixing sources to target weights by Pareto order sampling.

Documents of a source differ in how much they are wanted, by a preference of their own. A document's claim is its preference
times a level of its source, at most MOST_COPIES, and the level is such that the claims of the source add up to its target,
in words. The whole part of a claim is taken for certain, as so many copies. The
rest is an inclusion probability p: with a random u, documents are ranked by the odds of u divided by the odds of p, and
those of the smallest ranks are taken until the words that are still open are filled (Rosen's Pareto sampling of fixed size,
the size being words). Random numbers come from a hash, so runs agree.

No task ranks a whole source: words are summed per grade of preference, and per cell of the ranking variable; only the cell
in which the target falls is looked at again, as finer cells, until single documents are left to order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedkit.operators.columns import unused
from feedkit.operators.ordering import rank_in_group
from feedkit.operators.skew import join_on
from feedkit.session import written

WEIGHTS = (5, 2, 1)
# No document is taken more often.
MOST_COPIES = 3
SEED = 42
# Preferences are rounded down to this many steps per power of two, between these grades; documents of one grade and source
# have the same claim.
STEPS = 16
GRADES = 1 << 12
# Cells per level and source, and levels of cells before documents are ordered one by one.
CELLS = 1 << 11
LEVELS = 2


def targets(sizes: DataFrame) -> DataFrame:
    """Adds ``target`` to rows (source, source_size): shares by weight of all words, at most MOST_COPIES times the size.

    Weights repeat over the sources in the order of their code points, null last. What is cut off is shared among the
    others by weight until none is above its bound, which is water-filling: with sources in the order of bound over
    weight, a source is cut off if the level that fills all later ones lies above it. One row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    place = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (place + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(MOST_COPIES)))
    by_level = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    before, onward = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    in_order = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("total", F.sum("source_size").over(everything).cast("double"))
    spent = F.coalesce(F.sum("most").over(before), F.lit(0.0))
    rows = rows.withColumn("level", (F.col("total") - spent) / F.sum("weight").over(onward))
    # The first source that is not cut off states the level; before it all are.
    open_ = F.col("level") * F.col("weight") <= F.col("most")
    rows = rows.withColumn("open", open_).withColumn("fill", F.first(F.when(open_, F.col("level")), True).over(in_order))
    cut = F.col("fill").isNull() | (F.col("fill") * F.col("weight") > F.col("most"))
    return rows.withColumn("target", F.when(cut, F.col("most")).otherwise(F.col("fill") * F.col("weight"))).select(
        "source", "source_size", "target"
    )


def _odds(p: Column) -> Column:
    return p / (1 - p)


def _key(source: Column) -> Column:
    """Join key of a source; null has one as well."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def _grade(preference: Column) -> Column:
    """Grade of a preference; the lowest one is for documents that are not wanted at all (null, NaN, zero or less)."""
    wanted = (preference > 0) & ~F.isnan(preference)
    grade = F.greatest(F.least(F.floor(F.log2(preference) * STEPS), F.lit(GRADES - 1)), F.lit(1 - GRADES))
    return F.coalesce(F.when(wanted, grade), F.lit(-GRADES)).cast("int")


def claims(cells: DataFrame, sizes: DataFrame) -> DataFrame:
    """What each grade of each source is entitled to: rows (k, grade, source_size, target, whole, part, open).

    ``cells`` are rows (k, grade, n) with the words of a grade, ``sizes`` rows (k, source, source_size). From the highest
    grade down, grades that the level would lift over MOST_COPIES are cut off there, until the level that the others need
    no longer does so. ``open`` are the words of the source that whole copies leave. At most 2 * GRADES rows per source.
    """
    most = F.lit(float(MOST_COPIES))
    wanted = targets(sizes.select("source", "source_size"))
    wanted = wanted.select(_key(F.col("source")).alias("of"), "source_size", "target")
    rows = cells.join(wanted, F.col("k") == F.col("of")).drop("of")
    q = F.when(F.col("grade") > -GRADES, F.pow(F.lit(2.0), F.col("grade") / STEPS)).otherwise(F.lit(0.0))
    down = Window.partitionBy("k").orderBy(F.desc("grade"))
    spent = F.coalesce(F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * most
    rest = F.sum(F.col("n") * F.col("q")).over(down.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("q", q).withColumn("level", F.try_divide(F.col("target") - spent, rest))
    fits = F.col("level") * F.col("q") <= most
    everywhere = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("level", F.first(F.when(fits, F.col("level")), True).over(everywhere))
    claim = F.when(F.col("q") == 0, F.lit(0.0)).otherwise(F.least(most, F.coalesce(F.col("level") * F.col("q"), most)))
    claim = F.greatest(claim, F.lit(0.0))
    # Rounding may leave a claim just under a whole number.
    rows = rows.withColumn("whole", F.floor(claim + F.lit(1e-9)).cast("int"))
    rows = rows.withColumn("part", F.greatest(claim - F.col("whole"), F.lit(0.0)))
    given = F.sum(F.col("whole") * F.col("n")).over(Window.partitionBy("k"))
    rows = rows.withColumn("open", F.greatest(F.col("target") - given, F.lit(0.0)))
    return rows.select("k", "grade", "source_size", "target", "whole", "part", "open")


def by_length(size: str) -> Column:
    """A preference for longer documents that grows slowly with their size."""
    return F.log(F.lit(1.0) + F.greatest(F.col(size), F.lit(0)))


def mix(
    docs: DataFrame,
    size: str,
    source: str = "source",
    id_: str = "doc_id",
    text: str = "text",
    preference: str | None = None,
) -> DataFrame:
    """Adds source_size, target, copies and taken (words) to the documents; needs an integer column ``size``.

    ``preference`` names a numeric column: a document of twice the preference has twice the claim, up to MOST_COPIES. Without
    it, all documents of a source have the same claim. Documents without a preference over zero, and those of size 0, have no copies; a null
    size is 0. Null is a source of its own. Columns of the added names are replaced, others kept. Rows that repeat id, text
    and size have the same rank and are taken one by one, so any of them may be the last one taken.
    """
    added = ["source_size", "target", "copies", "taken"]
    kept = docs.drop(*added)
    names = ["k", "u", "n", "g", "of_k", "of_g", "whole", "part", "open", "v", "edge", "fill", "tied", "of_e", "h", "place"]
    k, u, n, g, of_k, of_g, whole, part, open_, v, edge, fill, tied, of_e, h, place = unused([*docs.columns, *added], *names)
    words = F.coalesce(F.col(size).cast("long"), F.lit(0).cast("long"))
    tie = F.xxhash64(F.col(id_), F.col(text), words, F.lit(SEED))
    random = (F.shiftrightunsigned(F.xxhash64(tie, F.lit(SEED)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    liked = F.col(preference).cast("double") if preference else F.lit(1.0)
    rows = kept.withColumns({k: _key(F.col(source).cast("string")), u: random, n: words, g: _grade(liked)})
    # One pass over the documents writes what all later steps but the last one need.
    narrow = written(
        rows.select(F.col(k).alias("k"), F.col(source).cast("string").alias("source"), F.col(u).alias("u"), F.col(n).alias("n"), F.col(g).alias("g"))
    )
    sizes = narrow.groupBy("k").agg(F.max("source").alias("source"), F.sum("n").alias("source_size"))
    cells = narrow.groupBy("k", F.col("g").alias("grade")).agg(F.sum("n").alias("n"))
    plan = written(claims(cells, sizes))
    known = {"k": of_k, "grade": of_g, "whole": whole, "part": part, "open": open_}
    ranked = _ranked(narrow, plan.withColumnsRenamed({"k": "of_k", "grade": "of_g"}), "k", "g", "u", "of_k", "of_g", "part", "v")
    edges = written(_edges(ranked.filter("n > 0 AND part > 0").select("k", "v", "n", "open")))
    rows = _ranked(rows, plan.withColumnsRenamed(known), k, g, u, of_k, of_g, part, v)
    rows = join_on(rows, edges.withColumnsRenamed({"k": of_e, "edge": edge, "fill": fill, "tied": tied}), {k: of_e})
    at = (F.col(part) > 0) & (F.col(n) > 0) & (F.col(v) == F.col(edge))
    more = (F.col(part) > 0) & F.coalesce((F.col(v) < F.col(edge)) | ((F.col(v) == F.col(edge)) & (F.col(fill) == F.col(tied))), F.lit(False))
    if not edges.filter("fill > 0 AND fill < tied").isEmpty():
        # Repeated rows of which some are taken: these alone are numbered, in ranges, so that no task numbers all of them.
        split = F.coalesce(at & (F.col(fill) > 0) & (F.col(fill) < F.col(tied)), F.lit(False))
        some = rows.filter(split).withColumn(h, F.monotonically_increasing_id())
        numbered = rank_in_group(some, [k], h, place).drop(h)
        rows = rows.filter(~split).withColumn(place, F.lit(None).cast("long")).unionByName(numbered)
        more = F.when(F.col(place).isNotNull(), F.col(place) <= F.col(fill)).otherwise(more)
    copies = F.when(F.col(n) > 0, F.coalesce(F.col(whole) + more.cast("int"), F.lit(0))).otherwise(F.lit(0))
    return rows.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col(n)).select(*kept.columns, *added)


def _ranked(
    rows: DataFrame, plan: DataFrame, k: str, g: str, u: str, of_k: str, of_g: str, part: str, v: str
) -> DataFrame:
    """Adds the plan of the source and grade, and the ranking variable, the Pareto odds mapped to 0..1."""
    rows = join_on(rows, plan, {k: of_k, g: of_g})
    odds = _odds(F.col(u)) / _odds(F.least(F.greatest(F.col(part), F.lit(1e-12)), F.lit(1 - 1e-12)))
    return rows.withColumn(v, odds / (1 + odds))


def _edges(rows: DataFrame) -> DataFrame:
    """Per source the rank up to which documents are taken: rows (k, edge, fill, tied).

    All documents below ``edge`` are taken, and ``fill`` of the ``tied`` ones that stand at it: those words come nearest to
    what is open. Documents of one rank have one size.
    """
    width = 1.0
    cells = rows.withColumn("from", F.lit(0.0)).withColumn("left", F.col("open"))
    for _ in range(LEVELS):
        width /= CELLS
        cells = cells.withColumn("cell", F.least(F.floor((F.col("v") - F.col("from")) / width), F.lit(CELLS - 1)))
        sums = cells.groupBy("k", "cell").agg(F.sum("n").alias("n"), F.first("from").alias("f"), F.first("left").alias("l"))
        upto = F.sum("n").over(Window.partitionBy("k").orderBy("cell"))
        # The cell in which the target falls: the first whose words reach it, or the last there is.
        sums = sums.withColumn("upto", upto).withColumn("reach", F.col("upto") >= F.col("l"))
        sums = sums.withColumn("last", F.col("cell") == F.max("cell").over(Window.partitionBy("k")))
        first = (F.col("upto") - F.col("n") < F.col("l")) & F.col("reach")
        at = sums.filter(first | (F.col("last") & ~F.col("reach")) | (F.col("l") <= 0) & (F.col("upto") == F.col("n")))
        at = at.select(
            F.col("k").alias("of_k"),
            F.col("cell").alias("of_cell"),
            (F.col("f") + F.col("cell") * width).alias("begin"),
            (F.col("l") - (F.col("upto") - F.col("n"))).alias("more"),
        )
        cells = join_on(cells.drop("from", "left"), written(at), {"k": "of_k", "cell": "of_cell"}, "inner")
        cells = cells.withColumnsRenamed({"begin": "from", "more": "left"})
    # Repeated rows are one row from here on.
    ranks = cells.groupBy("k", "v").agg(F.count(F.lit(1)).alias("tied"), F.max("n").alias("each"), F.first("left").alias("left"))
    order = Window.partitionBy("k").orderBy("v")
    before = F.coalesce(F.sum(F.col("tied") * F.col("each")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # Taking a document in which the target falls is right if that comes nearer to it than leaving it out.
    fill = F.floor((F.col("left") - F.col("before")) / F.col("each") + F.lit(0.5))
    ranks = ranks.withColumn("before", before).withColumn("fill", F.least(F.greatest(fill, F.lit(0)), F.col("tied")))
    # The last rank of which something is taken, or the first one, of which nothing is.
    last = F.struct(F.col("fill") > 0, F.when(F.col("fill") > 0, F.col("v")).otherwise(-F.col("v")))
    picked = ranks.groupBy("k").agg(F.max_by(F.struct("v", "fill", "tied"), last).alias("at"))
    return picked.select("k", F.col("at.v").alias("edge"), F.col("at.fill").alias("fill"), F.col("at.tied").alias("tied"))
