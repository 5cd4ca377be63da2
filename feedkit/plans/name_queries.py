"""Queries for name parsing, resolution and similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedkit.operators.joins import without_known_pairs
from feedkit.operators.names import FULL_NAME, full_name_of_abbrev, parse_names, resolve_abbrevs, resolve_best_names
from feedkit.operators.quality import MAX_LEVENSHTEIN
from feedkit.operators.similarity import nearest_names, similar_pairs
from feedkit.plans.registry import query
from feedkit.plans.views import table, with_views
from feedkit.sources import name_pairs

# All pairs, which the Spark side never forms.
SIMILAR_SQL = f"""SELECT a.name AS name1, b.name AS name2, CAST(levenshtein(a.name, b.name) AS INTEGER) AS dist
    FROM v_names a JOIN v_names b ON a.ord < b.ord WHERE levenshtein(a.name, b.name) < {MAX_LEVENSHTEIN}
    AND (a.name, b.name) NOT IN (SELECT (name1, name2) FROM v_similar UNION SELECT (name2, name1) FROM v_similar)"""


def similar_names(spark, sf):
    """Similar names that are not known to be different people."""
    pairs = similar_pairs(table(spark, sf, "v_names"), "name", "ord", MAX_LEVENSHTEIN)
    known = name_pairs(table(spark, sf, "v_similar"), "name1", "name2")
    return without_known_pairs(pairs, "name1", "name2", known)


@query("theta_similar_names", with_views(SIMILAR_SQL, "v_names", "v_similar"))
def _(spark, sf):
    return similar_names(spark, sf).orderBy("name1", "name2", ascending=[False, True])


@query("sort_name_desc", "SELECT p_name, p_partkey FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_name", "p_partkey").orderBy(F.desc("p_name"), "p_partkey")


@query(
    "similar_names_long",
    """WITH n AS (SELECT DISTINCT 'the ' || p_name || ' of ' || lower(p_brand) || ' made by hand' AS name FROM part)
       SELECT a.name AS name1, b.name AS name2, CAST(levenshtein(a.name, b.name) AS INTEGER) AS dist
       FROM n a JOIN n b ON a.name < b.name WHERE levenshtein(a.name, b.name) < 3""",
)
def _(spark, sf):
    part = table(spark, sf, "part")
    phrase = F.concat(F.lit("the "), F.col("p_name"), F.lit(" of "), F.lower("p_brand"), F.lit(" made by hand"))
    names = part.select(phrase.alias("name")).distinct().withColumn("ord", F.col("name"))
    return similar_pairs(names, "name", "ord", 3)


@query(
    "similar_names_template",
    """WITH n AS (SELECT DISTINCT concat('the account of ', substr(md5(c_name), 1, 6), ' with the wholesale house') AS name
                  FROM customer)
       SELECT a.name AS name1, b.name AS name2, CAST(levenshtein(a.name, b.name) AS INTEGER) AS dist
       FROM n a JOIN n b ON a.name < b.name WHERE levenshtein(a.name, b.name) < 3""",
)
def _(spark, sf):
    """Names of one template, as many as there are customers."""
    own = F.substring(F.md5("c_name"), 1, 6)
    phrase = F.concat(F.lit("the account of "), own, F.lit(" with the wholesale house"))
    names = table(spark, sf, "customer").select(phrase.alias("name")).distinct().withColumn("ord", F.col("name"))
    return similar_pairs(names, "name", "ord", 3)


_WORDS_SQL = "SELECT doc_id, unnest(string_split_regex(lower(text), '[^a-z]+')) AS word FROM documents"


@query(
    "nearest_word",
    f"""WITH w AS (SELECT word AS name, min(doc_id) AS ord FROM ({_WORDS_SQL}) WHERE word <> '' GROUP BY word),
        v AS (SELECT DISTINCT word AS value FROM ({_WORDS_SQL.replace('doc_id, ', '').replace('documents', 'benchmark')})
              WHERE word <> '' AND word NOT IN (SELECT name FROM w)),
        d AS (SELECT value, name, ord, CAST(levenshtein(value, name) AS INTEGER) AS dist FROM v CROSS JOIN w)
        SELECT value, arg_min(name, (dist, ord, name)) AS name, min(dist) AS dist FROM d GROUP BY value""",
)
def _(spark, sf):
    """For every word of the benchmark that no document holds: the nearest word of the documents, the earliest on a tie."""

    def words(name, *columns):
        split = F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")
        return table(spark, sf, name).select(split, *columns).filter("word <> ''")

    known = words("documents", "doc_id").groupBy(F.col("word").alias("name")).agg(F.min("doc_id").alias("ord"))
    unknown = words("benchmark").select(F.col("word").alias("value")).distinct()
    unknown = unknown.join(known, F.col("value") == F.col("name"), "left_anti")
    return nearest_names(unknown, "value", known)


@query(
    "parse_name",
    with_views(
        f"""SELECT DISTINCT trim(full_name) AS full_name,
                   nullif(regexp_extract(trim(full_name), '{FULL_NAME}', 1), '') AS first,
                   nullif(regexp_extract(trim(full_name), '{FULL_NAME}', 2), '') AS last,
                   nullif(regexp_extract(trim(full_name), '{FULL_NAME}', 4), '') AS suffix
            FROM v_variant WHERE regexp_matches(trim(full_name), '{FULL_NAME}')"""
    ),
)
def _(spark, sf):
    return parse_names(table(spark, sf, "v_variant"), "full_name").distinct()


_FITTING = """SELECT a.abbrev, min_by(p.name, p.ord) AS full_name FROM v_abbrev a JOIN v_people p
    ON substr(a.abbrev, 4) = split_part(p.name, ' ', 2) AND substr(a.abbrev, 1, 1) = substr(p.name, 1, 1)
    GROUP BY a.abbrev"""


@query(
    "join_abbrev_name",
    with_views(f"SELECT abbrev, full_name FROM v_abbrev LEFT JOIN ({_FITTING}) USING (abbrev)", "v_abbrev", "v_people"),
)
def _(spark, sf):
    return full_name_of_abbrev(table(spark, sf, "v_abbrev"), "abbrev", table(spark, sf, "v_people"))


@query(
    "join_nearest_name",
    with_views(
        f"""WITH fit AS ({_FITTING})
            SELECT abbrev, full_name, false AS by_distance FROM fit
            UNION ALL SELECT a.abbrev, arg_min(p.name, levenshtein(a.abbrev, p.name) * 100000000 + p.ord) AS full_name,
                   true AS by_distance
            FROM v_abbrev a CROSS JOIN v_people p WHERE a.abbrev NOT IN (SELECT abbrev FROM fit) GROUP BY a.abbrev""",
        "v_abbrev",
        "v_people",
    ),
)
def _(spark, sf):
    return resolve_abbrevs(table(spark, sf, "v_abbrev"), "abbrev", table(spark, sf, "v_people"))


@query(
    "resolve_best_name",
    with_views(
        f"""WITH p AS (SELECT full_name,
                nullif(regexp_extract(full_name, '{FULL_NAME}', 1), '') AS first,
                nullif(regexp_extract(full_name, '{FULL_NAME}', 2), '') AS last,
                nullif(regexp_extract(full_name, '{FULL_NAME}', 4), '') AS suffix FROM v_variant),
            kinds AS (SELECT *, CASE WHEN regexp_matches(first, '^[A-Z][A-Z]') THEN 1
                WHEN regexp_matches(first, '^[A-Z]\\.[A-Z]\\.') THEN 2 WHEN suffix IS NOT NULL THEN 3 ELSE 4 END AS kind
                FROM p WHERE first IS NOT NULL),
            alias AS (SELECT name AS value, nickname AS alias, min(ord) AS ord FROM v_nicknames GROUP BY name, nickname
                UNION ALL SELECT nickname, name, min(ord) FROM v_nicknames
                WHERE nickname NOT IN (SELECT name FROM v_nicknames) GROUP BY nickname, name),
            cand AS (
                SELECT full_name, 0 AS prio, CAST(0 AS BIGINT) AS sub, full_name AS cand FROM p
                UNION ALL SELECT full_name, 1, 0, first[1] || '.' || first[2] || '. ' || last FROM kinds WHERE kind = 1
                UNION ALL SELECT full_name, 2, 0, replace(first, '.', '') || ' ' || last FROM kinds WHERE kind = 2
                UNION ALL SELECT full_name, 3, 0, first || ' ' || last FROM kinds WHERE kind = 3
                UNION ALL SELECT full_name, 4, 0, replace(first, '''', '') || ' ' || last FROM kinds
                    WHERE kind = 4 AND contains(first, '''')
                UNION ALL SELECT full_name, 5, 0, first || ' ' || replace(last, '''', '') FROM kinds
                    WHERE kind = 4 AND contains(last, '''')
                UNION ALL SELECT full_name, 6, i, first || ' ' || split_part(last, '-', i::INTEGER) FROM kinds, range(1, 4) r(i)
                    WHERE kind = 4 AND contains(last, '-') AND split_part(last, '-', i::INTEGER) <> ''
                UNION ALL SELECT full_name, 7, a.ord, a.alias || ' ' || last FROM kinds JOIN alias a ON first = a.value
                    WHERE kind = 4),
            best AS (SELECT full_name, arg_min(cand, CAST(prio AS BIGINT) * 1000000000 + sub) AS best, min(prio) AS step FROM cand
                WHERE cand IN (SELECT name FROM v_universe) GROUP BY full_name)
            SELECT full_name, best, CAST(step AS INTEGER) AS step,
                CASE WHEN best IS NOT NULL THEN 'found' WHEN first IS NULL THEN 'unparsed' ELSE 'missing' END AS status
            FROM p LEFT JOIN best USING (full_name)"""
    ),
)
def _(spark, sf):
    lists = table(spark, sf, "v_universe"), table(spark, sf, "v_nicknames")
    return resolve_best_names(table(spark, sf, "v_variant"), "full_name", *lists)
