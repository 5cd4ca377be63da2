"""Queries for joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedkit.operators import joins as J
from feedkit.plans.registry import query
from feedkit.plans.views import table, with_views
from feedkit.sources import active_team_names, lookup_pairs, name_pairs

STARTERS = ["start1", "start2", "start3", "start4", "start5"]


def name_lists(spark, sf):
    """Conversions (the last listing wins), names known to be missing, and known names."""
    conversions = lookup_pairs(table(spark, sf, "v_conversions"), "old_name", "new_name", "ord")
    return conversions, table(spark, sf, "v_missing"), table(spark, sf, "v_known")


# The same lists in SQL, as common table expressions to put after the views.
LISTS_SQL = "conv AS (SELECT old_name, max_by(new_name, ord) AS new_name FROM v_conversions GROUP BY old_name)"


def _nations(spark, sf):
    nations = table(spark, sf, "nation").filter(F.col("n_regionkey").isin(0, 1, 2))
    return nations.select(F.col("n_nationkey").alias("old_name"), F.col("n_name").alias("new_name"))


@query(
    "join_map_lookup",
    """SELECT c_custkey, c_nationkey, n_name AS nation FROM customer
       LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey IN (0, 1, 2)""",
)
def _(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return J.map_values(customers, "c_nationkey", _nations(spark, sf), into="nation")


@query(
    "filter_mapped",
    """SELECT c_custkey, c_nationkey, n_name AS nation FROM customer
       JOIN nation ON c_nationkey = n_nationkey AND n_regionkey IN (0, 1, 2)""",
)
def _(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return J.mapped_only(customers, "c_nationkey", _nations(spark, sf), into="nation")


@query(
    "join_map_rejects",
    """SELECT c_custkey, c_nationkey, 'c_nationkey not in lookup: ' || c_nationkey AS reason FROM customer
       WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (0, 1, 2))""",
)
def _(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return J.unmapped(customers, "c_nationkey", _nations(spark, sf)).select("c_custkey", "c_nationkey", "reason")


@query(
    "join_fk_first",
    with_views(
        """SELECT p.id, p.gid, p.team, t.id AS found FROM v_player p
           LEFT JOIN (SELECT gid, team, min(id) AS id FROM v_pteam GROUP BY gid, team) t
           ON p.gid = t.gid AND p.team = t.team"""
    ),
)
def _(spark, sf):
    players = table(spark, sf, "v_player").select("id", "gid", "team")
    return J.link_first(players, table(spark, sf, "v_pteam"), ["gid", "team"], "id", "found")


@query(
    "join_semi_no_flag",
    with_views(
        """SELECT id, gid, team, player FROM v_player JOIN (
               SELECT gid, team FROM v_player GROUP BY gid, team HAVING count(*) FILTER (starter) = 0)
           USING (gid, team)"""
    ),
)
def _(spark, sf):
    rows = J.rows_without_flag(table(spark, sf, "v_player"), ["gid", "team"], "starter")
    return rows.select("id", "gid", "team", "player")


@query(
    "join_array_member",
    with_views(
        """SELECT p.id, p.gid, p.team, player FROM v_player p JOIN v_pteam t ON p.gid = t.gid AND p.team = t.team
           AND player IN (start1, start2, start3, start4, start5)"""
    ),
)
def _(spark, sf):
    players = table(spark, sf, "v_player").select("id", "gid", "team", "player")
    return J.listed_members(players, table(spark, sf, "v_pteam"), ["gid", "team"], "player", STARTERS)


_STATUS = """CASE WHEN c.old_name IS NOT NULL THEN 'converted' WHEN m.name IS NOT NULL THEN 'known missing'
                  WHEN k.name IS NOT NULL THEN 'known' ELSE 'unhandled' END"""
_LOOKED_UP = """FROM v_names n LEFT JOIN conv c ON n.name = c.old_name LEFT JOIN v_missing m ON n.name = m.name
                LEFT JOIN v_known k ON n.name = k.name"""


@query(
    "join_priority_lookup",
    with_views(
        f"""WITH {LISTS_SQL} SELECT n.name, n.ord, {_STATUS} AS status,
            CASE WHEN c.old_name IS NOT NULL THEN c.new_name
                 WHEN m.name IS NOT NULL OR k.name IS NOT NULL THEN n.name END AS clean {_LOOKED_UP}"""
    ),
)
def _(spark, sf):
    return J.resolve_names(table(spark, sf, "v_names"), "name", *name_lists(spark, sf))


MESSAGE_SQL = """CASE WHEN c.old_name IS NOT NULL THEN 'Should be ' || c.new_name || '.'
     WHEN m.name IS NOT NULL THEN 'Known to be missing from PStats.'
     WHEN k.name IS NOT NULL THEN 'In PStats.'
     ELSE 'Not in PStats, no associated name, and not known to be missing.' END"""


@query(
    "join_name_status",
    with_views(
        f"""WITH {LISTS_SQL} SELECT n.name, n.ord, {MESSAGE_SQL} AS info,
            {_STATUS} IN ('converted', 'unhandled') AS problematic {_LOOKED_UP}"""
    ),
)
def _(spark, sf):
    return J.name_status(table(spark, sf, "v_names"), "name", *name_lists(spark, sf))


@query(
    "keep_unhandled",
    with_views(
        f"""WITH {LISTS_SQL} SELECT p_partkey, coalesce(c.new_name, p_name) AS p_name
            FROM part LEFT JOIN conv c ON p_name = c.old_name"""
    ),
)
def _(spark, sf):
    return J.keep_unhandled(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", name_lists(spark, sf)[0])


@query(
    "anti_unhandled",
    with_views(
        """SELECT DISTINCT p_name FROM part WHERE p_name NOT IN (SELECT old_name FROM v_conversions)
           AND p_name NOT IN (SELECT name FROM v_missing) AND p_name NOT IN (SELECT name FROM v_known)"""
    ),
)
def _(spark, sf):
    return J.unhandled_names(table(spark, sf, "part"), "p_name", *name_lists(spark, sf))


@query(
    "extend_universe",
    with_views(
        """SELECT name FROM v_known UNION SELECT c_name AS name FROM customer WHERE c_acctbal > 0
           UNION SELECT c_mktsegment AS name FROM customer WHERE c_acctbal > 0"""
    ),
)
def _(spark, sf):
    teams = active_team_names(table(spark, sf, "customer"), F.col("c_acctbal") > 0, ["c_name", "c_mktsegment"])
    return J.extend_universe(table(spark, sf, "v_known"), teams)


@query(
    "anti_known_pairs",
    with_views(
        """SELECT DISTINCT p_name AS a, 'cold ' || split_part(p_name, ' ', 2) AS b FROM part
           WHERE (p_name, 'cold ' || split_part(p_name, ' ', 2)) NOT IN (
               SELECT (name1, name2) FROM v_similar UNION SELECT (name2, name1) FROM v_similar)"""
    ),
)
def _(spark, sf):
    other = F.concat(F.lit("cold "), F.split_part("p_name", F.lit(" "), F.lit(2)))
    pairs = table(spark, sf, "part").select(F.col("p_name").alias("a"), other.alias("b")).distinct()
    return J.without_known_pairs(pairs, "a", "b", name_pairs(table(spark, sf, "v_similar"), "name1", "name2"))


_ALIAS_VALUES = "SELECT p_brand AS v FROM part UNION SELECT p_type AS v FROM part UNION SELECT p_name AS v FROM part"


def _alias_values(spark, sf):
    part = table(spark, sf, "part")
    return part.select(F.explode(F.array("p_brand", "p_type", "p_name")).alias("v")).distinct()


@query(
    "join_alias",
    with_views(
        f"""WITH vals AS ({_ALIAS_VALUES}), pairs AS (
            SELECT name AS v, nickname AS alias FROM v_parts_nick UNION
            SELECT nickname AS v, name AS alias FROM v_parts_nick
            WHERE nickname NOT IN (SELECT name FROM v_parts_nick))
            SELECT v, alias FROM vals LEFT JOIN pairs USING (v)"""
    ),
)
def _(spark, sf):
    return J.aliases_of(_alias_values(spark, sf), "v", table(spark, sf, "v_parts_nick"))


@query(
    "semi_has_alias",
    with_views(
        f"""WITH vals AS ({_ALIAS_VALUES}) SELECT v FROM vals
            WHERE v IN (SELECT name FROM v_parts_nick) OR v IN (SELECT nickname FROM v_parts_nick)"""
    ),
)
def _(spark, sf):
    return J.has_alias(_alias_values(spark, sf), "v", table(spark, sf, "v_parts_nick"))


@query(
    "join_opponent_rows",
    with_views(
        """WITH g AS (SELECT gd, team, min(opp) AS opp, count(*) AS n, min_by(gid, id) AS first_gid
                      FROM v_player GROUP BY gd, team)
           SELECT a.gd, a.team, a.opp, a.n, a.first_gid, b.n AS opp_n, b.first_gid AS opp_first_gid
           FROM g a LEFT JOIN g b ON a.gd = b.gd AND a.opp = b.team"""
    ),
)
def _(spark, sf):
    groups = (
        table(spark, sf, "v_player")
        .groupBy("gd", "team")
        .agg(F.min("opp").alias("opp"), F.count(F.lit(1)).alias("n"), F.min_by("gid", "id").alias("first_gid"))
    )
    return J.opposing_groups(groups, ["gd", "team"], "opp", ["n", "first_gid"])


@query(
    "join_exists_count",
    with_views(
        """SELECT p.id, p.tsid, coalesce(t.n, 0) AS n_parents FROM v_player p
           LEFT JOIN (SELECT id, count(*) AS n FROM v_pteam GROUP BY id) t ON p.tsid = t.id"""
    ),
)
def _(spark, sf):
    players = table(spark, sf, "v_player").select("id", "tsid")
    return J.count_parents(players, "tsid", table(spark, sf, "v_pteam"), "id")
