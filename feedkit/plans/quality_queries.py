"""Queries for the integrity rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedkit.operators import quality as Q
from feedkit.plans.join_queries import LISTS_SQL, MESSAGE_SQL, name_lists
from feedkit.plans.name_queries import SIMILAR_SQL, similar_names
from feedkit.plans.registry import query
from feedkit.plans.views import table, with_views
from feedkit.sources import write_named
from feedkit.session import fresh_path

MIN_ROWS, STARTERS = 3, 1

GAMES_SQL = """SELECT 'TStats' AS "table", 'gid = ' || gid AS id, info FROM (
    SELECT gid, CASE
        WHEN count(*) <> 2 THEN 'Row count != 2'
        WHEN count(gd) < 2 OR min(gd) <> max(gd) THEN 'gd count != 1'
        WHEN min_by(coalesce(team, '~'), id) <> max_by(coalesce(opp, '~'), id)
          OR max_by(coalesce(team, '~'), id) <> min_by(coalesce(opp, '~'), id) THEN 'opp/team mismatch'
        WHEN count(*) FILTER (home) = 2 THEN '2 home teams'
        WHEN count(*) FILTER (home) = 0 THEN '2 away teams'
        WHEN count(ot) < 2 OR min(ot) <> max(ot) THEN 'OT periods different'
        WHEN count(open_spread) < 2 OR min_by(open_spread, id) <> -max_by(open_spread, id)
          THEN 'open_spread not negative versions of each other'
        WHEN max(abs(open_spread)) > 25 THEN 'open_spread > MAX_OPEN_SPREAD'
        WHEN count(open_pts) < 2 OR min(open_pts) <> max(open_pts) THEN 'open_pts different'
        WHEN max(open_pts) > 250 OR min(open_pts) < 150 THEN 'open_pts outside boundaries' END AS info
    FROM v_team GROUP BY gid) WHERE info IS NOT NULL"""

PLAYERS_SQL = f"""SELECT CASE WHEN info LIKE 'TStats%' THEN 'TStats' ELSE 'PStats' END AS "table",
    'gd/team grp (' || strftime(gd, '%Y%m%d') || '/' || team || ')' AS id, info FROM (
    SELECT g.gd, g.team, CASE
        WHEN g.n < {MIN_ROWS} THEN 'Row count < {MIN_ROWS}'
        WHEN g.starters <> {STARTERS} THEN 'starter count != {STARTERS}'
        WHEN g.gids <> 1 THEN 'gid count != 1'
        WHEN g.opps <> 1 THEN 'opp count != 1'
        WHEN f.first_gid IS NULL OR f.first_gid <> g.first_gid THEN 'opp gid != gid'
        WHEN g.tsids <> 1 THEN 'tsid count != 1'
        WHEN t.n IS NULL OR t.n <> 1 THEN 'TStats.id = tsid match count != 1'
        WHEN t.gd <> g.gd THEN 'TStats.GD != GD'
        WHEN t.team <> g.team THEN 'TStats.team != team'
        WHEN g.players <> g.n THEN 'Duplicate name' END AS info
    FROM grp g LEFT JOIN grp f ON f.gd = g.gd AND f.team = g.opp
    LEFT JOIN (SELECT id, count(*) AS n, min(gd) AS gd, min(team) AS team FROM v_pteam GROUP BY id) t ON t.id = g.tsid)
    WHERE info IS NOT NULL"""

GROUPS_SQL = """grp AS (SELECT gd, team, count(*) AS n, count(*) FILTER (starter) AS starters,
    count(DISTINCT gid) AS gids, count(DISTINCT opp) AS opps, min(opp) AS opp, min_by(gid, id) AS first_gid,
    count(DISTINCT tsid) + CASE WHEN count(tsid) < count(*) THEN 1 ELSE 0 END AS tsids, min(tsid) AS tsid,
    count(DISTINCT player) AS players FROM v_player GROUP BY gd, team)"""

_NAMES_OF = f"""SELECT '%s' AS "table", n.name AS id, {MESSAGE_SQL} AS info
    FROM %s n LEFT JOIN conv c ON n.name = c.old_name LEFT JOIN v_missing m ON n.name = m.name
    LEFT JOIN v_known k ON n.name = k.name
    WHERE c.old_name IS NOT NULL OR (m.name IS NULL AND k.name IS NULL)"""
NAMES_SQL = _NAMES_OF.replace("%s", "part", 1).replace("%s", "v_names")
# A second table of names.
SEGMENTS_SQL = _NAMES_OF.replace("%s", "customer", 1).replace("%s", "(SELECT DISTINCT c_mktsegment AS name FROM customer)")

_ALL_VIEWS = ("v_team", "v_player", "v_pteam", "v_names", "v_conversions", "v_missing", "v_known", "v_similar")
_ALL_SQL = f"{GAMES_SQL} UNION ALL {PLAYERS_SQL} UNION ALL {NAMES_SQL} UNION ALL {SEGMENTS_SQL}"


def game_log(spark, sf):
    return Q.check_games(table(spark, sf, "v_team"))


def player_log(spark, sf):
    players, games = table(spark, sf, "v_player"), table(spark, sf, "v_pteam")
    return Q.check_players(players, games, min_rows=MIN_ROWS, starters=STARTERS)


def name_log(spark, sf):
    return Q.check_names(table(spark, sf, "part"), "p_name", "part", *name_lists(spark, sf))


def whole_log(spark, sf):
    segments = Q.check_names(table(spark, sf, "customer"), "c_mktsegment", "customer", *name_lists(spark, sf))
    return Q.combine_logs(game_log(spark, sf), player_log(spark, sf), name_log(spark, sf), segments)


@query("dq_team_game", with_views(GAMES_SQL, "v_team"))
def _(spark, sf):
    return game_log(spark, sf)


@query("dq_player_group", with_views(f"WITH {GROUPS_SQL} {PLAYERS_SQL}", "v_player", "v_pteam"))
def _(spark, sf):
    return player_log(spark, sf)


@query("dq_names", with_views(f"WITH {LISTS_SQL} {NAMES_SQL}", "v_names", "v_conversions", "v_missing", "v_known"))
def _(spark, sf):
    return name_log(spark, sf)


@query("dq_run_all", with_views(f"WITH {LISTS_SQL}, {GROUPS_SQL} {_ALL_SQL}", *_ALL_VIEWS))
def _(spark, sf):
    return whole_log(spark, sf)


@query(
    "dq_summary",
    with_views(
        f"""WITH {LISTS_SQL}, {GROUPS_SQL} SELECT errors, sim_names, errors = 0 AND sim_names = 0 AS all_good
            FROM (SELECT count(*) AS errors FROM ({_ALL_SQL})), (SELECT count(*) AS sim_names FROM ({SIMILAR_SQL}))""",
        *_ALL_VIEWS,
    ),
)
def _(spark, sf):
    return Q.summarize(whole_log(spark, sf), similar_names(spark, sf))


@query(
    "dq_saved_logs",
    with_views(
        f"""WITH {LISTS_SQL}, {GROUPS_SQL} SELECT 'Err_Log' AS sheet, id, info FROM ({_ALL_SQL})
            UNION ALL SELECT 'Name_Log' AS sheet, name1 AS id, name2 AS info FROM ({SIMILAR_SQL})""",
        *_ALL_VIEWS,
    ),
)
def _(spark, sf):
    logs = [whole_log(spark, sf), similar_names(spark, sf)]
    paths = write_named(logs, fresh_path(spark, "integrity"), ["Err_Log", "Name_Log"], force_dir=True)
    errors = spark.read.parquet(paths["Err_Log"]).select("id", "info").withColumn("sheet", F.lit("Err_Log"))
    names = spark.read.parquet(paths["Name_Log"]).select(
        F.col("name1").alias("id"), F.col("name2").alias("info"), F.lit("Name_Log").alias("sheet")
    )
    return errors.unionByName(names)
