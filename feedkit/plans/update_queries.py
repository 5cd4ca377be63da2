"""Queries for table updates, feed by feed and as a whole."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from feedkit.operators import updates as U
from feedkit.operators.aggregates import audit_counts
from feedkit.plans import feeds
from feedkit.plans.join_queries import STARTERS, name_lists
from feedkit.plans.registry import query
from feedkit.plans.stages import update_all
from feedkit.plans.views import table, with_views
from feedkit.sources import lookup_pairs, rewrite_parts, stored_mark
from feedkit.sources.writers import append_rows
from feedkit.session import fresh_path, sweep, written

SEASON = 2018


def _at(*day: int):
    return F.lit(dt.datetime(*day)).cast("timestamp_ntz")


def _derived(events):
    return events.select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("gd"),
        F.col("user_id").alias("team"),
        F.lower("event_type").alias("kind"),
        (F.col("value") * 2).alias("score"),
    )


@query(
    "load_incremental",
    """SELECT event_id AS id, ts AS gd, user_id AS team, lower(event_type) AS kind, value * 2 AS score FROM events
       WHERE ts <= TIMESTAMP '2024-01-28 00:00:00'""",
)
def _(spark, sf):
    events, path = table(spark, sf, "events"), fresh_path(spark, "loaded-events")
    loaded = _derived(events.filter(F.col("ts") <= _at(2024, 1, 15)))
    append_rows(loaded, path, loaded.schema)
    feed = events.withColumnRenamed("ts", "gd")
    return U.load_incremental(
        feed,
        spark.read.schema(loaded.schema).parquet(path),
        "gd",
        _at(2024, 1, 28),
        lambda new: _derived(new.withColumnRenamed("gd", "ts")),
    )


@query(
    "load_after_stored_mark",
    """SELECT event_id AS id, CAST(ts AS DATE)::VARCHAR AS day, user_id AS team, lower(event_type) AS kind FROM events
       WHERE CAST(ts AS DATE) <= DATE '2024-01-27'""",
)
def _(spark, sf):
    """The newest day loaded comes from the footers of the files, and only later days of the feed are read."""
    feed = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    path = fresh_path(spark, "loaded-days")
    loaded = feed.select(F.col("event_id").alias("id"), "day", F.col("user_id").alias("team"), F.lower("event_type").alias("kind"))
    append_rows(loaded.filter(F.col("day") <= F.lit(dt.date(2024, 1, 15))), path, loaded.schema)
    target = spark.read.schema(loaded.schema).parquet(path)
    later = U.load_incremental(
        feed,
        target,
        "day",
        F.lit(dt.date(2024, 1, 27)),
        lambda new: new.select(
            F.col("event_id").alias("id"), "day", F.col("user_id").alias("team"), F.lower("event_type").alias("kind")
        ),
        stored_mark(spark, path, "day"),
    )
    return later.withColumn("day", F.col("day").cast("string"))


@query(
    "update_fk",
    with_views(
        """SELECT p.id, p.gid, p.team, p.season,
                  CASE WHEN p.season = 2018 AND p.tsid IS NULL THEN t.id ELSE p.tsid END AS tsid
           FROM v_player p LEFT JOIN (SELECT gid, team, min(id) AS id FROM v_pteam GROUP BY gid, team) t
           ON p.gid = t.gid AND p.team = t.team"""
    ),
)
def _(spark, sf):
    players = table(spark, sf, "v_player").select("id", "gid", "team", "season", "tsid")
    season = F.col("season") == SEASON
    return U.fill_links(players, table(spark, sf, "v_pteam"), ["gid", "team"], "tsid", where=season, strict=False)


@query(
    "update_fk_in_place",
    with_views(
        """SELECT p.id, p.gid, p.team, p.season,
                  CASE WHEN p.season = 2018 AND p.tsid IS NULL THEN t.id ELSE p.tsid END AS tsid
           FROM v_player p LEFT JOIN (SELECT gid, team, min(id) AS id FROM v_pteam GROUP BY gid, team) t
           ON p.gid = t.gid AND p.team = t.team"""
    ),
)
def _(spark, sf):
    """The same on a table in folders by season, of which only one is read and written for it."""
    path, games = fresh_path(spark, "players-by-season"), table(spark, sf, "v_pteam")
    players = table(spark, sf, "v_player").select("id", "gid", "team", "season", "tsid")
    players.write.partitionBy("season").parquet(path)
    rewrite_parts(
        spark, path, "season", [SEASON], lambda part: U.fill_links(part, games, ["gid", "team"], "tsid", strict=False)
    )
    return spark.read.parquet(path).select(*players.columns)


@query(
    "update_flag",
    with_views(
        """WITH none AS (SELECT gid, team FROM v_player WHERE season = 2018 GROUP BY gid, team
                         HAVING count(*) FILTER (starter) = 0),
                one AS (SELECT gid, team FROM v_pteam GROUP BY gid, team HAVING count(*) = 1)
           SELECT p.id, p.gid, p.team, p.player, p.season, CASE WHEN p.season = 2018 AND n.gid IS NOT NULL
                  AND o.gid IS NOT NULL AND coalesce(player IN (start1, start2, start3, start4, start5), false)
                  THEN true ELSE p.starter END AS starter
           FROM v_player p LEFT JOIN none n ON n.gid = p.gid AND n.team = p.team
           LEFT JOIN one o ON o.gid = p.gid AND o.team = p.team
           LEFT JOIN v_pteam t ON t.gid = p.gid AND t.team = p.team"""
    ),
)
def _(spark, sf):
    players = table(spark, sf, "v_player").select("id", "gid", "team", "player", "season", "starter")
    games, season = table(spark, sf, "v_pteam"), F.col("season") == SEASON
    return U.fill_flag(players, games, ["gid", "team"], "player", "starter", STARTERS, where=season)


@query(
    "update_from_mapping",
    with_views(
        """WITH conv AS (SELECT old_name, max_by(new_name, ord) AS new_name FROM v_conversions GROUP BY old_name)
           SELECT p_partkey, p_size,
                  CASE WHEN p_size IN (17, 18) THEN coalesce(new_name, p_name) ELSE p_name END AS p_name
           FROM part LEFT JOIN conv ON p_name = old_name"""
    ),
)
def _(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_size", "p_name")
    conversions, *_rest = name_lists(spark, sf)
    return U.rewrite_names(parts, "p_name", conversions, where=F.col("p_size").isin(17, 18))


@query(
    "update_from_mapping_rows",
    with_views(
        """WITH conv AS (SELECT old_name, max_by(new_name, ord) AS new_name FROM v_conversions GROUP BY old_name)
           SELECT p_partkey, new_name AS p_name FROM part JOIN conv ON p_name = old_name"""
    ),
)
def _(spark, sf):
    conversions, *_rest = name_lists(spark, sf)
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    return U.rewrite_names(parts, "p_name", conversions, changed_only=True)


def _checks():
    return {"value under 5": F.col("value") >= 5, "event is an error": F.col("event_type") != "error"}


def _old_and_new(spark, sf):
    events, cut = table(spark, sf, "events").select("event_id", "ts", "event_type", "value"), _at(2024, 1, 15)
    return events.filter(F.col("ts") <= cut), events.filter(F.col("ts") > cut)


@query(
    "apply_with_audit",
    """SELECT event_id, ts, event_type, value FROM events
       WHERE ts <= TIMESTAMP '2024-01-15 00:00:00' OR (value >= 5 AND event_type <> 'error')""",
)
def _(spark, sf):
    table_, _log = U.apply_with_audit(*_old_and_new(spark, sf), _checks())
    return table_


@query(
    "apply_with_audit_log",
    """SELECT event_id, CASE WHEN value < 5 THEN 'value under 5' WHEN event_type = 'error' THEN 'event is an error' END
              AS reason, value >= 5 AND event_type <> 'error' AS accepted
       FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'""",
)
def _(spark, sf):
    _table, log = U.apply_with_audit(*_old_and_new(spark, sf), _checks())
    return log.select("event_id", "reason", "accepted")


@query(
    "apply_with_audit_abort",
    """SELECT event_id, ts, event_type, value FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00'""",
)
def _(spark, sf):
    table_, _log = U.apply_with_audit(*_old_and_new(spark, sf), _checks(), on_failure="abort")
    return table_


@query(
    "apply_with_audit_counts",
    """SELECT count(*) FILTER (value >= 5 AND event_type <> 'error') AS successes,
              count(*) FILTER (NOT (value >= 5 AND event_type <> 'error')) AS failures
       FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'""",
)
def _(spark, sf):
    _table, log = U.apply_with_audit(*_old_and_new(spark, sf), _checks())
    return audit_counts(log)


# --- the daily feeds ------------------------------------------------------------------------------------------------

_CUT = dt.datetime(1998, 1, 1)


def raw_team_feed(spark, sf, **other: str):
    """The team rows with the headers of the team feed. Statistics that no table has are made from the row's id.

    ``other`` gives expressions for columns by their names in the table.
    """
    orders = table(spark, sf, "orders").selectExpr("o_orderkey AS gid", "o_orderdate AS date", "o_custkey AS cust")
    special = {
        "playoff": "CASE WHEN cust % 5 = 0 THEN 'Playoffs' ELSE 'Regular Season' END",
        "gd": "date",
        "team": "team",
        "home": "CASE WHEN id % 2 = 0 THEN 'Home' ELSE 'Road' END",
        "mins": "240 + 25 * (gid % 3)",
        "restdays": "'3+'",
        "ref_main": "CASE WHEN id % 2 = 0 THEN concat('M', cust % 50) END",
        "ref_crew1": "concat('C', id % 70)",
        **{s: s for s in STARTERS},
        **other,
    }
    made = [f"{special.get(name, f'id % {11 + i}')} AS `{h}`" for i, (h, name) in enumerate(feeds.TEAM_HEADERS.items())]
    games = table(spark, sf, "v_pteam").drop("gd").join(orders, "gid")
    return games.selectExpr("id AS line", "id % 60 + 30 AS FG", "id % 90 + 60 AS FGA", *made)


def raw_player_feed(spark, sf):
    """The player rows with the headers of the player feed."""
    special = {
        "playoff": "'Regular Season'",
        "gd": "gd",
        "player": "player",
        "pos": "'G'",
        "team": "team",
        "opp": "opp",
        "home": "CASE WHEN team LIKE '%-F' THEN 'H' ELSE 'R' END",
        "pts": "qty",
        "fg3m": "qty % 3",
    }
    made = [
        f"{special.get(name, f'qty % {11 + i}')} AS `{h}`" for i, (h, name) in enumerate(feeds.PLAYER_HEADERS.items())
    ]
    return table(spark, sf, "v_player").selectExpr("id AS line", "qty AS FG", "qty + 4 AS FGA", *made)


def _player_name(key: str) -> str:
    return f"concat('P', CAST(CAST(floor({key} / 50) AS BIGINT) AS VARCHAR(20)))"


def lookups(spark, sf):
    """Every team gets a code. Some player names are written otherwise.

    The conversions are written, so that Spark knows how small they are and broadcasts them instead of shuffling the feed rows.
    """
    teams = table(spark, sf, "v_pteam").select(
        F.col("team").alias("old_name"), F.concat(F.lit("T"), F.col("team")).alias("new_name"), "id"
    )
    part = table(spark, sf, "part").withColumn("old", F.expr(_player_name("p_partkey")))
    listed = part.filter(F.col("p_brand") == "Brand#1").withColumn("new", F.concat(F.lit("Sir "), F.col("old")))
    return feeds.Lookups(
        teams=lookup_pairs(teams, "old_name", "new_name", "id"),
        conversions=written(lookup_pairs(listed, "old", "new", "p_partkey")),
    )


_SIR = f"""sir AS (SELECT DISTINCT {_player_name('p_partkey')} AS old FROM part WHERE p_brand = 'Brand#1')"""


def _clean(c: str) -> str:
    return f"CASE WHEN {c} IN (SELECT old FROM sir) THEN 'Sir ' || {c} ELSE {c} END"


def _made_sql(headers: dict[str, str], types: dict[str, tuple[str, ...]], special: dict[str, str], id_: str) -> str:
    """The numbers of a feed in SQL, as the raw feed makes them, under the names and types of the table."""
    made = {name: f"{id_} % {11 + i}" for i, name in enumerate(headers.values())} | special
    kinds = {"int": "INTEGER", "double": "DOUBLE"}
    return ", ".join(f"CAST({made[n]} AS {sql}) AS {n}" for k, sql in kinds.items() for n in types[k])


_PLACES = {name: 11 + i for i, name in enumerate(feeds.TEAM_HEADERS.values())}
_PLAYER_PLACES = {name: 11 + i for i, name in enumerate(feeds.PLAYER_HEADERS.values())}
_TEAM_SQL = _made_sql(
    feeds.TEAM_HEADERS,
    feeds.TEAM_TYPES,
    {
        "mins": "240 + 25 * (t.gid % 3)",
        "ot": "t.gid % 3",
        "fg2m": f"t.id % 60 + 30 - t.id % {_PLACES['fg3m']}",
        "fg2a": f"t.id % 90 + 60 - t.id % {_PLACES['fg3a']}",
        "season": str(SEASON),
    },
    "t.id",
)
_PLAYER_SQL = _made_sql(
    feeds.PLAYER_HEADERS,
    feeds.PLAYER_TYPES,
    {
        "pts": "qty",
        "fg3m": "qty % 3",
        "fg2m": "qty - qty % 3",
        "fg2a": f"qty + 4 - qty % {_PLAYER_PLACES['fg3a']}",
        "season": str(SEASON),
    },
    "qty",
)

# Game rows as the team feed gives them, numbered as two loads number them.
_FEED_GAMES = f"""fg AS (
    SELECT row_number() OVER (ORDER BY o.o_orderdate > TIMESTAMP '1998-01-01', t.id) AS id, t.id AS line,
           o.o_orderdate AS gd, 'T' || t.team AS team,
           'T' || t.gid || '-' || CASE WHEN t.id % 2 = 0 THEN 'O' ELSE 'F' END AS opp, t.id % 2 = 0 AS home,
           strftime(o.o_orderdate, '%y%m%d') || '_T' || t.gid || '-F_T' || t.gid || '-O' AS gid,
           'M' || o.o_custkey % 50 AS ref_main, 'C' || (t.id - t.id % 2) % 70 AS ref_crew1,
           'C' || (t.id - t.id % 2 + 1) % 70 AS ref_crew2, o.o_custkey % 5 = 0 AS playoff,
           '3+' AS restdays, {_TEAM_SQL}, {', '.join(f'{_clean(s)} AS {s}' for s in STARTERS)}
    FROM v_pteam t JOIN orders o ON o.o_orderkey = t.gid)"""
_FEED_PLAYERS = f"""fp AS (
    SELECT row_number() OVER (ORDER BY gd > TIMESTAMP '1998-01-01', v_player.id) AS id, v_player.id AS line, gd, 'T' || team AS team,
           'T' || opp AS opp, team LIKE '%-F' AS home, {_clean('player')} AS player, 'G' AS pos, false AS playoff, {_PLAYER_SQL},
           strftime(gd, '%y%m%d') || '_T' || split_part(team, '-', 1) || '-F_T' || split_part(team, '-', 1) || '-O' AS gid
    FROM v_player)"""


_TEAM_COLUMNS = sorted(n for names in feeds.TEAM_TYPES.values() for n in names)
_PLAYER_COLUMNS = sorted(n for names in feeds.PLAYER_TYPES.values() for n in names)


@query(
    "feed_team_rows",
    with_views(
        f"""WITH {_SIR}, {_FEED_GAMES} SELECT row_number() OVER (ORDER BY line) AS feed_pos, {', '.join(_TEAM_COLUMNS)} FROM fg
            WHERE gd > TIMESTAMP '1996-01-01' AND gd <= TIMESTAMP '1998-01-01'""",
        "v_pteam",
    ),
)
def _(spark, sf):
    rows, _rejects = feeds.team_rows(
        raw_team_feed(spark, sf), lookups(spark, sf), SEASON, _at(1996, 1, 1), _at(1998, 1, 1), "line"
    )
    return rows


# A value that is no number in some rows of two columns.
_ODD = {"blk": "CASE WHEN id % 13 = 0 THEN concat('n/a ', id % 5) ELSE CAST(id % 37 AS STRING) END",
        "stl": "CASE WHEN id % 29 = 0 THEN 'none' WHEN id % 31 <> 0 THEN CAST(id % 7 AS STRING) END"}


def _odd_feed(spark, sf):
    return feeds.team_rows(
        raw_team_feed(spark, sf, **_ODD), lookups(spark, sf), SEASON, _at(1900, 1, 1), _at(2100, 1, 1), "line"
    )


@query(
    "feed_team_misfits",
    with_views(
        f"""WITH {_SIR}, {_FEED_GAMES}
            SELECT gd, team, opp, 'blk is no int: n/a ' || line % 5 AS reason FROM fg WHERE line % 13 = 0
            UNION ALL SELECT gd, team, opp, 'stl is no int: none' FROM fg WHERE line % 29 = 0""",
        "v_pteam",
    ),
)
def _(spark, sf):
    return _odd_feed(spark, sf)[1].drop(feeds.POSITION)


@query(
    "feed_team_lenient",
    with_views(
        f"""WITH {_SIR}, {_FEED_GAMES}
            SELECT row_number() OVER (ORDER BY line) AS feed_pos, team, gid,
                   CASE WHEN line % 13 <> 0 THEN CAST(line % 37 AS INTEGER) END AS blk,
                   CASE WHEN line % 29 <> 0 AND line % 31 <> 0 THEN CAST(line % 7 AS INTEGER) END AS stl FROM fg""",
        "v_pteam",
    ),
)
def _(spark, sf):
    return _odd_feed(spark, sf)[0].select("feed_pos", "team", "gid", "blk", "stl")


@query(
    "feed_player_rows",
    with_views(
        f"""WITH {_SIR}, {_FEED_PLAYERS} SELECT feed_pos, {', '.join(_PLAYER_COLUMNS)}
            FROM (SELECT *, row_number() OVER (ORDER BY line) AS feed_pos FROM fp
                  WHERE gd > TIMESTAMP '1996-01-01' AND gd <= TIMESTAMP '1998-01-01')
            WHERE opp <> 'Tnobody'""",
        "v_player",
    ),
)
def _(spark, sf):
    rows, _rejects = feeds.player_rows(
        raw_player_feed(spark, sf), lookups(spark, sf), SEASON, _at(1996, 1, 1), _at(1998, 1, 1), "line"
    )
    return rows


@query(
    "feed_player_rejects",
    with_views("SELECT gd, team, opp, 'team not in lookup' AS reason FROM v_player WHERE opp = 'nobody'"),
)
def _(spark, sf):
    everything = F.lit(dt.datetime(1900, 1, 1)).cast("timestamp_ntz")
    _rows, rejects = feeds.player_rows(
        raw_player_feed(spark, sf), lookups(spark, sf), SEASON, everything, _at(2100, 1, 1), "line"
    )
    return rejects.drop(feeds.POSITION)


@query(
    "update_all_stages",
    with_views(
        f"""WITH {_SIR}, {_FEED_GAMES}, {_FEED_PLAYERS}
            SELECT p.id, p.gid, p.gd, p.team, p.player, p.pts, g.id AS tsid,
                   CASE WHEN p.player IN (g.start1, g.start2, g.start3, g.start4, g.start5) THEN true END AS starter
            FROM fp p LEFT JOIN fg g ON g.gid = p.gid AND g.team = p.team
            WHERE p.opp <> 'Tnobody'""",
        "v_player",
        "v_pteam",
    ),
)
def _(spark, sf):
    return _daily_job(spark, sf).players.select("id", "gid", "gd", "team", "player", "pts", "tsid", "starter")


@query(
    "update_all_games",
    with_views(
        f"""WITH {_SIR}, {_FEED_GAMES} SELECT id, {', '.join(_TEAM_COLUMNS)} FROM fg""",
        "v_pteam",
    ),
)
def _(spark, sf):
    return _daily_job(spark, sf, link=False, starters=False).games


@query(
    "pipeline_update_all",
    with_views(
        f"""SELECT 'players' AS stage, gd, team, opp, 'team not in lookup' AS reason FROM v_player
            WHERE opp = 'nobody' AND gd > TIMESTAMP '{_CUT}'"""
    ),
)
def _(spark, sf):
    return _daily_job(spark, sf, link=False, starters=False).problems.drop("id")


def _daily_job(spark, sf, **stages):
    """The tables after an earlier run, which loaded everything up to the cut, and a run over the rest of the feeds."""
    # Feeds and lookups are files and tables in a real run.
    listed = lookups(spark, sf)
    looked_up = feeds.Lookups(teams=written(listed.teams), conversions=listed.conversions)
    raw_players = written(raw_player_feed(spark, sf))
    sweep(spark)
    raw_games = written(raw_team_feed(spark, sf))
    sweep(spark)
    end = _at(2100, 1, 1)

    def new_players(mark, until=end):
        return feeds.player_rows(raw_players, looked_up, SEASON, mark, until, "line")

    def new_games(mark, until=end):
        return feeds.team_rows(raw_games, looked_up, SEASON, mark, until, "line")

    cut = F.lit(_CUT).cast("timestamp_ntz")
    columns = {"id": "long", "tsid": "long", "starter": "boolean"}
    no_players = _empty(spark, {**columns, **_named(feeds.PLAYER_TYPES)})
    no_games = _empty(spark, {"id": "long", **_named(feeds.TEAM_TYPES)})
    old = update_all(
        no_players, no_games, SEASON, lambda mark: new_players(mark, cut), lambda mark: new_games(mark, cut),
        link=False, starters=False, stored=True,
    )
    return update_all(old.players, old.games, SEASON, new_players, new_games, earlier=old.problems, stored=True, **stages)


def _named(types):
    return {name: kind for kind, names in types.items() for name in names}


def _empty(spark, columns):
    return spark.createDataFrame([], ", ".join(f"{name} {kind}" for name, kind in columns.items()))
