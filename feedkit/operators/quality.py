"""Ordered integrity rules: each group gets at most one log row, for the first rule it breaks.

Logs have the columns ``table``, ``id`` and ``info``. Every rule reads aggregates of its group, so no group is ever
gathered, and rules are tried in order by one ``coalesce``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.functions.scalars import norm_nan
from feedkit.operators.joins import name_status
from feedkit.operators.skew import join_on
from feedkit.session import written

# Bounds of the game rules.
MAX_OPEN_SPREAD = 25
MAX_OPEN_PTS = 250
MIN_OPEN_PTS = 150
MAX_LEVENSHTEIN = 4
# Size of a team's group.
MIN_PLAYERS = 7
STARTERS = 5


def _first_broken(rules: list[tuple[Column, str]]) -> Column:
    """Message of the first rule that fails; null where all hold. A rule that gives null fails."""
    return F.coalesce(*[F.when(~F.coalesce(holds, F.lit(False)), F.lit(message)) for holds, message in rules])


def _one_number(c: str) -> tuple[Column, ...]:
    """Aggregates that tell whether all rows have the same, non-null value."""
    return F.count(c).alias(f"_n_{c}"), F.min(c).alias(f"_lo_{c}"), F.max(c).alias(f"_hi_{c}")


def _same(c: str) -> Column:
    """All rows have the same non-null value."""
    return (F.col(f"_n_{c}") == F.col("_rows")) & (F.col(f"_lo_{c}") == F.col(f"_hi_{c}"))


def _one_value(c: str) -> Column:
    """One different value in the group, null counted as a value."""
    return (F.col(f"_n_{c}") == 0) | _same(c)


def check_games(games: DataFrame) -> DataFrame:
    """Rules on the two team rows of a game: columns id, gid, gd, team, opp, home, ot, open_spread, open_pts.

    Numbers and dates that are null differ from everything, and so does NaN. Null names are equal to each other.
    """
    floats = [c for c, t in games.dtypes if c in ("open_spread", "open_pts") and t in ("double", "float")]
    games = games.withColumns({c: norm_nan(F.col(c)) for c in floats})
    side = F.struct("team", "opp", "open_spread")
    groups = (
        games.filter(F.col("gid").isNotNull())
        .groupBy("gid")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.min_by(side, "id").alias("a"),
            F.max_by(side, "id").alias("b"),
            F.count_if("home").alias("_homes"),
            *[agg for c in ("gd", "ot", "open_pts") for agg in _one_number(c)],
        )
    )
    a, b = F.col("a"), F.col("b")
    # The messages of the log.
    info = _first_broken(
        [
            (F.col("_rows") == 2, "Row count != 2"),
            (_same("gd"), "gd count != 1"),
            (a["team"].eqNullSafe(b["opp"]) & a["opp"].eqNullSafe(b["team"]), "opp/team mismatch"),
            (F.col("_homes") != 2, "2 home teams"),
            (F.col("_homes") != 0, "2 away teams"),
            (_same("ot"), "OT periods different"),
            (a["open_spread"] == -b["open_spread"], "open_spread not negative versions of each other"),
            (F.abs(a["open_spread"]) <= MAX_OPEN_SPREAD, "open_spread > MAX_OPEN_SPREAD"),
            (_same("open_pts"), "open_pts different"),
            (F.col("_lo_open_pts").between(MIN_OPEN_PTS, MAX_OPEN_PTS), "open_pts outside boundaries"),
        ]
    )
    log = groups.select(
        F.lit("TStats").alias("table"), F.concat(F.lit("gid = "), F.col("gid").cast("string")).alias("id"), info.alias("info")
    )
    return log.filter(F.col("info").isNotNull())


def player_groups(players: DataFrame) -> DataFrame:
    """One row per (gd, team) with what the player rules need, and ``_first_gid``, the game id of the row with the first id.

    Rows are first reduced per player, so a team with very many rows spreads over many tasks; its reduced rows are its
    different players. The few columns that this needs are shuffled before it: hardly any row has a player of its own group
    to be reduced with in the task that made it, and a map of all of them there would only take memory. The text columns
    make Spark sort for both steps, and the order by player serves them both.
    """
    keyed = players.filter(F.col("gd").isNotNull() & F.col("team").isNotNull())
    rows = keyed.select("gd", "team", "player", "id", "gid", "opp", "starter", "tsid").repartition("gd", "team", "player")
    by_player = rows.groupBy("gd", "team", "player").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if("starter").alias("_s"),
        F.min("id").alias("_first"),
        F.min_by("gid", "id").alias("_gid"),
        *[agg for c in ("gid", "opp", "tsid") for agg in _one_number(c)],
    )
    sums = [(F.sum(f"_n_{c}"), F.min(f"_lo_{c}"), F.max(f"_hi_{c}")) for c in ("tsid", "gid", "opp")]
    return by_player.groupBy("gd", "team").agg(
        F.sum("_n").alias("_rows"),
        F.sum("_s").alias("_starters"),
        F.count(F.lit(1)).alias("_players"),
        F.min_by("_gid", "_first").alias("_first_gid"),
        *[agg.alias(f"_{a}_{c}") for c, three in zip(("tsid", "gid", "opp"), sums) for a, agg in zip(("n", "lo", "hi"), three)],
    )


def check_players(
    players: DataFrame, games: DataFrame, min_rows: int = MIN_PLAYERS, starters: int = STARTERS
) -> DataFrame:
    """Rules on the players of a team on a date, against the facing team's group and the linked team row.

    Players: id, gid, gd, team, opp, player, starter, tsid. Games: id, gd, team. The players are read and reduced once: the
    groups are written, and the facing groups are read from there.
    """
    groups = written(player_groups(players))
    facing = groups.select(
        F.col("gd").alias("_f_gd"), F.col("team").alias("_f_team"), F.col("_first_gid").alias("_f_gid"), F.lit(True).alias("_faced")
    )
    linked = games.groupBy(F.col("id").alias("_t_id")).agg(
        F.count(F.lit(1)).alias("_t_rows"), F.min("gd").alias("_t_gd"), F.min("team").alias("_t_team")
    )
    joined = join_on(groups, facing, {"gd": "_f_gd", "_lo_opp": "_f_team"})
    joined = join_on(joined, linked, {"_lo_tsid": "_t_id"})
    # The messages of the log.
    info = _first_broken(
        [
            (F.col("_rows") >= min_rows, f"Row count < {min_rows}"),
            (F.col("_starters") == starters, f"starter count != {starters}"),
            (_one_value("gid"), "gid count != 1"),
            (_one_value("opp"), "opp count != 1"),
            (F.col("_faced") & F.col("_f_gid").eqNullSafe(F.col("_lo_gid")), "opp gid != gid"),
            (_one_value("tsid"), "tsid count != 1"),
            (F.col("_t_rows") == 1, "TStats.id = tsid match count != 1"),
            (F.col("gd") == F.col("_t_gd"), "TStats.GD != GD"),
            (F.col("team") == F.col("_t_team"), "TStats.team != team"),
            (F.col("_rows") == F.col("_players"), "Duplicate name"),
        ]
    )
    about_team_row = F.col("info").startswith("TStats")
    log = joined.withColumn("info", info).filter(F.col("info").isNotNull())
    return log.select(
        F.when(about_team_row, "TStats").otherwise("PStats").alias("table"),
        F.concat(
            F.lit("gd/team grp ("), F.date_format("gd", "yyyyMMdd"), F.lit("/"), F.col("team").cast("string"), F.lit(")")
        ).alias("id"),
        "info",
    )


def check_names(
    df: DataFrame, name: str, table: str, conversions: DataFrame, missing: DataFrame, known: DataFrame
) -> DataFrame:
    """Log of the different names of a table that are in no list or should be written otherwise."""
    names = df.select(F.col(name).alias("id")).distinct()
    return (
        name_status(names, "id", conversions, missing, known)
        .filter("problematic")
        .select(F.lit(table).alias("table"), "id", "info")
    )


def combine_logs(*logs: DataFrame) -> DataFrame:
    """All logs as one."""
    out = logs[0]
    for log in logs[1:]:
        out = out.unionByName(log)
    return out


def summarize(log: DataFrame, similar: DataFrame) -> DataFrame:
    """One row: number of errors, number of similar names, and whether there are neither."""
    errors = log.agg(F.count(F.lit(1)).alias("errors"), F.lit(0).cast("long").alias("sim_names"))
    pairs = similar.agg(F.lit(0).cast("long").alias("errors"), F.count(F.lit(1)).alias("sim_names"))
    return (
        errors.unionByName(pairs)
        .agg(F.sum("errors").alias("errors"), F.sum("sim_names").alias("sim_names"))
        .withColumn("all_good", (F.col("errors") == 0) & (F.col("sim_names") == 0))
    )
