"""Data rules, updates, the daily stages, least squares, readers and writers."""

from __future__ import annotations

import datetime as dt
import os

import numpy as np
import pytest
from conftest import rows
from pyspark.errors import AnalysisException, PySparkException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit import session
from feedkit.errors import EmptyInput, FeedkitError, FolderMissing, MissingLinks, RowsMoved, SharedDirUnset, SnapshotMissing, TooFewRows
from feedkit.operators import joins, literals, quality, stats, updates
from feedkit.plans import feeds, stages
from feedkit.plans.catalog import QUERIES
from feedkit.sources import (
    append_batch,
    latest_dated,
    read_batches,
    write_observed,
    append_rows,
    feed_scan,
    html_files,
    latest_snapshot,
    scalar_query,
    text_lines,
    write_named,
    write_values,
    write_version,
    write_version_csv,
)
from feedkit.sources import footer_maximum, rewrite_parts, stored_mark, writers

DAY = dt.datetime(2017, 10, 18)
NEXT = dt.datetime(2017, 10, 19)


# --- data rules -----------------------------------------------------------------------------------------------------

GAME = "id long, gid string, gd timestamp_ntz, team string, opp string, home boolean, ot int, open_spread double, open_pts double"
CLEAN = [("A", "B", True, 0, -3.0, 200.0), ("B", "A", False, 0, 3.0, 200.0)]


def game(gid, change=None, first=CLEAN[0], second=CLEAN[1], days=(DAY, DAY)):
    return [(gid, days[0], *first), (gid, days[1], *second)]


def test_game_rules(spark):
    def side(i, **changes):
        keys = ["team", "opp", "home", "ot", "open_spread", "open_pts"]
        return tuple({**dict(zip(keys, CLEAN[i], strict=True)), **changes}.values())

    games = {
        "clean": game("clean"),
        "r1": game("r1")[:1],
        "r2": game("r2", days=(DAY, NEXT)),
        "r2 null": game("r2 null", days=(None, None)),
        "r3": game("r3", second=side(1, opp="C")),
        "r3 null": game("r3 null", second=side(1, opp=None)),
        "null names are equal": game("null names are equal", first=side(0, team=None, opp=None), second=side(1, team=None, opp=None)),
        "r4": game("r4", second=side(1, home=True)),
        "r5": game("r5", first=side(0, home=None)),
        "r6": game("r6", second=side(1, ot=1)),
        "r6 null": game("r6 null", first=side(0, ot=None), second=side(1, ot=None)),
        "r7": game("r7", second=side(1, open_spread=-3.0)),
        "r7 null": game("r7 null", first=side(0, open_spread=None), second=side(1, open_spread=None)),
        "r8": game("r8", first=side(0, open_spread=-26.0), second=side(1, open_spread=26.0)),
        "r9": game("r9", second=side(1, open_pts=201.0)),
        "r10 high": game("r10 high", first=side(0, open_pts=251.0), second=side(1, open_pts=251.0)),
        "r10 low": game("r10 low", first=side(0, open_pts=149.0), second=side(1, open_pts=149.0)),
        "two failures": game("two failures", days=(DAY, NEXT), second=side(1, opp="C")),
        "bounds": game("bounds", first=side(0, open_spread=25.0, open_pts=250.0), second=side(1, open_spread=-25.0, open_pts=250.0)),
        None: game(None)[:1],
    }
    data = [(i, *row) for i, row in enumerate(r for rs in games.values() for r in rs)]
    log = quality.check_games(spark.createDataFrame(data, GAME))
    assert {r["id"].removeprefix("gid = "): r["info"] for r in log.collect()} == {
        "r1": "Row count != 2",
        "r2": "gd count != 1",
        "r2 null": "gd count != 1",
        "r3": "opp/team mismatch",
        "r3 null": "opp/team mismatch",
        "r4": "2 home teams",
        "r5": "2 away teams",
        "r6": "OT periods different",
        "r6 null": "OT periods different",
        "r7": "open_spread not negative versions of each other",
        "r7 null": "open_spread not negative versions of each other",
        "r8": "open_spread > MAX_OPEN_SPREAD",
        "r9": "open_pts different",
        "r10 high": "open_pts outside boundaries",
        "r10 low": "open_pts outside boundaries",
        "two failures": "gd count != 1",
    }
    assert {r["table"] for r in log.collect()} == {"TStats"}


PLAYER = "id long, gid string, gd timestamp_ntz, team string, opp string, player string, starter boolean, tsid long"


def squad(team, opp, tsid, gid="g", n=7, starters=5, players=None, tsids=None, gids=None, opps=None):
    out = []
    for i in range(n):
        out.append(
            (
                (gids or {}).get(i, gid), DAY, team, (opps or {}).get(i, opp), (players or {}).get(i, f"{team}{i}"),
                i < starters or (None if i == n - 1 else False), (tsids or {}).get(i, tsid),
            )
        )
    return out


def test_player_rules(spark):
    facing = {}
    groups, expected = [], {}

    def add(name, message, tsid=None, faced=True, **changes):
        tsid_ = tsid if tsid is not None else 100 + len(expected)
        groups.extend(squad(name, changes.pop("opp", f"{name}*"), tsid_, gid=name, **changes))
        if faced:
            groups.extend(squad(f"{name}*", name, 10_000, gid=facing.get(name, name), n=1))
        expected[name] = message
        return tsid_

    links = [(add("clean", None), DAY, "clean")]
    links += [(add("r1", "Row count < 7", n=6), DAY, "r1")]
    links += [(add("r2", "starter count != 5", starters=4), DAY, "r2")]
    links += [(add("r3", "gid count != 1", gids={1: "other"}), DAY, "r3")]
    links += [(add("r3n", "gid count != 1", gids={1: None}), DAY, "r3n")]
    links += [(add("r4", "opp count != 1", opps={2: "other"}), DAY, "r4")]
    facing["r5"] = "other game"
    links += [(add("r5", "opp gid != gid"), DAY, "r5")]
    links += [(add("r5n", "opp gid != gid", faced=False), DAY, "r5n")]
    links += [(add("r6", "tsid count != 1", tsids={3: 5}), DAY, "r6")]
    add("r7", "TStats.id = tsid match count != 1")
    add("r7n", "TStats.id = tsid match count != 1", tsids=dict.fromkeys(range(7)))
    twice = add("r7d", "TStats.id = tsid match count != 1")
    links += [(twice, DAY, "r7d")] * 2
    links += [(add("r8", "TStats.GD != GD"), NEXT, "r8")]
    links += [(add("r9", "TStats.team != team"), DAY, "someone")]
    links += [(add("r10", "Duplicate name", players={6: "r100"}), DAY, "r10")]
    players = spark.createDataFrame([(i, *row) for i, row in enumerate(groups)], PLAYER)
    games = spark.createDataFrame(links, "id long, gd timestamp_ntz, team string")
    log = quality.check_players(players, games).collect()
    assert len({r["id"] for r in log}) == len(log)
    by_team = {r["id"].removeprefix("gd/team grp (20171018/").removesuffix(")"): (r["table"], r["info"]) for r in log}
    assert {k: v[1] for k, v in by_team.items() if not k.endswith("*")} == {k: v for k, v in expected.items() if v}
    assert all((table == "TStats") == info.startswith("TStats") for table, info in by_team.values())


def test_player_groups_sort_once_per_step_and_keep_no_map(spark):
    side = [
        (5, "g", DAY, "a", "b", "p", True, 1),
        (3, None, DAY, "a", "b", "p", False, None),
        (4, "h", DAY, "a", "c", "q", None, 2),
        (9, "h", DAY, "a", "c", None, True, 2),
        (1, "x", DAY, None, "a", "p", True, 3),
        (2, "x", None, "a", "b", "p", True, 3),
        *[(100 + i, "x", DAY, "b", "a", "p", True, 3) for i in range(1000)],
    ]
    groups = quality.player_groups(spark.createDataFrame(side, PLAYER))
    plan = groups._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and plan.count("Sort [") == 2 and plan.count("Exchange") == 2
    found = ["team", "_rows", "_starters", "_players", "_first_gid"]
    found += [f"_{a}_{c}" for c in ("gid", "opp", "tsid") for a in ("n", "lo", "hi")]
    assert rows(groups, *found) == [
        ("a", 4, 2, 3, None, 3, "g", "h", 4, "b", "c", 3, 1, 2),
        ("b", 1000, 1000, 1, "x", 1000, "x", "x", 1000, "a", "a", 1000, 3, 3),
    ]


def test_summary(spark):
    log = spark.createDataFrame([("t", "i", "x")], "table string, id string, info string")
    none = spark.createDataFrame([], "name1 string, name2 string, dist int")
    assert tuple(quality.summarize(log, none).first()) == (1, 0, False)
    assert tuple(quality.summarize(log.limit(0), none).first()) == (0, 0, True)


# --- updates --------------------------------------------------------------------------------------------------------


def test_links(spark):
    child = spark.createDataFrame(
        [(1, "g", "A", None, 2018), (2, "g", "A", 9, 2018), (3, "g", "B", None, 2018), (4, "g", "A", None, 2017), (5, None, "A", None, 2018)],
        "id long, gid string, team string, tsid long, season int",
    )
    parent = spark.createDataFrame([(8, "g", "A"), (7, "g", "A")], "id long, gid string, team string")
    season = F.col("season") == 2018
    filled = updates.fill_links(child, parent, ["gid", "team"], "tsid", where=season, strict=False)
    assert rows(filled, "id", "tsid") == [(1, 7), (2, 9), (3, None), (4, None), (5, None)]
    with pytest.raises(MissingLinks, match="'g', 'B'"):
        updates.fill_links(child, parent, ["gid", "team"], "tsid", where=season)
    again = updates.fill_links(filled, parent, ["gid", "team"], "tsid", where=season, strict=False)
    assert rows(again) == rows(filled)


def test_flags(spark):
    df = spark.createDataFrame(
        [(1, "g1", "p1", True), (2, "g1", "p2", None), (3, "g2", "p1", None), (4, "g2", "p2", False), (5, "g2", "p3", None),
         (6, "g3", "p1", None), (7, "g4", "p1", None)],
        "id long, gid string, player string, starter boolean",
    )
    parent = spark.createDataFrame(
        [("g1", "p2", None), ("g2", "p1", "p2"), ("g3", "p9", None), ("g4", "p1", None), ("g4", "p1", None)],
        "gid string, start1 string, start2 string",
    )
    filled = updates.fill_flag(df, parent, ["gid"], "player", "starter", ["start1", "start2"])
    # g1 has a starter, g3 lists nobody of the group, g4 has two parents.
    assert rows(filled, "id", "starter") == [(1, True), (2, None), (3, True), (4, True), (5, None), (6, None), (7, None)]
    assert rows(updates.fill_flag(filled, parent, ["gid"], "player", "starter", ["start1", "start2"])) == rows(filled)


def test_list_members_and_counts(spark):
    df = spark.createDataFrame([(1, "g", "a"), (2, "g", "b"), (3, "h", "a"), (4, None, "a")], "id long, gid string, player string")
    parent = spark.createDataFrame([("g", "a", None), ("g", "a", "z")], "gid string, s1 string, s2 string")
    assert rows(joins.listed_members(df, parent, ["gid"], "player", ["s1", "s2"]), "id") == [(1,)]
    assert rows(joins.count_parents(df, "gid", parent, "gid"), "id", "n_parents") == [(1, 2), (2, 2), (3, 0), (4, 0)]


def test_incremental_load(spark):
    feed = spark.createDataFrame([(1, DAY), (2, NEXT), (3, dt.datetime(2017, 10, 20))], "id int, gd timestamp_ntz")
    target = spark.createDataFrame([(1, DAY)], "id int, gd timestamp_ntz")
    until = F.lit(NEXT).cast("timestamp_ntz")
    assert rows(updates.new_rows(feed, target, "gd", until), "id") == [(2,)]
    assert rows(updates.load_incremental(feed, target.limit(0), "gd", until), "id") == [(1,), (2,)]


def test_rewrite_names(spark):
    df = spark.createDataFrame([(1, "a", 17), (2, "b", 17), (3, "a", 16)], "id int, name string, season int")
    pairs = spark.createDataFrame([("a", "A")], "old_name string, new_name string")
    season = F.col("season") == 17
    assert rows(updates.rewrite_names(df, "name", pairs, where=season), "id", "name") == [(1, "A"), (2, "b"), (3, "a")]
    assert rows(updates.rewrite_names(df, "name", pairs, where=season, changed_only=True), "id") == [(1,)]


def test_audit(spark):
    target = spark.createDataFrame([(1, 1)], "id int, v int")
    changes = spark.createDataFrame([(2, 5), (3, -1), (4, None)], "id int, v int")
    checks = {"negative": F.col("v") >= 0}
    table, log = updates.apply_with_audit(target, changes, checks)
    assert rows(table, "id") == [(1,), (2,)]
    assert rows(log, "id", "reason") == [(2, None), (3, "negative"), (4, "negative")]
    assert rows(updates.apply_with_audit(target, changes, checks, "abort")[0], "id") == [(1,)]
    assert rows(updates.apply_with_audit(target, changes.limit(0), checks, "abort")[0], "id") == [(1,)]
    with pytest.raises(ValueError):
        updates.apply_with_audit(target, changes, checks, "ask")


# --- feeds and stages -----------------------------------------------------------------------------------------------


def test_a_missing_feed_skips_only_its_stage(spark):
    def columns(types):
        return ", ".join(f"{n} {k}" for k, ns in types.items() for n in ns)

    players = spark.createDataFrame([], "id long, tsid long, starter boolean, " + columns(feeds.PLAYER_TYPES))
    games = spark.createDataFrame([], "id long, " + columns(feeds.TEAM_TYPES))
    row = {"feed_pos": 1, "gid": "g", "team": "A", "player": "p", "gd": DAY, "season": 2018}
    new = spark.createDataFrame([row], "feed_pos long, gid string, team string, player string, gd timestamp_ntz, season int")

    def no_feed(mark):
        raise SnapshotMissing("no snapshot of team feed")

    lost = spark.createDataFrame([(DAY, "X", "Y", "team not in lookup")], feeds.PROBLEM)
    got, same, skipped, problems = stages.update_all(players, games, 2018, lambda mark: (new, lost), no_feed, strict=False)
    assert rows(problems, "stage", "team", "reason") == [("players", "X", "team not in lookup")]
    assert skipped == ["no snapshot of team feed"]
    assert rows(got, "id", "player", "tsid", "starter") == [(1, "p", None, None)]
    assert same is games
    with pytest.raises(MissingLinks):
        stages.update_all(players, games, 2018, lambda mark: (new, None))


def test_numbers_of_rejected_rows_are_not_given_again(spark):
    def columns(types):
        return ", ".join(f"{n} {k}" for k, ns in types.items() for n in ns)

    players = spark.createDataFrame([], "id long, tsid long, starter boolean, " + columns(feeds.PLAYER_TYPES))
    games = spark.createDataFrame([], "id long, " + columns(feeds.TEAM_TYPES))

    def feed(day, lost_at):
        taken = [(p, "A", f"p{p}", day) for p in (1, 2, 3) if p != lost_at]
        new = spark.createDataFrame(taken, "feed_pos long, team string, player string, gd timestamp_ntz")
        lost = spark.createDataFrame([(lost_at, day, "A", "?", "team not in lookup")], f"feed_pos long, {feeds.PROBLEM}")
        return lambda mark: (new, lost)

    off = {"link": False, "starters": False}
    old = stages.update_all(players, games, 2018, feed(DAY, 3), **off)
    assert rows(old.problems, "stage", "id") == [("players", 3)]
    got = stages.update_all(old.players, old.games, 2018, feed(NEXT, 1), earlier=old.problems, **off)
    assert rows(got.players, "id", "player") == [(1, "p1"), (2, "p2"), (5, "p2"), (6, "p3")]
    assert rows(got.problems, "id") == [(4,)]


def test_snapshots(spark):
    df = spark.createDataFrame([(1, DAY), (2, dt.datetime(2017, 10, 19, 5)), (3, NEXT), (4, dt.datetime(2017, 12, 1))], "id int, d timestamp_ntz")
    assert rows(latest_snapshot(df, "d", dt.date(2017, 10, 31)), "id") == [(2,), (3,)]
    assert rows(latest_snapshot(df, "d", dt.date(2017, 11, 1)), "id") == [(2,), (3,)]
    assert rows(latest_snapshot(df, "d", dt.date(2017, 11, 2)), "id") == [(2,), (3,)]
    with pytest.raises(SnapshotMissing):
        latest_snapshot(df, "d", dt.date(2017, 11, 3))


# --- readers and writers --------------------------------------------------------------------------------------------


def test_versions(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    path = str(tmp_path / "out")
    assert [write_version(df, path, ["id"]) for _ in range(3)] == [path, path + " V1", path + " V2"]
    assert spark.read.parquet(path + " V2").columns == ["id"]
    csv = str(tmp_path / "csv")
    assert [write_version_csv(df, csv, sep=";") for _ in range(2)] == [csv, csv + " V1"]
    assert rows(feed_scan(spark, csv, df.schema, sep=";")) == [(1, "a")]


def test_missing_folder(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(FolderMissing):
        write_version(df, str(tmp_path / "no" / "out"))
    df.withColumn("part", F.lit(1)).write.partitionBy("part").parquet(str(tmp_path / "parts"))
    write_version(df, str(tmp_path / "parts" / "out"))
    assert write_version(df, str(tmp_path / "no" / "out"), force_dir=True)


def test_named_outputs(spark, tmp_path):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3, 4)], "p int, q int")
    paths = write_named([a, b], str(tmp_path), columns=[["x"], ["q"]])
    assert list(paths) == ["Main_0", "Main_1"]
    assert [spark.read.parquet(p).columns for p in paths.values()] == [["x"], ["q"]]


def test_append_normalises(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.DoubleType())])
    path = str(tmp_path / "t")
    append_rows(spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "v double, id long"), path, schema)
    append_rows(spark.createDataFrame([(3, None)], "id int, v double"), path, schema)
    back = spark.read.schema(schema).parquet(path)
    assert rows(back) == [(1, None), (2, 2.0), (3, None)]


def test_lines(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    assert rows(text_lines(spark, write_values(df, "n", str(tmp_path / "l")))) == [("1",), ("2",)]
    with pytest.raises(EmptyInput):
        write_values(df.limit(0), "n", str(tmp_path / "e"))


def test_html_docs_of_repeated_page_ids(spark, tmp_path):
    """Each row is a file of its own, also rows of one page and a row without an id."""
    from feedkit.plans.catalog import QUERIES

    rows = [(1, "a", "<p>x\r\n -->\n</p>\n"), (1, "b", "<p>y</p>"), (1, "b", "<p>y</p>"), (-7, "c", ""), (None, "d", "z"), (2, "e", None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = [(r["page_id"], r["html"]) for r in QUERIES["src_html_docs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([(i, h) for i, _, h in rows if h is not None], key=str)


def test_html_files(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>é\n</p>", encoding="utf-8")
    assert [r["html"] for r in html_files(spark, str(tmp_path / "*.html")).collect()] == ["<p>é\n</p>"]


def test_scalar(spark):
    assert scalar_query(spark.createDataFrame([(5, 6)], "a int, b int")) == 5
    assert scalar_query(spark.createDataFrame([], "a int")) is None


class FakeSession:
    """A session on a cluster, with the given setting."""

    def __init__(self, setting):
        self.conf = self
        self.sparkContext = self  # noqa: N815
        self.master, self.setting = "yarn", setting

    def getConf(self):  # noqa: N802
        return self

    def get(self, key, default=None):
        return self.setting if key == "spark.checkpoint.dir" else default


def test_shared_folder_is_read_from_the_session():
    assert session.shared_dir(FakeSession("hdfs:///shared/")) == "hdfs:///shared"


def test_cluster_needs_a_shared_folder():
    with pytest.raises(SharedDirUnset):
        session.shared_dir(FakeSession(None))


# --- least squares --------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(1000, 2, 300), rng.normal(size=300)
    y = 3 * a - 2 * b + 7 + rng.normal(size=300)
    return spark.createDataFrame([(float(p), float(q), float(r)) for p, q, r in zip(a, b, y, strict=True)], "a double, b double, y double")


def test_fit_agrees_with_mllib(spark, sample):
    table = {r[0]: r[1:] for r in stats.ols_fit(sample, ["a", "b"], "y", intcp=1).rows()}
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(sample)
    model = LinearRegression(featuresCol="f", labelCol="y", solver="normal", regParam=0.0).fit(vectors)
    summary = model.summary
    expected = dict(
        zip(
            ["a", "b", "intercept"],
            zip([*model.coefficients, model.intercept], summary.coefficientStandardErrors, summary.tValues, summary.pValues, strict=True),
            strict=True,
        )
    )
    for name, numbers in expected.items():
        assert table[name] == pytest.approx(numbers, rel=1e-6, abs=1e-12)


def test_fit_through_the_origin(spark, sample):
    model = stats.ols_fit(sample, ["a"], ["y"])
    x, y = (np.array([r[0] for r in sample.select(c).collect()]) for c in ("a", "y"))
    assert model.beta[0] == pytest.approx(x @ y / (x @ x))
    assert model.rows()[-1] == ("intercept", 0.0, 0.0, None, None)


def test_fit_guards(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.5), (None, 1.0), (3.0, float("nan")), (4.0, 8.0)], "x double, y double")
    assert stats.ols_fit(df, "x", "y", min_obs=3, intcp=1).observations == 3
    with pytest.raises(TooFewRows):
        stats.ols_fit(df, "x", "y", min_obs=4, intcp=1)
    with pytest.raises(EmptyInput):
        stats.ols_fit(df.filter("x is null"), "x", "y")
    with pytest.raises(FeedkitError):
        stats.ols_fit(df, "x", "y", dropna=False)
    with pytest.raises(ValueError):
        stats.ols_fit(df, "x", "y", intcp=2)


def test_p_values():
    # Published table values of Student's t.
    for t, df, p in [(12.706, 1, 0.05), (2.228, 10, 0.05), (2.750, 30, 0.01), (1.960, 10**6, 0.05), (0.0, 5, 1.0)]:
        assert stats.two_sided_p(t, df) == pytest.approx(p, rel=2e-3)


@pytest.mark.parametrize("sigma", [-1, 0, 1])
def test_forecast(spark, sigma):
    model = stats.LinearModel(("x", "intercept"), (2.0, 10.0), (0.5, 1.0), 9, 7)
    df = spark.createDataFrame([(4.0,)], "x double")
    assert df.select(stats.forecast(model, df.columns, sigma)).first()[0] == 18.0 + sigma * 3.0
    with pytest.raises(FeedkitError):
        stats.forecast(model, ["z"])


def test_save(spark, sample, tmp_path):
    assert stats.save_model(spark, None, str(tmp_path / "m")) is None
    path = stats.save_model(spark, stats.ols_fit(sample, "a", "y", intcp=1), str(tmp_path / "m"))
    assert spark.read.parquet(path).columns == ["variable", "beta", "stderr", "t_value", "prob_t"]


def test_errors_inside_a_plan_are_raised(spark):
    df = spark.createDataFrame([("x",)], "c string")
    with pytest.raises(PySparkException):
        df.select(F.col("c").cast("int")).collect()


# --- batches, dated folders, observed writes, typed maps ------------------------------------------------------------


def test_a_batch_is_added_once_and_whole(spark, tmp_path):
    path = f"{tmp_path}/batches"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    assert read_batches(spark, path, df.schema).count() == 0
    assert append_batch(df, path, df.schema, "monday") and not append_batch(df, path, df.schema, "monday")
    assert append_batch(df.select("name", "id").filter("id = 2"), path, df.schema, "tuesday")
    assert rows(read_batches(spark, path, df.schema)) == [(1, "a"), (2, "b"), (2, "b")]
    for name in ("", "a/b", ".x", "_y"):
        with pytest.raises(ValueError):
            append_batch(df, path, df.schema, name)


def test_a_lost_attempt_leaves_nothing_to_read(spark, tmp_path):
    """A batch that fails half way, and data that was written without a commit, are not read; the batch can come again."""
    path = f"{tmp_path}/batches"
    df = spark.createDataFrame([(1, "1"), (2, "x")], "id long, name string")
    numbers = df.select("id", F.col("name").cast("int").alias("name"))
    with pytest.raises(PySparkException):
        append_batch(numbers, path, numbers.schema, "b")
    df.write.parquet(f"{path}/data-of-a-lost-driver")
    assert read_batches(spark, path, numbers.schema).count() == 0
    assert append_batch(numbers.filter("id = 1"), path, numbers.schema, "b")
    assert rows(read_batches(spark, path, numbers.schema)) == [(1, 1)]


def test_of_two_drivers_one_commits(spark, tmp_path):
    """The second one finds the batch committed after it has written its rows."""
    path = f"{tmp_path}/batches"
    df = spark.createDataFrame([(1,)], "id long")

    real = writers.to_schema

    def slow(frame, schema):
        writers.to_schema = real
        assert append_batch(df, path, schema, "b")
        return real(frame, schema)

    writers.to_schema = slow
    assert not append_batch(df, path, df.schema, "b")
    assert rows(read_batches(spark, path, df.schema)) == [(1,)]


def test_dated_folders(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "id long")
    pattern = f"{tmp_path}/feed-%m-%d-%Y"
    for day in (dt.date(2024, 1, 1), dt.date(2024, 1, 10)):
        df.write.parquet(day.strftime(pattern))
    assert latest_dated(spark, pattern, dt.date(2024, 1, 10)).endswith("feed-01-10-2024")
    assert latest_dated(spark, pattern, dt.date(2024, 1, 9)).endswith("feed-01-01-2024")
    assert latest_dated(spark, pattern, dt.date(2024, 1, 24)).endswith("feed-01-10-2024")
    with pytest.raises(SnapshotMissing):
        latest_dated(spark, pattern, dt.date(2024, 1, 25))


def test_observed_write(spark, tmp_path):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, None)], "id long, v int")
    assert write_observed(df, f"{tmp_path}/seen", df.schema, F.col("v") > 0) == (1, 2)
    assert rows(spark.read.parquet(f"{tmp_path}/seen"), "id") == [(1,)]
    assert write_observed(df.limit(0), f"{tmp_path}/none", df.schema, F.col("v") > 0) == (0, 0)


@pytest.mark.parametrize("part_size", [2, 100])
def test_typed_maps(spark, part_size):
    data = [("g", 1, "a", 1.5), ("g", 2, "b", None), ("g", 3, "a", 2.5), ("g", 4, None, 9.0), ("g", 5, "c", 3.0), (None, 6, "z", 1.0)]
    df = spark.createDataFrame(data, "g string, o long, k string, v double")
    got = {r["part"]: r["entries"] for r in literals.dict_maps(df, ["g"], "o", "k", "v", part_size=part_size).collect()}
    if part_size == 2:
        assert got == {0: {"a": 2.5, "b": None}, 1: {"c": 3.0}}
    else:
        assert got == {0: {"a": 2.5, "b": None, "c": 3.0}}


def test_mark_from_footers(spark, tmp_path):
    """Whole numbers and dates come from footers; other types, nulls and empty tables are still right."""
    path = str(tmp_path / "loaded")
    row = "id long, day date, t timestamp_ntz, none long"
    days = [dt.date(2024, 1, d) for d in (3, 9, 5)]
    data = [(i, d, dt.datetime(2024, 1, d.day, 7), None) for i, d in enumerate(days)]
    spark.createDataFrame(data, row).repartition(3).write.parquet(path)
    plan = footer_maximum(spark, path, "day")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(day)]" in plan
    assert [stored_mark(spark, path, c) for c in ("id", "day", "t", "none")] == [2, dt.date(2024, 1, 9), dt.datetime(2024, 1, 9, 7), None]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    empty = str(tmp_path / "empty")
    spark.createDataFrame([], row).write.parquet(empty)
    assert stored_mark(spark, empty, "day") is None


def test_only_the_named_parts_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "seasons")
    df = spark.createDataFrame([(1, "a", 2017), (2, None, 2018), (3, "c", 2018), (4, None, None)], "id int, v string, season int")
    df.write.partitionBy("season").parquet(path)
    files = lambda: {str(f.relative_to(path)) for f in (tmp_path / "seasons").rglob("*.parquet")}
    before = files()
    rewrite_parts(spark, path, "season", [2018, 2030], lambda part: part.withColumn("v", F.coalesce("v", F.lit("new"))))
    assert {f for f in before if "2018" not in f} == {f for f in files() if "2018" not in f}
    assert not {f for f in before if "2018" in f} & files()
    wanted = [(1, "a", 2017), (2, "new", 2018), (3, "c", 2018), (4, None, None)]
    assert rows(spark.read.parquet(path), "id", "v", "season") == wanted
    # A row that would leave its part, also for none, stops the change before anything is replaced.
    before = files()
    for other in (2017, None):
        with pytest.raises(RowsMoved):
            rewrite_parts(spark, path, "season", [2018], lambda part: part.withColumn("season", F.lit(other).cast("int")))
    assert files() == before and rows(spark.read.parquet(path), "id", "v", "season") == wanted


def test_team_feed_is_numbered_on_few_columns(spark, sf_dir, monkeypatch):
    seen = []

    def spy(df, *args):
        seen.append(df.columns)
        return number_rows(df, *args)

    number_rows = feeds.number_rows
    monkeypatch.setattr(feeds, "number_rows", spy)
    QUERIES["feed_team_rows"](spark, sf_dir)
    assert seen == [["line", "team", "ref_main", "ref_crew1"]]


def test_teams_of_the_player_feed_are_looked_up_in_pairs(spark, sf_dir, monkeypatch):
    seen = []

    def spy(df, *args, **kwargs):
        seen.append(df.columns)
        return map_values(df, *args, **kwargs)

    map_values = feeds.map_values
    monkeypatch.setattr(feeds, "map_values", spy)
    QUERIES["feed_player_rejects"](spark, sf_dir)
    assert seen == []
    teams = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", None)], "old_name string, new_name string")
    sides = [("a", "b"), ("b", "a"), ("a", None), (None, "b"), ("a", "x"), ("c", "a"), ("a", "b"), (None, None)]
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(sides)], "i int, team string, opp string")
    found = feeds._coded_in_pairs(df, feeds.Lookups(teams=teams, conversions=teams))
    coded = {0: ("A", "B", False), 1: ("B", "A", False), 6: ("A", "B", False)}
    assert rows(found, "i", "team", "opp", "_rejected") == [
        (i, *coded.get(i, (*s, True))) for i, s in enumerate(sides)
    ]


@pytest.mark.parametrize(("name", "steps"), [("feed_player_rows", 2), ("feed_team_rows", 2)])
def test_a_feed_deletes_what_it_wrote_on_its_way(spark, sf_dir, monkeypatch, name, steps):
    """Each step is written and its shuffle swept before the next one, and only the rows by outcome stay."""
    events, folders = [], []
    init, write, by = session.Scratch.__init__, session.Scratch.written, feeds.written_by
    monkeypatch.setattr(session.Scratch, "__init__", lambda self, *args: init(self, *args) or folders.append(self.folder))
    monkeypatch.setattr(session.Scratch, "written", lambda self, df: events.append("step") or write(self, df))
    monkeypatch.setattr(session.Scratch, "sweep", lambda self: events.append("sweep"))
    monkeypatch.setattr(feeds, "written_by", lambda *args: events.append("rows") or by(*args))
    df = QUERIES[name](spark, sf_dir)
    assert events == ["step", "sweep"] * steps + ["rows", "sweep"]
    assert len(folders) == 1 and not os.path.exists(folders[0]) and df.count() > 0
    # Whole rows are read from what was written, with no join after it.
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_stored_rows_are_not_written_again(spark, monkeypatch):
    written = []
    monkeypatch.setattr(stages, "written", lambda df: written.append(df) or df)
    target = spark.createDataFrame([(4, DAY)], "id long, gd timestamp_ntz")
    new = spark.createDataFrame([(1, NEXT), (2, NEXT)], "feed_pos long, gd timestamp_ntz")
    for stored in (True, False):
        got, _ = stages.add_rows(target, lambda mark: (new, None), stored=stored)
        assert rows(got, "id") == [(4,), (5,), (6,)] and bool(written) != stored
