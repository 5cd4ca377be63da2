"""Queries for projections, filters, scalars and arrays."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from feedkit import functions as K
from feedkit.operators.filters import (
    between_marks,
    cast_columns,
    cast_failures,
    common_across,
    complete_rows,
    explode_sequence,
    filter_criteria,
    missing_link,
    repeated_matches,
    single_match,
)
from feedkit.plans.registry import query
from feedkit.plans.views import table, with_views
from feedkit.sources.writers import quote_reserved

# Text that is a number in most rows: the value of the only property of an event.
_RAW_SQL = "CASE WHEN event_type = 'error' THEN 'n/a' ELSE regexp_extract(props, '([0-9]+)', 1) END"


def _raw():
    return F.when(F.col("event_type") == "error", "n/a").otherwise(F.regexp_extract("props", "([0-9]+)", 1))


@query("rename_columns", "SELECT o_orderkey AS id, o_custkey AS team, o_orderdate AS gd FROM orders")
def _(spark, sf):
    names = {"o_orderkey": "id", "o_custkey": "team", "o_orderdate": "gd", "not there": "ignored"}
    return table(spark, sf, "orders").withColumnsRenamed(names).select("id", "team", "gd")


@query("drop_columns", "SELECT * EXCLUDE (p_type, p_retailprice) FROM part")
def _(spark, sf):
    return table(spark, sf, "part").drop("p_type", "p_retailprice")


@query(
    "add_constants",
    """SELECT o_orderkey, o_custkey, CAST(2018 AS INTEGER) AS season, CAST(NULL AS VARCHAR) AS opp,
              CAST(NULL AS VARCHAR) AS ref_crew2 FROM orders""",
)
def _(spark, sf):
    empty = F.lit(None).cast("string")
    return (
        table(spark, sf, "orders")
        .select("o_orderkey", "o_custkey")
        .withColumns({"season": F.lit(2018), "opp": empty, "ref_crew2": empty})
    )


@query(
    "filter_watermark",
    """SELECT event_id, ts, user_id FROM events
       WHERE ts > TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'""",
)
def _(spark, sf):
    low, high = F.lit(dt.datetime(2024, 1, 10)), F.lit(dt.datetime(2024, 1, 20))
    marks = [c.cast("timestamp_ntz") for c in (low, high)]
    return table(spark, sf, "events").filter(between_marks("ts", *marks)).select("event_id", "ts", "user_id")


@query(
    "filter_criteria",
    """SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_tax FROM lineitem
       WHERE l_returnflag IN ('A', 'N') AND l_linestatus IN ('O') AND l_linenumber IN (1, 2, 3)""",
)
def _(spark, sf):
    wanted = {"l_returnflag": ["A", "N"], "l_linestatus": ["O", None], "l_linenumber": [1, 2, 3]}
    columns = ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_tax"]
    return filter_criteria(table(spark, sf, "lineitem"), wanted).select(*columns)


@query(
    "single_match",
    """SELECT * EXCLUDE (n) FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey, o_orderdate) AS n FROM orders)
       WHERE n = 1""",
)
def _(spark, sf):
    return single_match(table(spark, sf, "orders"), ["o_custkey", "o_orderdate"])


@query(
    "single_match_repeated",
    "SELECT o_custkey, o_orderdate, count(*) AS n FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1",
)
def _(spark, sf):
    return repeated_matches(table(spark, sf, "orders"), ["o_custkey", "o_orderdate"])


@query(
    "filter_null_key",
    with_views("SELECT id, gid, team, season FROM v_player WHERE season = 2018 AND tsid IS NULL"),
)
def _(spark, sf):
    return missing_link(table(spark, sf, "v_player"), "tsid", "season", 2018).select("id", "gid", "team", "season")


@query(
    "drop_incomplete",
    """SELECT d.doc_id, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id)
       WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL""",
)
def _(spark, sf):
    joined = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return complete_rows(joined, ["doc_id", "quality", "toxic"])


@query("flag_not_contains", "SELECT p_partkey, p_name NOT LIKE '%ring%' AS playoff FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", K.lacks_text(F.col("p_name"), "ring").alias("playoff"))


@query(
    "flag_equals",
    """SELECT c_custkey, lower(c_mktsegment) = 'building' AS any_case, c_mktsegment = 'Building' AS exact
       FROM customer""",
)
def _(spark, sf):
    c = F.col("c_mktsegment")
    return table(spark, sf, "customer").select(
        "c_custkey",
        K.venue_is(c, "Building", ignore_case=True).alias("any_case"),
        K.venue_is(c, "Building").alias("exact"),
    )


@query("cast_columns", f"SELECT event_id, TRY_CAST({_RAW_SQL} AS INTEGER) AS k, {_RAW_SQL} AS k_raw FROM events")
def _(spark, sf):
    return cast_columns(table(spark, sf, "events").select("event_id", _raw().alias("k")), {"k": "int"})


@query(
    "cast_failures",
    f"""SELECT 'k' AS "column", count(*) FILTER (TRY_CAST({_RAW_SQL} AS INTEGER) IS NULL) AS failures FROM events""",
)
def _(spark, sf):
    cast = cast_columns(table(spark, sf, "events").select("event_id", _raw().alias("k")), {"k": "int"})
    return cast_failures(cast, ["k"])


@query("cast_strict", "SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey FROM orders")
def _(spark, sf):
    return cast_columns(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), {"o_custkey": "int"}, strict=True)


@query("norm_nan", "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events")
def _(spark, sf):
    value = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, sf, "events").select("event_id", K.norm_nan(value).alias("value"))


@query(
    "safe_apply_same",
    f"SELECT event_id, coalesce(CAST(TRY_CAST({_RAW_SQL} AS INTEGER) * 2 AS VARCHAR), {_RAW_SQL}) AS k FROM events",
)
def _(spark, sf):
    doubled = (_raw().try_cast("int") * 2).cast("string")
    return table(spark, sf, "events").select("event_id", K.same_on_error(doubled, _raw()).alias("k"))


@query(
    "safe_apply_null",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_tax <> 0 THEN l_extendedprice / l_tax END AS ratio
       FROM lineitem""",
)
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.try_divide("l_extendedprice", "l_tax").alias("ratio")
    )


@query("numeric_predicate", f"SELECT event_id, TRY_CAST({_RAW_SQL} AS DOUBLE) IS NOT NULL AS is_number FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", K.is_number(_raw()).alias("is_number"))


@query(
    "make_game_id",
    with_views(
        """SELECT id, strftime(gd, '%y%m%d') || '_' || CASE WHEN home THEN team ELSE opp END || '_' ||
                  CASE WHEN home THEN opp ELSE team END AS game_id FROM v_team"""
    ),
)
def _(spark, sf):
    parts = [F.col(c) for c in ("gd", "team", "opp", "home")]
    return table(spark, sf, "v_team").select("id", K.game_id(*parts).alias("game_id"))


@query(
    "calc_overtime",
    "SELECT l_orderkey, l_linenumber, CAST(trunc((l_quantity * 8 - 240) / 25) AS INTEGER) AS ot FROM lineitem",
)
def _(spark, sf):
    minutes = F.col("l_quantity") * 8
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", K.overtime_periods(minutes).alias("ot")
    )


@query("derive_difference", "SELECT l_orderkey, l_linenumber, l_quantity - l_linenumber AS fg2m FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") - F.col("l_linenumber")).alias("fg2m")
    )


@query(
    "weighted_score",
    """SELECT l_orderkey, l_linenumber,
              0.0::DOUBLE + l_quantity * 1.0::DOUBLE + l_linenumber * 1.2::DOUBLE + l_discount * 1.5::DOUBLE
              + l_tax * 3.0::DOUBLE + l_suppkey * 3.0::DOUBLE + l_partkey * (-1.0)::DOUBLE AS score FROM lineitem""",
)
def _(spark, sf):
    fields = {"pts": "l_quantity", "treb": "l_linenumber", "ast": "l_discount", "blk": "l_tax", "stl": "l_suppkey"}
    columns = {k: F.col(c) for k, c in {**fields, "tov": "l_partkey"}.items()}
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", K.weighted_score(columns).alias("score"))


@query(
    "parse_date",
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN date_trunc('day', o_orderdate) END AS gd FROM orders",
)
def _(spark, sf):
    text = F.when(F.col("o_orderstatus") == "P", "soon").otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    return table(spark, sf, "orders").select("o_orderkey", K.parse_date(text, "MM/dd/yyyy").alias("gd"))


@query("format_date_sql", "SELECT event_id, strftime(ts, '#%Y-%m-%d %H:%M:%S#') AS at FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", K.format_date_sql(F.col("ts"), wrap="#").alias("at"))


@query(
    "month_number",
    """SELECT o_orderkey, month(o_orderdate)::INTEGER AS from_short, month(o_orderdate)::INTEGER AS from_long,
              CASE WHEN o_orderstatus = 'O' THEN NULL ELSE month(o_orderdate)::INTEGER END AS from_case FROM orders""",
)
def _(spark, sf):
    short, long_ = F.date_format("o_orderdate", "MMM"), F.date_format("o_orderdate", "MMMM")
    cased = F.when(F.col("o_orderstatus") == "O", F.upper(long_)).otherwise(F.lower(long_))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        K.month_number(short).alias("from_short"),
        K.month_number(long_).alias("from_long"),
        K.month_number(cased).alias("from_case"),
    )


@query("escape_quotes", "SELECT doc_id, replace(text, '''', '''''') AS text FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", K.escape_quotes(F.col("text")).alias("text"))


@query("quote_reserved", 'SELECT o_orderkey, o_orderdate AS "[date]", o_orderpriority AS "[Name]" FROM orders')
def _(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("date"), F.col("o_orderpriority").alias("Name")
    )
    return quote_reserved(orders)


def _clean_sql(c: str) -> str:
    collapsed = f"regexp_replace(regexp_replace(replace({c}, '&nbsp;', ' '), '\\n+', ' ', 'g'), ' +', ' ', 'g')"
    ascii_only = f"regexp_replace({collapsed}, '[^\\x00-\\x7F]', '', 'g')"
    return f"regexp_replace({ascii_only}, '^[\\t-\\r\\x1c-\\x20]+|[\\t-\\r\\x1c-\\x20]+$', '', 'g')"


@query("clean_html", f"SELECT page_id, {_clean_sql('html')} AS clean FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", K.clean_html(F.col("html")).alias("clean"))


@query("clean_html_documents", f"SELECT doc_id, {_clean_sql('text')} AS clean FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", K.clean_html(F.col("text")).alias("clean"))


@query(
    "edit_distance",
    "SELECT p_partkey, CAST(levenshtein(p_name, lower(p_type)) AS INTEGER) AS dist FROM part",
)
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.levenshtein("p_name", F.lower("p_type")).alias("dist"))


@query("split_abbrev", with_views("SELECT abbrev, substr(abbrev, 1, 1) AS initial, substr(abbrev, 4) AS last FROM v_abbrev"))
def _(spark, sf):
    return table(spark, sf, "v_abbrev").select(
        "abbrev", K.abbrev_initial(F.col("abbrev")).alias("initial"), K.abbrev_last(F.col("abbrev")).alias("last")
    )


@query("explode_sequence", "SELECT vec_id, unnest(embedding) AS embedding, label FROM embeddings")
def _(spark, sf):
    return explode_sequence(table(spark, sf, "embeddings"), "embedding")


@query(
    "arr_flatten",
    """SELECT doc_id, array_to_string(flatten(list_transform(string_split(text, chr(10)),
              lambda x: string_split(x, ' '))), '|') AS words FROM documents""",
)
def _(spark, sf):
    nested = F.transform(F.split("text", "\n"), lambda line: F.split(line, " "))
    return table(spark, sf, "documents").select("doc_id", F.array_join(K.flatten_once(nested), "|").alias("words"))


def _letters(c):
    return F.filter(F.split(c, ""), lambda x: x != "")


@query(
    "arr_common",
    """SELECT p_partkey, array_to_string(list_sort(list_intersect(list_intersect(list_distinct(string_split(p_name, '')),
              string_split(lower(p_type), '')), string_split('silver medal', ''))), ',') AS common FROM part""",
)
def _(spark, sf):
    common = K.common_elements(_letters("p_name"), _letters(F.lower("p_type")), _letters(F.lit("silver medal")))
    return table(spark, sf, "part").select("p_partkey", F.array_join(F.sort_array(common), ",").alias("common"))


@query(
    "arr_common_rows",
    """SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A' INTERSECT
       SELECT l_partkey FROM lineitem WHERE l_returnflag = 'N' INTERSECT
       SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R'""",
)
def _(spark, sf):
    return common_across(table(spark, sf, "lineitem"), "l_returnflag", "l_partkey", ["A", "N", "R"])


@query(
    "arr_contains_all",
    """SELECT p_partkey, len(list_filter(string_split(lower(substr(p_type, 1, 2)), ''),
              lambda x: NOT list_contains(string_split(p_name, ''), x))) = 0 AS contains FROM part""",
)
def _(spark, sf):
    wanted = _letters(F.lower(F.substring("p_type", 1, 2)))
    return table(spark, sf, "part").select("p_partkey", K.contains_all(_letters("p_name"), wanted).alias("contains"))


_A = "[l_linenumber, l_quantity::INTEGER, (l_suppkey % 3)::INTEGER]"
_B = "[l_quantity::INTEGER, l_linenumber, (l_partkey % 3)::INTEGER]"


def _arrays():
    line, qty = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    return (
        F.array(line, qty, (F.col("l_suppkey") % 3).cast("int")),
        F.array(qty, line, (F.col("l_partkey") % 3).cast("int")),
    )


@query(
    "arr_equal",
    f"""SELECT l_orderkey, l_linenumber, {_A} = {_B} AS ordered, list_sort({_A}) = list_sort({_B}) AS unordered
        FROM lineitem""",
)
def _(spark, sf):
    a, b = _arrays()
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        K.sequences_equal(a, b, order=True).alias("ordered"),
        K.sequences_equal(a, b).alias("unordered"),
    )


@query(
    "arr_all_equal",
    """SELECT l_orderkey, l_linenumber, l_linenumber = l_suppkey % 7 AND l_linenumber = l_partkey % 7 AS same
       FROM lineitem""",
)
def _(spark, sf):
    values = F.array(F.col("l_linenumber").cast("long"), F.col("l_suppkey") % 7, F.col("l_partkey") % 7)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", K.all_equal(values).alias("same"))


@query(
    "map_equal",
    """SELECT c_custkey, c_nationkey = c_custkey % 25 AS same FROM customer""",
)
def _(spark, sf):
    nation, size = F.col("c_nationkey").cast("long"), F.length("c_mktsegment").cast("long")
    a = F.create_map(F.lit("nation"), nation, F.lit("size"), size)
    b = F.create_map(F.lit("size"), size, F.lit("nation"), F.col("c_custkey") % 25)
    return table(spark, sf, "customer").select("c_custkey", K.maps_equal(a, b).alias("same"))


@query("set_union_distinct", "SELECT c_name AS name FROM customer UNION SELECT s_name AS name FROM supplier")
def _(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_name").alias("name"))
    return customers.unionByName(table(spark, sf, "supplier").select(F.col("s_name").alias("name"))).distinct()
