"""Queries for pairing, spans, top rows and outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedkit.operators import spans as S
from feedkit.operators import topk as T
from feedkit.operators.aggregates import corr_pairs
from feedkit.operators.ordering import rank_in_group
from feedkit.operators.pairing import fill_referees, pair_by_position, swap_opponents
from feedkit.plans.aggregate_queries import _NUMERICS, corr_sql
from feedkit.plans.registry import query
from feedkit.plans.views import table, with_views


@query(
    "win_pair_swap",
    """SELECT o_orderkey, team, CASE WHEN r % 2 = 0 THEN lead(team) OVER w ELSE lag(team) OVER w END AS opp FROM (
           SELECT o_orderkey, o_custkey AS team, row_number() OVER (ORDER BY o_orderkey) - 1 AS r FROM orders)
       WINDOW w AS (ORDER BY o_orderkey)""",
)
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("team"))
    paired = pair_by_position(rows, "o_orderkey")
    return swap_opponents(paired, "pair", "o_orderkey").drop("pair")


@query(
    "win_pair_fill",
    with_views(
        """SELECT id, game, max(CASE WHEN id % 2 = 0 THEN ref_main END) OVER w AS ref_main,
                  max(CASE WHEN id % 2 = 0 THEN ref_crew1 END) OVER w AS ref_crew1,
                  max(CASE WHEN id % 2 = 1 THEN ref_crew1 END) OVER w AS ref_crew2
           FROM v_team WINDOW w AS (PARTITION BY game)"""
    ),
)
def _(spark, sf):
    columns = ["id", "game", "ref_main", "ref_crew1", "ref_crew2"]
    return fill_referees(table(spark, sf, "v_team").select(*columns), "game", "id")


@query(
    "win_row_order",
    "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS uid FROM conversations",
)
def _(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn")
    return rank_in_group(turns, ["conv_id"], "turn", "uid")


# Users and the system open a span, the assistant closes one.
_MARKS = """
    m AS (SELECT conv_id, turn, role, role <> 'assistant' AS is_start,
                 sum(CASE WHEN role <> 'assistant' THEN 1 ELSE -1 END) OVER w AS s
          FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
    f AS (SELECT *, least(0, coalesce(min(s) OVER (PARTITION BY conv_id ORDER BY turn
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS floor FROM m),
    d AS (SELECT conv_id, turn, role, is_start, s < floor AS rejected,
                 CASE WHEN s < floor THEN NULL
                      ELSE CAST(s - floor + CASE WHEN is_start THEN 0 ELSE 1 END AS INTEGER) END AS depth FROM f)"""


def _starts():
    return F.col("role") != "assistant"


def _turns(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", "role")


@query("win_span_depth", f"WITH {_MARKS} SELECT conv_id, turn, role, is_start, rejected, depth FROM d")
def _(spark, sf):
    return S.span_depth(_turns(spark, sf), "conv_id", "turn", _starts())


@query(
    "win_span_match",
    f"""WITH {_MARKS},
        nxt AS (SELECT conv_id, turn, role, depth, is_start,
                       lead(turn) OVER (PARTITION BY conv_id, depth ORDER BY turn) AS end_at
                FROM d WHERE NOT rejected)
        SELECT conv_id, turn, role, depth, turn AS start_at, end_at,
               CAST(coalesce(end_at, 1000) - turn AS DOUBLE) AS seconds FROM nxt WHERE is_start""",
)
def _(spark, sf):
    now = F.lit(1000).cast("long")
    return S.match_spans(_turns(spark, sf), "conv_id", "turn", "turn", _starts(), now, carry=["role"])


# An answer of the assistant closes as many open spans as its turn number says, by 3, and one more.
_LAYERS = """
    w AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn, i) AS mark_no,
                 role <> 'assistant' AS is_start
          FROM (SELECT *, unnest(range(CASE WHEN role = 'assistant' THEN turn % 3 + 1 ELSE 1 END)) AS i FROM conversations)),
    m AS (SELECT *, sum(CASE WHEN is_start THEN 1 ELSE -1 END) OVER (PARTITION BY conv_id ORDER BY mark_no) AS s FROM w),
    f AS (SELECT *, least(0, coalesce(min(s) OVER (PARTITION BY conv_id ORDER BY mark_no
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS floor FROM m),
    d AS (SELECT *, s < floor AS rejected,
                 CASE WHEN s >= floor THEN CAST(s - floor + CASE WHEN is_start THEN 0 ELSE 1 END AS INTEGER) END AS depth FROM f)"""


@query(
    "win_span_layers",
    f"""WITH {_LAYERS},
        nxt AS (SELECT *, lead(turn) OVER (PARTITION BY conv_id, depth ORDER BY mark_no) AS end_at FROM d WHERE NOT rejected)
        SELECT conv_id, mark_no, role, depth, turn AS start_at, end_at,
               CAST(coalesce(end_at, 1000) - turn AS DOUBLE) AS seconds FROM nxt WHERE is_start""",
)
def _(spark, sf):
    turns = _turns(spark, sf).withColumn("layers", F.when(F.col("role") == "assistant", F.col("turn") % 3 + 1).otherwise(1))
    marks = S.widen_ends(turns, ["conv_id"], "turn", "layers")
    now = F.lit(1000).cast("long")
    return S.match_spans(marks, "conv_id", "mark_no", "turn", _starts(), now, carry=["role"])


@query(
    "win_span_parent",
    f"""WITH {_MARKS},
        st AS (SELECT conv_id, turn, depth, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS uid
               FROM d WHERE is_start)
        SELECT a.conv_id, a.turn, a.uid, a.depth, max(b.uid) AS pid FROM st a
        LEFT JOIN st b ON a.conv_id = b.conv_id AND b.depth = a.depth - 1 AND b.turn < a.turn
        GROUP BY a.conv_id, a.turn, a.uid, a.depth""",
)
def _(spark, sf):
    return S.span_parents(_turns(spark, sf), "conv_id", "turn", _starts())


@query("topk_rows", "SELECT * FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 100")
def _(spark, sf):
    return T.top_rows(table(spark, sf, "orders"), "o_totalprice", 100, "o_orderkey")


@query("topk_keys", "SELECT c_custkey FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 50")
def _(spark, sf):
    return T.top_keys(table(spark, sf, "customer"), "c_acctbal", 50, "c_custkey")


_LINE_CORR = corr_sql("lineitem", {c: c for c in _NUMERICS})
DIMENSIONS = 64
_DIM_CORR = """SELECT 'd' || a.i AS col_a, 'd' || b.i AS col_b, corr(b.v, a.v) AS corr
    FROM e a JOIN e b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY a.i, b.i"""
_DIM_ROWS = f"""e AS (SELECT vec_id, i, CAST(embedding[i] AS DOUBLE) AS v
    FROM (SELECT *, unnest(range(1, {DIMENSIONS} + 1)) AS i FROM embeddings))"""


@query(
    "top_corr",
    f"SELECT col_a, col_b, round(corr, 9) AS corr FROM ({_LINE_CORR}) ORDER BY corr DESC NULLS LAST LIMIT 3",
)
def _(spark, sf):
    pairs = corr_pairs(table(spark, sf, "lineitem"), {c: F.col(c) for c in _NUMERICS})
    return T.top_pairs(pairs, 3).withColumn("corr", F.round("corr", 9))


@query(
    "top_corr_neg",
    f"WITH {_DIM_ROWS} SELECT col_a, col_b, round(corr, 9) AS corr FROM ({_DIM_CORR}) ORDER BY corr LIMIT 5",
)
def _(spark, sf):
    return T.top_pairs(_dim_pairs(spark, sf), 5, mode="neg").withColumn("corr", F.round("corr", 9))


@query(
    "top_corr_abs",
    f"""WITH {_DIM_ROWS} SELECT col_a, col_b, round(abs(corr), 9) AS corr FROM ({_DIM_CORR})
        ORDER BY abs(corr) DESC LIMIT 5""",
)
def _(spark, sf):
    return T.top_pairs(_dim_pairs(spark, sf), 5, mode="abs").withColumn("corr", F.round("corr", 9))


def _dim_pairs(spark, sf):
    dims = {f"d{i}": F.col("embedding")[i - 1].cast("double") for i in range(1, DIMENSIONS + 1)}
    return corr_pairs(table(spark, sf, "embeddings"), dims)


@query(
    "remove_outliers_pct",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
       WHERE l_extendedprice >= (SELECT quantile_cont(l_extendedprice, 0.05) FROM lineitem)
         AND l_extendedprice <= (SELECT quantile_cont(l_extendedprice, 1 - 0.1) FROM lineitem)""",
)
def _(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return T.remove_outliers(items, "l_extendedprice", key="l_orderkey", top=0.1, bottom=0.05)


@query(
    "remove_outliers_abs",
    """WITH high AS (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25),
       low AS (SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM high)
               ORDER BY o_totalprice, o_orderkey LIMIT 10)
       SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM high)
       AND o_orderkey NOT IN (SELECT o_orderkey FROM low)""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return T.remove_outliers(orders, "o_totalprice", key="o_orderkey", top=25, bottom=10.5)


@query("rank_by_distance", with_views("SELECT name, ord, CAST(levenshtein(name, 'red ring') AS INTEGER) AS dist FROM v_names"))
def _(spark, sf):
    return T.rank_by_distance(table(spark, sf, "v_names"), "name", "red ring", "ord")
