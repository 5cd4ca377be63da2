"""Queries for aggregations and literals."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedkit.operators import aggregates as A
from feedkit.operators import literals as L
from feedkit.operators.joins import first_per_key
from feedkit.operators.topk import exact_quantiles
from feedkit.plans.registry import query
from feedkit.plans.views import table, with_views

PART = 1000


@query(
    "agg_date_range",
    """SELECT count(DISTINCT o_orderdate) AS num_dates, min(o_orderdate) AS min_date, max(o_orderdate) AS max_date
       FROM orders""",
)
def _(spark, sf):
    return A.date_range(table(spark, sf, "orders"), "o_orderdate")


@query("agg_group_count", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey")
def _(spark, sf):
    return A.group_count(table(spark, sf, "lineitem"), ["l_orderkey"])


@query(
    "agg_conditional_count",
    with_views("SELECT gid, team, count(*) FILTER (starter) AS n FROM v_player GROUP BY gid, team"),
)
def _(spark, sf):
    return A.flagged_count(table(spark, sf, "v_player"), ["gid", "team"], F.col("starter"))


@query(
    "agg_distinct_per_group",
    """SELECT l_returnflag, count(DISTINCT l_suppkey) AS n_l_suppkey,
              CAST(count(DISTINCT nullif(l_linenumber, 1)) + max(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END) AS BIGINT)
              AS n_line FROM lineitem GROUP BY l_returnflag""",
)
def _(spark, sf):
    items = table(spark, sf, "lineitem").withColumn("line", F.nullif("l_linenumber", F.lit(1)))
    return A.distinct_per_group(items, ["l_returnflag"], ["l_suppkey", "line"])


@query(
    "agg_first_in_group",
    with_views(
        """SELECT gd, team, min_by(gid, id) AS gid, min_by(player, id) AS player FROM v_player GROUP BY gd, team"""
    ),
)
def _(spark, sf):
    return first_per_key(table(spark, sf, "v_player"), ["gd", "team"], "id", ["gid", "player"])


def _parts_sql(keys: str, order: str, item: str, opened: str, closed: str, source: str) -> str:
    """Pieces of an expression per group: items in order, cut every PART rows."""
    return f"""
        WITH ranked AS (
            SELECT *, row_number() OVER w AS r, count(*) OVER (PARTITION BY {keys}) AS size FROM {source}
            WINDOW w AS (PARTITION BY {keys} ORDER BY {order}))
        SELECT {keys}, (r - 1) // {PART} AS part,
               CASE WHEN min(r) = 1 THEN {opened} ELSE '' END || string_agg({item}, ', ' ORDER BY r)
               || CASE WHEN max(r) = max(size) THEN {closed} ELSE ', ' END AS text
        FROM ranked GROUP BY {keys}, (r - 1) // {PART}"""


@query(
    "agg_group_ids",
    f"""SELECT o_orderstatus, part, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS ids FROM (
            SELECT o_orderstatus, o_orderkey,
                   (row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) // {PART} AS part FROM orders)
        GROUP BY o_orderstatus, part""",
)
def _(spark, sf):
    lists = L.id_lists(table(spark, sf, "orders"), ["o_orderstatus"], "o_orderkey", part_size=PART)
    return lists.withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ","))


@query(
    "agg_group_ids_small",
    with_views(
        """SELECT gid, team, CAST(0 AS BIGINT) AS part, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids
           FROM v_player GROUP BY gid, team"""
    ),
)
def _(spark, sf):
    lists = L.id_lists(table(spark, sf, "v_player"), ["gid", "team"], "id")
    return lists.withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ","))


@query(
    "agg_success_failure",
    """SELECT count(*) FILTER (event_type <> 'error') AS successes, count(*) FILTER (event_type = 'error') AS failures
       FROM events""",
)
def _(spark, sf):
    return A.audit_counts(table(spark, sf, "events").withColumn("accepted", F.col("event_type") != "error"))


PROBS = [0.0, 0.05, 0.25, 0.5, 0.95, 1.0]


@query(
    "agg_quantile",
    " UNION ALL ".join(
        f"SELECT CAST({p} AS DOUBLE) AS prob, round(quantile_cont(l_extendedprice, {p}), 6) AS value FROM lineitem"
        for p in PROBS
    ),
)
def _(spark, sf):
    values = exact_quantiles(table(spark, sf, "lineitem"), "l_extendedprice", PROBS, gather=20_000)
    rows = [(p, v) for p, v in zip(PROBS, values, strict=True)]
    return spark.createDataFrame(rows, "prob double, value double").withColumn("value", F.round("value", 6))


_NUMERICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def corr_sql(source: str, columns: dict[str, str]) -> str:
    """All pairs of the upper triangle."""
    names = list(columns)
    return " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({columns[b]}, {columns[a]}) AS corr FROM {source}"
        for i, a in enumerate(names)
        for b in names[i + 1 :]
    )


@query(
    "agg_corr_matrix",
    f"SELECT col_a, col_b, round(corr, 9) AS corr FROM ({corr_sql('lineitem', {c: c for c in _NUMERICS})})",
)
def _(spark, sf):
    pairs = A.corr_pairs(table(spark, sf, "lineitem"), {c: F.col(c) for c in _NUMERICS})
    return pairs.withColumn("corr", F.round("corr", 9))


@query(
    "agg_list_literal",
    _parts_sql("o_orderstatus", "o_orderkey", "'''' || o_orderpriority || ''''", "'['", "']'", "orders"),
)
def _(spark, sf):
    return L.list_literal(
        table(spark, sf, "orders"), ["o_orderstatus"], "o_orderkey", "o_orderpriority", part_size=PART
    )


@query(
    "agg_list_literal_numbers",
    _parts_sql("o_orderpriority", "o_orderkey", "CAST(o_custkey AS VARCHAR)", "'['", "']'", "orders"),
)
def _(spark, sf):
    return L.list_literal(table(spark, sf, "orders"), ["o_orderpriority"], "o_orderkey", "o_custkey", part_size=PART)


@query(
    "agg_dict_literal",
    _parts_sql(
        "c_mktsegment", "c_custkey", "CAST(c_custkey AS VARCHAR) || ':''' || c_name || ''''", "'{'", "'}'", "customer"
    ),
)
def _(spark, sf):
    return L.dict_literal(
        table(spark, sf, "customer"), ["c_mktsegment"], "c_custkey", "c_custkey", "c_name", part_size=PART
    )


@query(
    "agg_dict_typed",
    f"""WITH e AS (
            SELECT o_orderstatus AS status, o_custkey AS k, min(o_orderkey) AS first, max_by(o_totalprice, o_orderkey) AS v
            FROM orders GROUP BY o_orderstatus, o_custkey),
        r AS (SELECT *, row_number() OVER (PARTITION BY status ORDER BY first) AS r FROM e)
        SELECT status, (r - 1) // {PART} AS part, k AS cust, v AS price FROM r""",
)
def _(spark, sf):
    """The entries of the maps, one row each; a customer's last order counts."""
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderstatus", "status")
    maps = L.dict_maps(orders, ["status"], "o_orderkey", "o_custkey", "o_totalprice", part_size=PART)
    return maps.select("status", "part", F.explode("entries").alias("cust", "price"))


@query(
    "agg_columns_to_lists",
    _parts_sql(
        "c_nationkey, col_no",
        "c_custkey",
        "v",
        "CASE WHEN col_no = 0 THEN '{''c_custkey'':[' ELSE ', ''c_name'':[' END",
        "CASE WHEN col_no = 1 THEN ']}' ELSE ']' END",
        """(SELECT c_nationkey, c_custkey, 0 AS col_no, CAST(c_custkey AS VARCHAR) AS v FROM customer
            UNION ALL SELECT c_nationkey, c_custkey, 1 AS col_no, '''' || c_name || '''' AS v FROM customer)""",
    ),
)
def _(spark, sf):
    return L.columns_literal(
        table(spark, sf, "customer"), ["c_nationkey"], "c_custkey", ["c_custkey", "c_name"], part_size=PART
    )


@query(
    "agg_matrix_literal",
    _parts_sql(
        "c_nationkey",
        "c_custkey",
        "'[''' || c_name || ''', ''' || CAST(c_custkey AS VARCHAR) || ''']'",
        "'['",
        "']'",
        "customer",
    ),
)
def _(spark, sf):
    return L.matrix_literal(
        table(spark, sf, "customer"), ["c_nationkey"], "c_custkey", ["c_name", "c_custkey"], part_size=PART
    )
