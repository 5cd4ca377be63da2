"""Queries for readers and writers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.plans.registry import query
from feedkit.plans.views import table, with_views
from feedkit.session import fresh_path
from feedkit.sources import (
    active_team_names,
    append_batch,
    append_rows,
    feed_scan,
    html_files,
    known_names,
    latest_dated,
    latest_snapshot,
    listed_names,
    lookup_pairs,
    name_pairs,
    read_batches,
    sql_query,
    table_scan,
    text_lines,
    write_named,
    write_observed,
    write_values,
    write_version,
    write_version_csv,
)

ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


@query("src_table_scan", "SELECT * FROM orders")
def _(spark, sf):
    return table_scan(spark, f"{sf}/orders.parquet", schema=ORDERS, key="o_orderkey")


@query(
    "src_sql_query",
    "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 100",
)
def _(spark, sf):
    text = "SELECT c_custkey, c_name, c_acctbal FROM {customer} WHERE c_mktsegment = :segment AND c_acctbal > :low"
    return sql_query(spark, text, {"customer": table(spark, sf, "customer")}, segment="BUILDING", low=100)


@query("src_scalar_query", "SELECT event_id, ts FROM events WHERE ts = (SELECT max(ts) FROM events)")
def _(spark, sf):
    events = table(spark, sf, "events")
    return events.filter(F.col("ts") == events.agg(F.max("ts")).scalar()).select("event_id", "ts")


@query("src_feed_scan", "SELECT * FROM lineitem")
def _(spark, sf):
    items = table(spark, sf, "lineitem")
    path = write_version_csv(items, fresh_path(spark, "lineitem-feed"), force_dir=True)
    return feed_scan(spark, path, items.schema)


@query(
    "src_latest_snapshot",
    """SELECT * FROM events WHERE CAST(ts AS DATE) = (
           SELECT max(CAST(ts AS DATE)) FROM events
           WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-11' AND DATE '2024-01-25')""",
)
def _(spark, sf):
    return latest_snapshot(table(spark, sf, "events"), "ts", dt.date(2024, 1, 25))


@query(
    "src_lookup_pairs",
    with_views("SELECT old_name, max_by(new_name, ord) AS new_name FROM v_conversions GROUP BY old_name"),
)
def _(spark, sf):
    return lookup_pairs(table(spark, sf, "v_conversions"), "old_name", "new_name", "ord")


@query("src_known_names", "SELECT DISTINCT p_name AS name FROM part WHERE p_size IN (17, 18)")
def _(spark, sf):
    return known_names(table(spark, sf, "part"), "p_name", "p_size", [17, 18])


@query("src_known_missing", "SELECT DISTINCT p_brand AS name FROM part")
def _(spark, sf):
    return listed_names(table(spark, sf, "part"), "p_brand")


_ACTIVE_NAMES = """SELECT c_name AS name FROM customer WHERE c_acctbal > 0
                   UNION SELECT c_mktsegment AS name FROM customer WHERE c_acctbal > 0"""


@query("src_unpivot_names", _ACTIVE_NAMES)
def _(spark, sf):
    return active_team_names(table(spark, sf, "customer"), F.col("c_acctbal") > 0, ["c_name", "c_mktsegment"])


@query(
    "src_pair_list",
    with_views("SELECT DISTINCT least(name1, name2) AS name_lo, greatest(name1, name2) AS name_hi FROM v_similar"),
)
def _(spark, sf):
    return name_pairs(table(spark, sf, "v_similar"), "name1", "name2")


@query("src_text_lines", "SELECT unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS value FROM documents")
def _(spark, sf):
    path = write_values(table(spark, sf, "documents"), "text", fresh_path(spark, "documents-text"))
    return text_lines(spark, path)


# Folders that the pages are dealt over: more than Spark lists on the driver, so that tasks list them.
_FOLDERS = 64


def _page_folder(spark, sf) -> str:
    """Every page as a file of its own, as a crawler leaves them, with its id in a comment before it. The writer ends it with a
    line end.

    Tasks move their files into place by themselves, which takes the driver no step per file. A task that is repeated writes the
    same names again, and nobody reads the folder before the write is over.
    """
    path = fresh_path(spark, "html-pages")
    pages = table(spark, sf, "pages").filter("html IS NOT NULL")
    marked = F.concat(F.lit("<!-- page_id="), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(" -->\n"), "html")
    dealt = pages.select(F.pmod(F.xxhash64("page_id", "url"), F.lit(_FOLDERS)).alias("folder"), marked.alias("value"))
    one_each = dealt.repartition("folder").write.partitionBy("folder").option("maxRecordsPerFile", 1)
    one_each.option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(path)
    return path


@query("src_html_docs", "SELECT page_id, html FROM pages WHERE html IS NOT NULL")
def _(spark, sf):
    """Read back as whole files; the page is in the comment before it."""
    files = html_files(spark, _page_folder(spark, sf))
    page = F.expr("try_cast(regexp_extract(html, r'^<!-- page_id=(-?[0-9]*) -->', 1) AS BIGINT)").alias("page_id")
    return files.select(page, F.expr("substring(html, instr(html, ' -->') + 5, length(html) - instr(html, ' -->') - 5)").alias("html"))


@query("src_html_pages", "SELECT page_id, url, html FROM pages")
def _(spark, sf):
    return table_scan(spark, f"{sf}/pages.parquet", key="page_id").select("page_id", "url", "html")


@query("src_latest_dated", "SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-24'")
def _(spark, sf):
    """Feed folders named by their day, some days missing; the newest within the look-back window is read."""
    path, events = fresh_path(spark, "dated-feeds"), table(spark, sf, "events").select("event_id", "ts")
    for day in (dt.date(2024, 1, 9), dt.date(2024, 1, 21), dt.date(2024, 1, 24)):
        events.filter(F.to_date("ts") == F.lit(day)).write.parquet(day.strftime(f"{path}/event-feed-%m-%d-%Y"))
    newest = latest_dated(spark, f"{path}/event-feed-%m-%d-%Y", dt.date(2024, 1, 27))
    return table_scan(spark, newest, events.schema)


@query("snk_append_once", "SELECT * FROM orders")
def _(spark, sf):
    """Two batches, the first of which is sent again by a run that does not know that it came through."""
    orders, path = table(spark, sf, "orders"), fresh_path(spark, "orders-batches")
    early = F.col("o_orderdate") < F.lit(dt.datetime(1998, 1, 1))
    for batch, rows in (("early", orders.filter(early)), ("late", orders.filter(~early)), ("early", orders.filter(early))):
        append_batch(rows, path, ORDERS, batch)
    return read_batches(spark, path, ORDERS)


@query(
    "snk_observed_counts",
    """SELECT count(*) FILTER (o_totalprice > 1000) AS successes,
              count(*) FILTER (o_totalprice > 1000 IS NOT TRUE) AS failures,
              count(*) FILTER (o_totalprice > 1000) AS n_written FROM orders""",
)
def _(spark, sf):
    orders, path = table(spark, sf, "orders"), fresh_path(spark, "orders-observed")
    counts = write_observed(orders, path, ORDERS, F.col("o_totalprice") > 1000)
    written_rows = spark.read.schema(ORDERS).parquet(path).agg(F.count(F.lit(1)).alias("n_written"))
    return written_rows.select(*[F.lit(n).cast("long").alias(c) for n, c in zip(counts, ("successes", "failures"), strict=True)], "n_written")


@query("snk_append", "SELECT * FROM orders")
def _(spark, sf):
    orders, path = table(spark, sf, "orders"), fresh_path(spark, "orders")
    early = F.col("o_orderdate") < F.lit(dt.datetime(1998, 1, 1))
    append_rows(orders.filter(early), path, ORDERS)
    # The second batch comes with its columns in another order.
    append_rows(orders.filter(~early).select(*reversed(orders.columns)), path, ORDERS)
    return spark.read.schema(ORDERS).parquet(path)


@query(
    "snk_versioned_write",
    """SELECT 'first' AS version, c_custkey, c_acctbal FROM customer
       UNION ALL SELECT 'second' AS version, c_custkey, c_acctbal FROM customer""",
)
def _(spark, sf):
    customers, path = table(spark, sf, "customer"), fresh_path(spark, "customers")
    first = write_version(customers, path, ["c_custkey", "c_acctbal"], force_dir=True)
    second = write_version(customers, path, ["c_custkey", "c_acctbal"], force_dir=True)
    return (
        spark.read.parquet(first)
        .withColumn("version", F.lit("first"))
        .unionByName(spark.read.parquet(second).withColumn("version", F.lit("second")))
    )


@query(
    "snk_multi_output",
    """SELECT 'Main_0' AS sheet, c_custkey AS id, c_name AS name FROM customer
       UNION ALL SELECT 'Main_1' AS sheet, s_suppkey AS id, s_name AS name FROM supplier""",
)
def _(spark, sf):
    customers = table(spark, sf, "customer").withColumnsRenamed({"c_custkey": "id", "c_name": "name"})
    suppliers = table(spark, sf, "supplier").withColumnsRenamed({"s_suppkey": "id", "s_name": "name"})
    columns = [["id", "name"], ["id", "name"]]
    paths = write_named([customers, suppliers], fresh_path(spark, "named"), columns=columns, force_dir=True)
    a, b = (spark.read.parquet(p).withColumn("sheet", F.lit(name)) for name, p in paths.items())
    return a.unionByName(b)


@query("snk_value_lines", "SELECT CAST(o_orderkey AS VARCHAR) AS value FROM orders")
def _(spark, sf):
    return text_lines(spark, write_values(table(spark, sf, "orders"), "o_orderkey", fresh_path(spark, "order-keys")))
