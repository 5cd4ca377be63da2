"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import datetime as dt
import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from feedkit.plans.catalog import ORACLES, QUERIES
from feedkit.plans.views import TABLES

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield con
    con.close()


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def check_plan(df):
    """No join without a key, no rows sent through Python."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in plan


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(name, spark, duck, sf_dir):
    df = entry.queries()[name](spark, sf_dir)
    got = df.collect()
    check_plan(df)
    cursor = duck.execute(entry.oracle_sql()[name])
    wanted_types = {c[0]: str(c[1]) for c in cursor.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == wanted_types
    columns = sorted(wanted_types)
    places = [[c[0] for c in cursor.description].index(c) for c in columns]
    wanted = sorted([canonical(row[i]) for i in places] for row in cursor.fetchall())
    assert sorted([canonical(row[c]) for c in columns] for row in got) == wanted


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_gives_rows(name, spark, sf_dir):
    assert entry.queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


LIMITED = {"topk_rows", "topk_keys", "top_corr", "top_corr_neg", "top_corr_abs", "remove_outliers_abs"}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - LIMITED))
def test_sql_reads_whole_tables(name):
    assert not re.search(r"\blimit\b|using sample|tablesample", entry.oracle_sql()[name], re.IGNORECASE)
