"""Queries of the subpackage against their SQL, on whole tables."""

from __future__ import annotations

import pytest

from feedkit.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"op9_warc"}))
def test_query_matches_sql(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    got = sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))
    assert got == sorted(map(repr, cursor.fetchall()))


NATIVE = ("op4_mixing", "op7_license_scan", "op10_pii")


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(name, spark, sf_dir):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan
