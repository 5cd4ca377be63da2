"""A key with a third of all rows is split by adaptive execution, also against an aggregated right side."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from feedkit.errors import FeedkitError
from feedkit.operators import joins
from feedkit.operators.skew import join_keys

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def without_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed_plan(df):
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    return plan.toString()


@pytest.mark.parametrize("how", ["link", "semi", "count"])
def test_hot_keys_are_split(spark, without_broadcast, how):
    child = spark.range(600_000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 2000 END AS k", "sha2(CAST(id AS STRING), 256) AS text", "id % 2000 > 900 AS f"
    )
    parent = spark.range(2000).selectExpr("id", "id AS k")
    if how == "link":
        out = joins.link_first(child, parent, ["k"], "id", "found")
        assert out.filter(F.col("found") != F.col("k")).isEmpty()
    elif how == "semi":
        out = joins.rows_without_flag(child, ["k"], "f")
    else:
        out = joins.count_parents(child, "k", parent, "id")
    assert "skew=true" in executed_plan(out)


def test_join_columns_must_have_one_type(spark):
    with pytest.raises(FeedkitError):
        join_keys(spark.range(1), spark.range(1).selectExpr("CAST(id AS INT) AS id"), ["id"])
