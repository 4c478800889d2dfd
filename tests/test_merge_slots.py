"""Merges of batches that are most of the rows: their rows are dealt out where their batch is told."""

import re

import pytest

from tagflow.operators import merge
from tagflow.tables import setting


@pytest.mark.parametrize("policy", merge.POLICIES)
def test_rows_of_a_large_batch_do_not_meet_in_one_task(spark, policy):
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", -1):
        key = ("'t' AS tenant_id", "'1' AS project_id", "timestamp_ntz'2024-01-01 00:00:00' AS observed_at", "'h' AS row_hash")
        point = "concat('p-', id) AS point_id"
        base = spark.range(50).selectExpr(point, *key)
        staged = spark.range(3000).selectExpr("'all' AS batch_id", point, *key).unionByName(spark.range(2).selectExpr("'twice' AS batch_id", "'p-again' AS point_id", *key))
        told = merge.merged(base, staged, policy)
        plan = told._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Join \[batch_id#\d+\], \[batch_id#\d+\], LeftOuter", plan)
        got = {(r.batch_id, r.action, r.reason): r["count"] for r in told.groupBy("batch_id", "action", "reason").count().collect()}
    assert got == {("all", "insert", None): 2950, ("all", "ignore", None): 50, ("twice", "refused", "double_key"): 2}
