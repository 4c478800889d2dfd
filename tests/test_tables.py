"""Intermediate tables: settings that hold for a block, shuffles that go with their write."""

import pytest

from tagflow import registry
from tagflow.tables import materialize, setting

KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_setting_ends_with_its_block(spark):
    before = spark.conf.get(KEY)
    with setting(spark, KEY, "true"):
        assert spark.conf.get(KEY) == "true"
    assert spark.conf.get(KEY) == before
    with pytest.raises(ZeroDivisionError), setting(spark, KEY, "true"):
        1 / 0
    assert spark.conf.get(KEY) == before


def test_brief_shuffles_leave_whole_tables(spark):
    got = materialize(spark.range(1000).repartition(5, "id"), "brief", drop_shuffles=True)
    assert got.count() == 1000 and got.distinct().count() == 1000


@pytest.mark.parametrize("name", ["certified_batch_feed", "merge_receipts", "dedupe_feed"])
def test_joins_of_written_tables_are_not_broadcast_for_their_small_files(spark, name):
    plan = registry.GRAPH.frame(spark, "/root/testdata/sf0.001", name)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
