"""Rule days are judged in tasks of so many batches, however many there are."""

import re

import pytest

from tagflow import registry
from tagflow.operators import coverage

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["rule_verdicts", "rules_coverage"])
def test_tasks_grow_with_the_plan(spark, monkeypatch, name):
    monkeypatch.setattr(coverage, "BATCHES", 5)
    n = -(-registry.GRAPH.frame(spark, SMALL, "rule_days").count() // 5)
    df = registry.GRAPH.frame(spark, SMALL, name)
    assert n > 4 and len(re.findall(rf"hashpartitioning\(batch_id#\d+, {n}\)", df._jdf.queryExecution().executedPlan().toString())) >= 1
    assert 5 * (n - 1) < df.count() <= 5 * n
