"""Every registered query with SQL gives the same rows in DuckDB on the smallest tables."""

import datetime
from collections import Counter

import duckdb
import pytest

from tagflow import registry

DATA = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, datetime.date) and not isinstance(v, datetime.datetime):
        v = datetime.datetime(v.year, v.month, v.day)
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in registry.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_same_rows(spark, duck, name):
    got = registry.QUERIES[name](spark, DATA)
    want = duck.sql(registry.ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    a = Counter(tuple(plain(r[c]) for c in cols) for r in got.collect())
    at = [want.columns.index(c) for c in cols]
    b = Counter(tuple(plain(r[i]) for i in at) for r in want.fetchall())
    assert a == b and sum(a.values()) > 0


#: Outcomes that must occur at the next scale, by query and column.
BRANCHES = {
    ("classify_points", "outcome"): 9, ("history_coverage", "reason"): 13, ("history_columns", "reason"): 5, ("history_rows", "reason"): 4, ("rules_coverage", "reason"): 14, ("rules_rows", "reason"): 6, ("metadata_page_chain", "reason"): 7, ("observed_coverage", "reason"): 4,
    ("entity_links", "link"): 5, ("entity_shape", "fault"): 6, ("sink_guard", "reason"): 8, ("entity_guard", "reason"): 7, ("rule_guard", "reason"): 6, ("history_verdicts", "reason"): 18, ("metadata_verdicts", "reason"): 6, ("size_caps", "reason"): 4, ("completion_scope", "reason"): 5, ("shrink_guard", "reason"): 3, ("merge_history_reject", "reason"): 3, ("entity_changes", "change"): 2, ("stream_checkpoint", "stuck"): 2, ("pinned_inventory", "state"): 4, ("run_status", "reason"): 5, ("site_reconcile", "state"): 7, ("asof_inventory", "state"): 4, ("replay_admission", "verdict"): 6, ("replay_filter", "verdict"): 7,
    ("merge_history", "action"): 4, ("merge_receipts", "action"): 3, ("batch_evidence", "evidence"): 4, ("stale_batches", "reason"): 2, ("hour_coverage", "coverage"): 3, ("split_batches", "state"): 2, ("plan_guard", "verdict"): 3,
}


@pytest.mark.parametrize("name,column", sorted(BRANCHES))
def test_every_outcome_occurs(spark, name, column):
    found = registry.QUERIES[name](spark, "/root/testdata/sf0.01").select(column).distinct().count()
    assert found >= BRANCHES[name, column]


def test_bisect_halves_until_it_fits(spark):
    from tagflow.plans.planning import bisect_batches

    df = spark.createDataFrame([("a", ["x", "y", "z"], [5, 5, 20])], "batch_id string, ids array<string>, counts array<bigint>")
    got = {(r.ids, r.depth, r.state) for r in bisect_batches(df, 10).collect()}
    assert got == {("x", 1, "ready"), ("y", 2, "ready"), ("z", 2, "quarantined")}
