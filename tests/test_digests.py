"""Guards: a batch's checksum from its lines in order, in one pass that holds no batch."""

import hashlib
import re

from pyspark.sql import functions as F

from tagflow import registry
from tagflow.operators import guard
from tagflow.tables import setting

SMALL = "/root/testdata/sf0.001"


def test_digests_as_by_hand_across_arrow_batches(spark):
    rows = [("b", f"p-{i % 70:03}", f"é{i}", 2 if i == 50 else 5, i == 60) for i in range(71)] + [("a", "x", "1", 5, False), ("c", None, "1", 5, False), ("c", None, "2", 5, False), ("d", "y", "", 5, False), ("e", "z", None, 5, False)]
    df = spark.createDataFrame(rows, "batch_id string, p string, line string, fault int, differs boolean").withColumn("place", F.struct("p")).repartition(3)
    for size in (1, 7, 10_000):
        with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", size):
            got = {r.batch_id: (r.n_rows, r.n_bytes, r.checksum, r.fault, r.differs, r.twice) for r in guard.digests(df, 2).collect()}
        for b in "abcde":
            own = sorted((r for r in rows if r[0] == b), key=lambda r: (r[1] or "", r[2] or ""))
            text = "".join(f"{r[2]}\n" for r in own if r[2] is not None).encode()
            keys = [r[1] for r in own]
            assert got[b] == (len(own), len(text), hashlib.sha256(text).hexdigest(), min(r[3] for r in own), any(r[4] for r in own), len(set(keys)) < len(keys)), (b, size)


def test_a_guard_has_few_joins_and_collects_no_lines(spark):
    """Each join and sort holds a page or more of a task's memory at the same time."""
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", -1):
        for name, joins in (("rule_guard", 5), ("entity_guard", 4)):
            plan = registry.GRAPH.frame(spark, SMALL, name)._jdf.queryExecution().executedPlan().toString()
            assert 0 < len(re.findall(r"SortMergeJoin", plan)) <= joins and "collect_list" not in plan, name
