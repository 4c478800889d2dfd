"""Results that must be whole, against brute force over the tables' rows."""

from collections import Counter

from tagflow import registry

DATA = "/root/testdata/sf0.001"


def test_rule_scope_covers_every_day(spark):
    rows = [tuple(r) for r in registry.QUERIES["rule_scope_coverage"](spark, DATA).select("source_id", "rule_date", "detections").collect()]
    entities = [r.source_id for r in registry.GRAPH.frame(spark, DATA, "entities_v").collect()]
    found = Counter((r.targetRef, r.rule_date) for r in registry.GRAPH.frame(spark, DATA, "detections_v").collect())
    days = {d for _, d in found}
    assert days and Counter(rows) == Counter((e, d, found[e, d]) for e in entities for d in days)


def test_lineage_has_no_row_limit(spark):
    from tagflow.operators.relate import lineage_depth

    edges = spark.createDataFrame([(1, 2), (1, 3), (2, 4), (9, 10), (9, None)], "parent_id bigint, child_id bigint")
    got = {tuple(r) for r in lineage_depth(lineage=edges).where("id IS NOT NULL").select("id", "root", "depth").collect()}
    assert got == {(1, 1, 0), (2, 1, 1), (3, 1, 1), (4, 1, 2), (9, 9, 0), (10, 9, 1)}
    wide = spark.range(1, 1_050_001).selectExpr("id % 1000 - 1000 AS parent_id", "id AS child_id")
    assert lineage_depth(lineage=wide).count() == 1_051_000


def test_bisect_depth_suffices_at_any_size(spark, tmp_path):
    lines = spark.range(350_000 * 40).selectExpr("id div 40 AS l_orderkey", "timestamp_ntz '1995-01-02' AS l_shipdate", "1.0 AS l_extendedprice", "'R' AS l_returnflag")
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    got = registry.QUERIES["bisect_batches"](spark, str(tmp_path)).groupBy("state").agg({"*": "count", "n_rows": "sum"}).collect()
    assert [(r[0], r["count(1)"], r["sum(n_rows)"]) for r in got] == [("ready", 350_000, 14_000_000)]


def test_bounded_batches_as_by_brute_force(spark):
    from tagflow.plans.planning import bisect_batches, bounded_batches

    counts = spark.createDataFrame([(f"p-{i}", 1 + i * 7 % 13) for i in range(3000)], "point_id string, n bigint")
    batches = bounded_batches(counts, 21_000, max_ids=16)
    dealt = [list(zip(r.ids, r.counts, strict=True)) for r in batches.collect()]
    assert max(map(len, dealt)) <= 16 and sorted(x for b in dealt for x in b) == sorted(map(tuple, counts.collect()))

    def halve(x):
        n = sum(c for _, c in x)
        if n <= 10 or len(x) == 1:
            return [(",".join(i for i, _ in x), n, "ready" if n <= 10 else "quarantined")]
        return halve(x[: len(x) // 2]) + halve(x[len(x) // 2 :])

    got = [(r.ids, r.n_rows, r.state) for r in bisect_batches(batches, cap=10, max_depth=4).collect()]
    assert Counter(got) == Counter(y for b in dealt for y in halve(b))


def test_batches_are_bounded_and_faults_are_per_batch(spark):
    from tagflow.operators import coverage, validators

    plan = registry.GRAPH.frame(spark, DATA, "history_plan")
    assert plan.selectExpr("max(size(scope)) AS n").first().n <= 8
    verdicts = registry.GRAPH.frame(spark, DATA, "history_coverage")
    rows = registry.GRAPH.frame(spark, DATA, "landed_rows_v")
    split = validators.quarantine_split(rows=rows, verdicts=verdicts)
    assert split.count() == rows.count() and {r.ok for r in split.select("ok").distinct().collect()} == {True, False}
    assert coverage.history_rows(plan=plan, rows=rows, max_observations=1).where("reason = 'observation_cap'").count() > 0


def test_cyclic_join_uses_a_whole_site(spark):
    rows = registry.GRAPH.frame(spark, DATA, "entities_v").collect()
    sites: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: r.source_id):
        sites.setdefault(r.site_ref, []).append(r.source_id)
    template = sites[min(sites)]
    want = Counter((e, template[i % len(template)]) for x in sites.values() for i, e in enumerate(x))
    assert template and Counter((r.source_id, r.copy_of) for r in registry.QUERIES["cyclic_join"](spark, DATA).collect()) == want


def test_windows_come_from_all_events(spark, tmp_path):
    spark.range(1000, 1012).withColumnRenamed("id", "event_id").write.parquet(str(tmp_path / "events.parquet"))
    assert registry.GRAPH.frame(spark, str(tmp_path), "windows12_v").count() == 12
