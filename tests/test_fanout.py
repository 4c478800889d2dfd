"""The feeds of virtual sites by brute force."""

from collections import Counter

from pyspark.sql import functions as F

from tagflow import registry
from tagflow.operators import fanout

DATA = "/root/testdata/sf0.001"


def test_feeds_by_brute_force(spark, tmp_path):
    frame = lambda name: registry.GRAPH.frame(spark, DATA, name)
    views = {"real_equipment": frame("real_equipment_v"), "real_points": frame("real_points_v"), "history": frame("history_v"), "detections": frame("detections_v")}
    first = views["history"].agg(F.date_trunc("hour", F.min("observed_at")).alias("h")).first().h
    made = fanout.fan_out_feeds(**views, out=str(tmp_path), n=30, m=4, window=str(first))
    equipment, points = {}, {}
    for r in views["real_equipment"].collect():
        equipment.setdefault(r.site_ref, []).append(r.id)
    for r in views["real_points"].collect():
        points.setdefault(r.site_ref, []).append(r.id)
    want = {(f"{s}.e{i:02d}.{sorted(own)[i % len(own)]}", sorted(own)[i % len(own)]) for s, own in equipment.items() for i in range(30)}
    assert {(r.virtual_id, r.source_id) for r in made["equipment"].collect()} == want
    got = {r.virtual_point: r.parent for r in made["points"].collect()}
    for s, own in points.items():
        for i in range(30):
            for p in range(4):
                real = sorted(own)[(i * 4 + p) % len(own)]
                assert got.pop(f"{s}.e{i:02d}.p{p}.{real}").startswith(f"{s}.e{i:02d}.")
    assert not got and made["history"].count() == made["points"].count() and made["rules"].count() == made["equipment"].count()
    day = max(r.rule_date for r in views["detections"].collect())
    per = Counter(r.targetRef for r in views["detections"].collect() if r.rule_date == day)
    assert all(r.detections == per[r.virtual_id.split(".", 2)[2]] for r in made["rules"].collect())
    assert made["detections"].agg(F.sum("n")).first()[0] == made["rules"].agg(F.sum("detections")).first()[0]


def _shuffled(spark, run) -> int:
    """Records that shuffles write in ``run``."""
    bus, store = spark.sparkContext._jsc.sc().listenerBus(), spark._jsparkSession.sharedState().statusStore()
    bus.waitUntilEmpty()
    before = store.executionsCount()
    run()
    bus.waitUntilEmpty()
    done, told = store.executionsList(), 0
    for execution in (done.apply(k) for k in range(before, done.size())):
        values, metrics = store.executionMetrics(execution.executionId()), execution.metrics()
        for metric in (metrics.apply(k) for k in range(metrics.size())):
            value = values.get(metric.accumulatorId())
            if metric.name() == "shuffle records written" and value.isDefined():
                told += int(value.get().replace(",", ""))
    return told


def test_copies_are_shuffled_once_and_not_by_window(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fanout, "BROADCAST_REAL", 0)
    points, history = (registry.GRAPH.frame(spark, DATA, n) for n in ("classify_points", "history_v"))
    told = []
    records = _shuffled(spark, lambda: told.extend(fanout.hour_fan_out(points, history, str(tmp_path / "all"), 9_000, "2024-01-03 10:00:00", shard_rows=800).collect()))
    assert 9_000 <= records < 12 * 9_000 and {(r.rows, r.shards, r.verdict) for r in told} == {(9_000, 12, "PASS")}
    # shards so long that a task has some of their windows only: the same rows, in order
    monkeypatch.setattr(fanout, "TASK_ROWS", 4_000)
    told = fanout.hour_fan_out(points, history, str(tmp_path / "few"), 9_000, "2024-01-03 10:00:00", shard_rows=5_000).collect()
    assert {(r.rows, r.shards, r.verdict) for r in told} == {(9_000, 2, "PASS")}
    read = lambda out: Counter(map(tuple, spark.read.options(header=True, escape='"').csv(out).collect()))
    assert read(str(tmp_path / "all")) == read(str(tmp_path / "few"))
    for file in (tmp_path / "few").rglob("*.csv.gz"):
        rows = spark.read.csv(str(file), header=True).selectExpr("cast(copy AS int) AS copy", "site_ref", "source_id").collect()
        assert [tuple(r) for r in rows] == sorted(map(tuple, rows))


def test_ids_of_other_sites_are_rejected(spark):
    df = spark.createDataFrame([("s", "s.e0.p1.real.x"), ("s", "t.e0.p1.real"), ("s", "s.e0.real"), ("s", "s.ex.p1.real")], "site string, v string")
    assert [r[0] for r in df.select(fanout.real_id(F.col("site"), F.col("v"), points=True)).collect()] == ["real.x", None, None, None]
