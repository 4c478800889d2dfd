"""Merges over stored folders, entity merges, guards, validators, and results that no session zone changes."""

import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tagflow import registry
from tagflow.functions.normalize import canonical, observation_hash
from tagflow.operators import coverage, fanout, guard, merge, relate, validators
from tagflow.operators.store import HistoryStore

DATA = "/root/testdata/sf0.001"


def samples(spark, rows):
    df = spark.createDataFrame(rows, "batch_id string, point_id string, at string, val string").selectExpr("batch_id", "'t' AS tenant_id", "'1' AS project_id", "point_id", "cast(at AS timestamp_ntz) AS observed_at", "'str' AS value_kind", "val AS val_str")
    return df


def test_a_put_reads_only_the_days_that_it_stages(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path / "s"), buckets=4)
    store.put(samples(spark, [("a", f"p-{k}", f"2024-01-{d:02d} 10:00:00", "x") for k in range(8) for d in range(1, 6)]), 0)
    staged = samples(spark, [("b", "p-1", "2024-01-02 10:00:00", "y"), ("b", "p-1", "2024-01-02 11:00:00", "z")])
    near = store.near(store.prepared(staged))
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "obs_date" in plan.split("PartitionFilters: [")[1].split("]")[0] and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0] and "GreaterThanOrEqual(observed_at" in plan.split("PushedFilters: [")[1].split("]")[0]
    assert all("obs_date=2024-01-02" in f for f in near.inputFiles())
    for bad in (tmp_path / "s" / "base" / "obs_date=2024-01-04").rglob("*.parquet"):
        bad.write_bytes(b"not parquet")
    got = store.put(staged, 1).first()
    assert (got.staged, got.inserted, got.revised, got.refused) == (2, 1, 1, 0)
    with pytest.raises(Exception):
        store.read().agg(F.count("val_str")).collect()


def one_by_one(base, staged, policy):
    """What a sequence of batches does to a store, each batch for itself."""
    base, revisions, told = dict(base), set(), {}
    for batch, group in itertools.groupby(sorted(staged), key=lambda r: r[0]):
        rows = [(p, at, v) for _, p, at, v in group]
        twice = len({(p, at) for p, at, _ in rows}) < len(rows)
        odd = any(base.get((p, at), v) != v for p, at, v in rows)
        if twice or (odd and policy == "reject"):
            told[batch] = "double_key" if twice else "conflict"
            continue
        told[batch] = ""
        for p, at, v in rows:
            if (p, at) not in base:
                base[p, at] = v
            elif base[p, at] != v:
                revisions.add((p, at, v))
    return base, revisions, told


@pytest.mark.parametrize("policy", merge.POLICIES)
def test_puts_are_as_batches_one_by_one(spark, tmp_path, policy):
    import random

    r = random.Random(3)
    at = lambda: f"2024-01-0{r.randrange(1, 4)} 0{r.randrange(3)}:00:00"
    base = {(f"p-{r.randrange(6)}", at()): r.choice("xy") for _ in range(25)}
    staged = [(f"b{k}", f"p-{r.randrange(6)}", at(), r.choice("xy")) for k in range(14) for _ in range(3)]
    store = HistoryStore(spark, str(tmp_path / "s"), buckets=2, policy=policy)
    store.put(samples(spark, [("first", p, t, v) for (p, t), v in base.items()]), -1)
    want = one_by_one(base, staged, policy)
    told = {}
    # batches together where that is the same by definition, one put each where a refusal may matter
    groups = [staged] if policy == "append_revision" else [[x for x in staged if x[0] == b] for b in sorted({x[0] for x in staged})]
    for k, group in enumerate(groups):
        told |= {x.batch_id: x.reason for x in store.put(samples(spark, group), k).collect()}
    held = {(x.point_id, str(x.observed_at)): x.val_str for x in store.read().collect()}
    kept = Counter((x.point_id, str(x.observed_at), x.val_str) for x in store.read("revisions").collect())
    assert told == want[2] and held == want[0] and store.read().count() == len(held) and kept == Counter(want[1]) and {"double_key", ""} <= set(told.values())


def test_staged_batches_that_contradict_one_another(spark):
    staged = samples(spark, [("a", "p", "2024-01-01", "x"), ("b", "p", "2024-01-01", "y"), ("c", "q", "2024-01-01", "x"), ("c", "q", "2024-01-01", "x"), ("d", "q", "2024-01-01", "x"), ("e", "q", "2024-01-01", "x")])
    staged = staged.withColumn("row_hash", observation_hash(staged))
    told = lambda policy: {r.batch_id: r.action for r in merge.merged(staged.limit(0), staged, policy).collect()}
    assert told("append_revision") == {"a": "insert", "b": "revision", "c": "refused", "d": "insert", "e": "ignore"}
    assert told("reject") == {"a": "insert", "b": "refused", "c": "refused", "d": "insert", "e": "ignore"}
    with pytest.raises(ValueError):
        told("overwrite")


ENTITY = "kind string, source_id string, site_ref string, equipment_ref string, historized boolean, payload string"


def test_entities_are_known_by_kind_and_id(spark):
    rows = [("equipment", "1", "s", None, False, "e"), ("point", "1", "s", "1", True, None)]
    now = spark.createDataFrame(rows, ENTITY)
    before = now.withColumn("last_seen", F.lit("run-0"))
    assert merge.entity_changes(harvest=now, published=before).count() == 0 and merge.merge_metadata_revisions(harvest=now, published=before).count() == 0
    after = merge.upsert_entities(harvest=now.where("kind = 'point'"), published=before, run_id="run-1")
    assert {(r.kind, r.last_seen, r.payload) for r in after.collect()} == {("equipment", "run-0", "e"), ("point", "run-1", None)} and after.columns == before.columns
    runs = now.withColumns({"run_id": F.lit("r"), "scheduled_at": F.lit("2024-01-02").cast("timestamp_ntz")})
    told = spark.createDataFrame([("q", "2024-01-01")], "run_id string, at string").selectExpr("run_id", "cast(at AS timestamp_ntz) AS scheduled_at")
    assert merge.publish(runs, before, told, "r").count() == 2 and merge.publish(runs, before, told.limit(0), "r").count() == 2
    for harvest, published, why in ((runs.where("kind = 'point'"), told, "shrinks"), (runs, told.withColumn("scheduled_at", F.lit("2024-02-01").cast("timestamp_ntz")), "older"), (runs.limit(0), told, "no entities")):
        with pytest.raises(ValueError, match=why):
            merge.publish(harvest, before, published, "r")


def test_validators_are_folded_in_order(spark):
    batches = spark.createDataFrame([(b,) for b in "abcdef"], "batch_id string")
    says = lambda rows: lambda frames: spark.createDataFrame(rows, "batch_id string, ok boolean, reason string")
    one = says([("a", True, ""), ("b", False, "first"), ("c", True, ""), ("d", None, None), ("e", True, ""), ("e", False, "again")])
    two = says([("a", True, ""), ("b", False, "second"), ("c", False, "second"), ("d", True, ""), ("e", True, ""), ("f", True, "")])
    told = validators.fold(batches, [one, two], {})
    assert {r.batch_id: r.reason for r in told.collect()} == {"a": "", "b": "first", "c": "second", "d": "refused", "e": "again", "f": "no_verdict"}
    rows = spark.createDataFrame([("a", 1), (None, 2), ("b", 3), ("z", 4)], "batch_id string, v int")
    good, bad = validators.settled(rows, told)
    assert [r.v for r in good.collect()] == [1] and {r.v for r in bad.collect()} == {2, 3, 4}
    with pytest.raises(ValueError):
        validators.fold(batches, [], {})


def test_a_validator_of_ones_own(spark):
    few = lambda frames: frames["rows"].groupBy("batch_id").agg(F.count("*").alias("n")).select("batch_id", (F.col("n") < 2).alias("ok"), F.lit("many").alias("reason"))
    name = "few_rows"
    validators.register(name, few)
    try:
        rows = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2)], "batch_id string, v int")
        assert {r.batch_id: r.reason for r in validators.fold(rows, validators.NAMED[name], {"rows": rows}).collect()} == {"a": "", "b": "many"}
        with pytest.raises(ValueError):
            validators.register(name, few)
    finally:
        del validators.NAMED[name]


def test_the_guard_names_the_first_difference(spark):
    plan = spark.createDataFrame([(b, ["p", "q"], "2024-01-01T06:00:00+06:00", "2024-01-01T00:05:00Z") for b in "abcdefgh"], "batch_id string, scope array<string>, window_start string, window_end string")
    at = "2024-01-01 00:01:00"
    rows = samples(spark, [("a", "p", at, "x"), ("a", "q", at, "x"), ("b", "r", at, "x"), ("c", "p", "2024-01-01 00:05:00", "x"), ("d", "p", at, "x"), ("d", "p", at, "y"), ("e", "p", at, "x"), ("f", "p", at, "x"), ("f", "q", at, "x"), ("g", "p", at, "x" * 3_000)])
    own = rows.withColumn("row_hash", F.when(F.col("batch_id") == "e", "changed").otherwise(observation_hash(rows)))
    sums = guard.checksums(guard.lined(own, "history"), 100, 10_000)
    keys = plan.select("batch_id").join(sums, "batch_id", "left").select("batch_id", guard.batch_key("history", F.coalesce("checksum", F.sha2(F.lit(""), 256))).alias("batch_key"))
    told = lambda keys, **caps: {r.batch_id: r.reason for r in guard.sink_guard(plan=plan, carried=own, receipts=keys, **caps).collect()}
    want = {"a": "", "b": "scope", "c": "window", "d": "duplicate", "e": "row_hash", "f": "", "g": "", "h": ""}
    assert told(keys) == want
    assert told(keys, max_rows=1) == want | {"a": "row_cap", "f": "row_cap"} and told(keys, max_bytes=2_000) == want | {"g": "byte_cap"}
    assert told(keys.withColumn("batch_key", F.when(F.col("batch_id") != "h", "k")))["a"] == "batch_key" and told(keys.withColumn("batch_key", F.lit(None).cast("string")))["h"] == "batch_key"
    assert canonical(b=F.lit(1), a=F.lit(None).cast("string")) is not None


def test_audits_fail_where_rows_are_missing(spark, tmp_path):
    frame = lambda name: registry.GRAPH.frame(spark, DATA, name)
    points, history, covered = frame("classify_points"), frame("history_v"), frame("hour_coverage")
    told = fanout.coverage_audit(points=points, history=history, coverage=covered.where("NOT (minute(window_start) = 10 AND point_id > 'p-5')"))
    assert {r.verdict for r in told.where("minute(window_start) = 10").collect()} == {"FAIL"} and {r.verdict for r in told.where("minute(window_start) <> 10").collect()} == {"PASS"}
    made = frame("replicate_equipment")
    assert {r.verdict for r in fanout.replica_audit(virtual=made.where("i <> 3"), real_equipment=frame("real_equipment_v")).collect()} == {"PASS", "FAIL"}
    audit = lambda out: {r.w: r.verdict for r in fanout.hour_fan_out(points, history, out, 2_000, "2024-01-03 10:00:00", shard_rows=700).collect()}
    out = str(tmp_path / "h")
    assert audit(out) == {w: "PASS" for w in range(12)}
    shards = sorted((tmp_path / "h" / "w=4").glob("*.csv.gz"))
    assert len(shards) == 3
    real = fanout._real_windows(points, history, "2024-01-03 10:00:00", 12)
    shards[1].unlink()
    (tmp_path / "h" / "w=4" / f".{shards[1].name}.crc").unlink(missing_ok=True)
    after = {r.w: r.verdict for r in fanout.hour_audit(real, out, 2_000, shard_rows=700).collect()}
    assert after == {w: "FAIL" if w == 4 else "PASS" for w in range(12)}


def test_a_large_real_site_is_joined_by_shuffle(spark, tmp_path, monkeypatch):
    frame = lambda name: registry.GRAPH.frame(spark, DATA, name)
    points, history = frame("classify_points"), frame("history_v")
    read = lambda out: Counter(map(tuple, spark.read.options(header=True, escape='"').csv(out).collect()))
    fanout.hour_fan_out(points, history, str(tmp_path / "a"), 3_000, "2024-01-03 10:00:00", windows=2, shard_rows=800)
    monkeypatch.setattr(fanout, "BROADCAST_REAL", 0)
    told = fanout.hour_fan_out(points, history, str(tmp_path / "b"), 3_000, "2024-01-03 10:00:00", windows=2, shard_rows=800)
    assert read(str(tmp_path / "a")) == read(str(tmp_path / "b")) and {r.verdict for r in told.collect()} == {"PASS"}


def test_shuffled_fan_out_cuts_no_shard(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fanout, "BROADCAST_REAL", 0)
    monkeypatch.setattr(fanout, "TASK_ROWS", 1_000)
    points, history = (registry.GRAPH.frame(spark, DATA, n) for n in ("classify_points", "history_v"))
    told = fanout.hour_fan_out(points, history, str(tmp_path / "c"), 3_000, "2024-01-03 10:00:00", windows=2, shard_rows=70).collect()
    assert [(r.rows, r.shards, r.verdict) for r in told] == [(3_000, 43, "PASS")] * 2
    for w in ("w=0", "w=1"):
        names = sorted([r[0] for r in spark.read.csv(str(f), header=True).select("virtual_point").collect()] for f in (tmp_path / "c" / w).glob("*.csv.gz"))
        assert sorted(map(len, names)) == [3_000 % 70] + [70] * 42 and len({v for f in names for v in f}) == 3_000


def test_spines_refuse_too_many_windows_and_days(spark, monkeypatch):
    points = spark.createDataFrame([("p", "accepted")], "id string, outcome string")
    windows = spark.range(20).selectExpr("cast(id AS int) AS window_no")
    assert relate.coverage_spine(points=points, windows=windows).count() == 20
    monkeypatch.setattr(relate, "MOST_WINDOWS", 10)
    with pytest.raises(Exception, match="too many windows"):
        relate.coverage_spine(points=points, windows=windows).collect()
    monkeypatch.setattr(fanout, "MOST_DAYS", 1)
    with pytest.raises(Exception, match="too many days"):
        registry.QUERIES["rule_scope_coverage"](spark, DATA).collect()


def test_pins_are_written_once(spark, tmp_path):
    kind = "due_id long, s string"
    dues = spark.createDataFrame([(1, "2024-01-02 00:00:00"), (2, "2024-01-02 12:00:00"), (3, "2023-01-01 00:00:00")], kind).selectExpr("due_id", "cast(s AS timestamp_ntz) AS due_at")
    eligible = lambda rows: spark.createDataFrame(rows, "version string, s string").selectExpr("version", "cast(s AS timestamp_ntz) AS certified_at")
    old, new = ("v1", "2024-01-01 00:00:00"), ("v2", "2024-01-01 12:00:00")
    root = str(tmp_path / "pins")
    state = lambda rows, put: {r.due_id: (r.version, r.state) for r in relate.pin_versions(dues, eligible(rows), root, put).collect()}
    assert state([old], 0) == {1: ("v1", "selected"), 2: ("v1", "selected"), 3: (None, "none_eligible")}
    assert state([old], 0) == {1: ("v1", "selected"), 2: ("v1", "selected"), 3: (None, "none_eligible")}
    assert state([old, new], 1) == {1: ("v1", "pinned"), 2: ("v1", "pinned"), 3: (None, "none_eligible")}
    assert state([new], 2) == {1: (None, "pin_not_eligible"), 2: (None, "pin_not_eligible"), 3: (None, "none_eligible")}
    assert {tuple(r) for r in relate.read_pins(spark, root).collect()} == {(1, "v1"), (2, "v1")}


ZONED = ("local_day_window", "rules_days", "replay_filter", "history_rows", "instants", "history_windows", "lookback_windows", "asof_inventory", "window_summary", "hour_coverage", "sink_guard", "merge_history")


@pytest.mark.parametrize("zone", ["America/Chicago", "Asia/Kolkata", "Australia/Lord_Howe"])
def test_no_session_zone_changes_a_result(spark, zone):
    rows = lambda: {n: Counter(str(tuple(r)) for r in registry.QUERIES[n](spark, DATA).collect()) for n in ZONED}
    want = rows()
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = rows()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [n for n in ZONED if got[n] != want[n]] == []


def test_a_caps_bytes_count_null_fields(spark):
    plan = spark.createDataFrame([("a",), ("b",)], "batch_id string")
    rows = spark.createDataFrame([("a", None, 1, None), ("a", "p", 2, "k")], "batch_id string, point_id string, row_no long, value_kind string")
    got = {r.batch_id: (r.n_rows, r.bytes) for r in coverage.size_caps(plan=plan, rows=rows).collect()}
    assert got == {"a": (2, len('{"point_id":null,"row_no":1,"value_kind":null}') + len('{"point_id":"p","row_no":2,"value_kind":"k"}') + 2), "b": (0, 0)}
