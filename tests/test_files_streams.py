"""Round trips of readers and writers, and a stream against its batch form."""

import json

import pytest
from pyspark.sql import functions as F

from tagflow.functions import normalize
from tagflow.sources import files
from tagflow.streaming import streams


def test_export_header_and_rows(spark, tmp_path):
    (tmp_path / "points.csv").write_text("﻿fsk,id,siteRef\n1001,p-1,s\n1001,p-2,\n", encoding="utf-8")
    df = files.read_entity_export(spark, str(tmp_path / "points.csv"), ["fsk", "id"])
    assert [r.id for r in df.orderBy("id").collect()] == ["p-1", "p-2"]
    with pytest.raises(ValueError):
        files.read_entity_export(spark, str(tmp_path / "points.csv"), ["equipRef"])


def test_certified_jsonl_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "batch string, v int")
    manifest = files.write_certified_jsonl(rows, "batch", str(tmp_path / "j"))
    back, bad = files.read_certified_jsonl(spark, str(tmp_path / "j"), "batch string, v int", manifest)
    assert back.count() == 3 and bad.count() == 0
    assert all(r.ends_in_newline for r in files.file_fingerprints(spark, str(tmp_path / "j" / "*" / "*.json")).collect())
    with pytest.raises(Exception):
        files.write_certified_jsonl(rows, "batch", str(tmp_path / "j"))


def test_inventory(spark, tmp_path):
    (tmp_path / "i.json").write_text('{"version":"1","sites":{"s":{"equipment_ids":["e"],"point_ids":["p","q"],"historized_point_ids":[]}}}')
    got = {(r.kind, r.id) for r in files.read_inventory(spark, str(tmp_path / "i.json")).collect()}
    assert got == {("equipment", "e"), ("point", "p"), ("point", "q")}


def test_landed_pages(spark, tmp_path):
    meta = {"project": "1001", "site": "s", "complete": True, "returned_rows": 2, "total_rows": 2}
    cols = [{"name": "ts", "meta": {}}, {"name": "v0", "meta": {"id": "p-1"}}, {"name": "p-2"}]
    rows = [{"ts": "t1", "v0": 1.5, "p-2": None}, {"ts": "t2", "p-2": {"_kind": "na"}, "stray": 1}]
    (tmp_path / "h.json").write_text(json.dumps({"meta": meta | {"requested_ids": ["p-1", "p-2"], "truncated": False}, "cols": cols, "rows": rows}))
    (tmp_path / "m.json").write_text(json.dumps({"meta": meta | {"snapshot": "x", "page_index": 0, "next_page": None}, "rows": []}))
    (tmp_path / "r.json").write_text(json.dumps({"meta": meta | {"day": "2024-01-01", "requested_count": "two"}, "rows": rows}))
    pages = files.read_history_pages(spark, str(tmp_path / "h.json"))
    page = pages.first()
    assert page.requested_ids == ["p-1", "p-2"] and page.complete and page.truncated is False and page.actual_rows == page.total_rows == 2
    cells = files.history_wide_to_long(pages).selectExpr("point_id", "ts", "to_json(cell) AS cell").collect()
    assert {tuple(c) for c in cells} == {("p-1", "t1", "1.5"), ("p-2", "t2", '{"_kind":"na"}')}
    m = files.read_metadata_pages(spark, str(tmp_path / "m.json")).first()
    assert m.snapshot == "x" and m.page_index == 0 and m.next_page is None and m.actual_rows == 0
    r = files.read_rules_pages(spark, str(tmp_path / "r.json")).first()
    assert r.day == "2024-01-01" and r.requested_count is None and r.timezone is None


def test_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "events.parquet"
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").write.parquet(str(src))
    counts = streams.stream_tumbling(streams.stream_table(spark, str(tmp_path), "events"))
    q = counts.writeStream.outputMode("complete").format("memory").queryName("tumbling").trigger(availableNow=True).start()
    q.awaitTermination(120)
    batch = spark.read.parquet(str(src)).withColumn("ts", F.col("ts").cast("timestamp")).groupBy(F.window("ts", "5 minutes").start.alias("s"), "event_type").count()
    assert {tuple(r) for r in spark.table("tumbling").collect()} == {tuple(r) for r in batch.collect()}


def test_normalise_columns(spark):
    df = spark.createDataFrame([("r:a.b Name",), ("bad id!",), ("m:",), ("maybe",), ("n:4 kW",), ("p-1 x",), ("m:abc",), ("p-1",)], "v string")
    got = [tuple(r) for r in df.select(normalize.normalise_ref(F.col("v")), normalize.historized_flag(F.col("v")), normalize.flatten_kind(F.col("v"))).collect()]
    assert got[0][0] == "a.b" and got[2][1] is True and got[3][1] is None and got[4][2] == "4" and got[2][2] == "true"
    assert [r[0] for r in got] == ["a.b", None, "m:", "maybe", None, None, "m:abc", "p-1"] and got[6][2] == "true"
    typed = spark.sql("SELECT parse_json(x) AS v FROM VALUES ('true'), ('1'), ('\"1\"'), ('{\"_kind\":\"na\"}') t(x)")
    rows = typed.select(*(c.alias(k) for k, c in normalize.typed_value(F.col("v")).items())).collect()
    assert [r.val_bool for r in rows] == [True, None, None, None] and rows[1].val_num == 1 and rows[2].val_str == "1" and rows[3].val_na


def _run(spark, df, name, mode="append"):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    assert q.awaitTermination(180)
    return spark.table(name).collect()


def test_checkpoint_moves_over_windows_without_gaps(spark, tmp_path):
    steps = [[("a", 0, 0), ("a", 2, 0), ("b", 1, 0), ("b", None, 0)], [("a", 1, 60), ("a", 2, 60)], [("b", 0, 120), ("a", 0, 120), ("a", 5, 120)], [("end", 0, 9000)]]
    for i, rows in enumerate(steps):
        spark.createDataFrame(rows, "site_ref string, window_no int, s long").selectExpr("site_ref", "window_no", "timestamp_seconds(s + 1700000000) AS at").coalesce(1).write.parquet(str(tmp_path / f"d{i}"))
    raw = spark.readStream.schema("site_ref string, window_no int, at timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "d*"))
    got = [(r.site_ref, r.through, r.gaps, r.stuck) for r in _run(spark, streams.stream_checkpoint(raw, wait_seconds=600), "cursors") if r.site_ref != "end"]
    assert len(got) == len(set(got))
    assert {s: max(t for x, t, _, _ in got if x == s) for s in "ab"} == {"a": 2, "b": 1}
    # a waits for 3 and 4 behind 5, and is told of once its wait is over; b never is
    assert [x for x in got if x[3]] == [("a", 2, 1, True)]


def test_coverage_of_batches(spark, tmp_path):
    rows = [("j1", "p", 0), ("j1", "q", 60), ("j2", "p", 10), ("late", "z", 3600)]
    df = spark.createDataFrame(rows, "batch_id string, id string, s long").selectExpr("batch_id", "id", "timestamp_seconds(s) AS ts")
    df.coalesce(1).write.parquet(str(tmp_path / "r"))
    batches = spark.createDataFrame([("j1", ["p", "q"]), ("j2", ["p", "q"])], "batch_id string, scope_ids array<string>")
    raw = spark.readStream.schema(df.schema).parquet(str(tmp_path / "r"))
    got = {(r.batch_id, r.n_seen, r.n_missing, r.complete) for r in _run(spark, streams.stream_coverage(raw, batches), "covered")}
    assert got == {("j1", 2, 0, True), ("j2", 1, 1, False)}


def test_exports_are_checked(spark, tmp_path):
    (tmp_path / "points.csv").write_text("fsk,id\n1001,p-1\n1001,p-2,more\n")
    (tmp_path / "equipment.csv").write_text("fsk,id\n1001,e-1\n1001,e-2\n")
    with pytest.raises(ValueError, match="cells"):
        files.read_entity_export(spark, str(tmp_path / "points.csv"), ["id"])
    for caps in ({"max_rows": 1}, {"max_bytes": 5}):
        with pytest.raises(ValueError, match="over"):
            files.read_entity_export(spark, str(tmp_path / "equipment.csv"), ["id"], **caps)
    assert files.read_export_set(spark, str(tmp_path), {"equipment": ["fsk", "id"]})["equipment"].count() == 2


def test_latest_export_is_the_newest_file(spark, tmp_path):
    import os

    for k, name in enumerate(("b.csv", "a.csv")):
        (tmp_path / name).write_text("x\n")
        os.utime(tmp_path / name, (1_700_000_000 + k * 100,) * 2)
    assert files.latest_export(spark, str(tmp_path / "*.csv")).first().path.endswith("a.csv")


def test_files_against_receipts(spark, tmp_path):
    import hashlib

    for name, text in (("a.jsonl", "{}\n"), ("b.jsonl", "{}"), ("c.jsonl", "x\n"), ("d.jsonl", "y\n"), ("e.jsonl", "z\n")):
        (tmp_path / name).write_text(text)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    receipts = [("a.jsonl", sha("{}\n"), 3), ("b.jsonl", sha("{}"), 2), ("c.jsonl", sha("q\n"), 2), ("d.jsonl", sha("y\n"), 9), ("gone.jsonl", sha(""), 0)]
    got = files.verify_files(spark, str(tmp_path), spark.createDataFrame(receipts, "file string, sha256 string, length long"))
    assert {tuple(r) for r in got.collect()} == {("a.jsonl", "ok"), ("b.jsonl", "no_newline"), ("c.jsonl", "sha256"), ("d.jsonl", "length"), ("e.jsonl", "unexpected"), ("gone.jsonl", "missing")}


def test_certified_batches_are_bounded_and_withheld(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "batch string, v int")
    with pytest.raises(ValueError, match="cap"):
        files.write_certified_jsonl(rows, "batch", str(tmp_path / "no"), max_rows=1)
    assert not (tmp_path / "no").exists()
    manifest = files.write_certified_jsonl(rows, "batch", str(tmp_path / "j"))
    assert {(r.batch_key, r.row_count, r.bytes) for r in manifest.collect()} == {("a", 2, 40), ("b", 1, 20)}
    assert sum(x.stat().st_size for x in (tmp_path / "j").glob("*/*.json")) == 60
    wrong = manifest.selectExpr("batch_key", "if(batch_key = 'a', 5, row_count) AS row_count")
    good, bad = files.read_certified_jsonl(spark, str(tmp_path / "j"), "batch string, v int", wrong)
    assert [r.v for r in good.collect()] == [3] and [r.batch_key for r in bad.collect()] == ["a"]


def test_inventory_is_checked_and_never_changed(spark, tmp_path):
    (tmp_path / "i.json").write_text('{"version":"1","tenant_id":"t","project_id":"p","sites":{"s":{"equipment_ids":["e"],"point_ids":["q"],"historized_point_ids":[]}}}')
    assert files.read_inventory(spark, str(tmp_path / "i.json"), tenant="t", project="p", sites={"s"}).count() == 2
    for wrong in ({"tenant": "x"}, {"sha256": "0"}, {"sites": {"s", "z"}}):
        with pytest.raises(ValueError):
            files.read_inventory(spark, str(tmp_path / "i.json"), **wrong)
    rows = spark.createDataFrame([("s", "point", "b"), ("s", "point", "a"), ("s", "point", "a"), ("z", "equipment", "e")], "site_ref string, kind string, id string")
    path = files.write_inventory(rows, str(tmp_path / "o"), "t", "p", "run")
    assert path == files.write_inventory(rows.orderBy("id"), str(tmp_path / "o"), "t", "p", "run")
    assert {tuple(r) for r in files.read_inventory_version(spark, path).collect()} == {tuple(r) for r in rows.collect()}
    spark.createDataFrame([("s", "point", ["x"], "h")], "site_ref string, kind string, ids array<string>, hash string").write.mode("overwrite").json(path)
    with pytest.raises(ValueError):
        files.read_inventory_version(spark, path)


def test_raw_manifest_refuses_cut_responses(spark, tmp_path):
    (tmp_path / "land").mkdir()
    (tmp_path / "land" / "x.bin").write_text("data")
    batches = spark.createDataFrame([("b", ["p", "q"])], "batch_id string, scope_ids array<string>")
    kind = "batch_id string, file string, query_id string, completed_ids array<string>, row_count long, truncated boolean"
    good = ("b", "x.bin", "q1", ["q", "p"], 3, False)
    for k, bad in enumerate(((*good[:5], True), (*good[:3], ["p"], 3, False), ("b", "x.bin", "", ["p", "q"], 3, False), ("b", "y.bin", "q1", ["p", "q"], 3, False))):
        with pytest.raises(ValueError):
            files.write_raw_manifest(spark, str(tmp_path / "land"), spark.createDataFrame([bad], kind), batches, str(tmp_path / f"m{k}"))
    done = files.write_raw_manifest(spark, str(tmp_path / "land"), spark.createDataFrame([good], kind), batches, str(tmp_path / "m")).first()
    assert done.byte_count == 4 and spark.read.json(str(tmp_path / "m")).count() == 1


def test_raw_files_are_listed_by_tasks_in_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "FOLDER_FILES", 20)
    contents = spark.range(1_000).selectExpr("concat('b/', id) AS name", "concat('text ', id) AS content")
    land = tmp_path / "land"
    for _ in range(2):  # again, as after a failure
        named = {r.name: r.file for r in files.write_files(contents, f"file://{land}").collect()}
    assert sorted(str(f.relative_to(land)) for f in land.rglob("*") if f.is_file()) == sorted(named.values()) and (land / named["b/7"]).read_text() == "text 7"
    assert max(sum(1 for _ in d.iterdir()) for d in land.iterdir()) < 60
    batches = contents.selectExpr("name AS batch_id", "array(name) AS scope_ids")
    receipts = spark.createDataFrame([(n, f, "q", [n], 1, False) for n, f in named.items()], "batch_id string, file string, query_id string, completed_ids array<string>, row_count long, truncated boolean")
    made = files.write_raw_manifest(spark, f"file://{land}", receipts, batches, str(tmp_path / "m"), nested=True)
    assert made.count() == 1_000 and made.where("batch_id = 'b/7' AND byte_count = 6 AND checksum = sha2('text 7', 256)").count() == 1
    assert not any(str(land) in f for f in made.inputFiles())
    for k, extra in enumerate((land / "x.txt", (land / named["b/7"]).parent / "x.txt", land / "more" / "x.txt")):
        extra.parent.mkdir(exist_ok=True)
        extra.write_text("x")
        with pytest.raises(ValueError, match="no_receipt"):
            files.write_raw_manifest(spark, f"file://{land}", receipts, batches, str(tmp_path / f"e{k}"), nested=True)
        extra.unlink()
    (land / named["b/9"]).unlink()
    with pytest.raises(ValueError, match="no_file"):
        files.write_raw_manifest(spark, f"file://{land}", receipts, batches, str(tmp_path / "l"), nested=True)


def test_history_days_are_replaced_and_shards_bounded(spark, tmp_path):
    day = lambda d, v: spark.createDataFrame([(v, d)], "v int, d string").selectExpr("v", "cast(d AS timestamp) AS observed_at")
    files.write_history(day("2024-01-01", 1).union(day("2024-01-02", 2)), str(tmp_path / "h"))
    files.write_history(day("2024-01-02", 3), str(tmp_path / "h"))
    assert {r.v for r in spark.read.parquet(str(tmp_path / "h")).collect()} == {1, 3}
    files.write_csv_shards(spark.range(10).coalesce(1), str(tmp_path / "c"), max_rows=4, gzip=True)
    assert len(list((tmp_path / "c").glob("*.csv.gz"))) == 3 and spark.read.csv(str(tmp_path / "c"), header=True).count() == 10
    foot = files.dataset_footprint(spark, {"h": str(tmp_path / "h")}, max_objects=1).first()
    assert foot.objects == 1 and foot.rows == 2 and not foot.complete


def test_stream_of_landed_pages(spark, tmp_path):
    page = {"meta": {"project": "1"}, "cols": [{"name": "ts", "meta": {}}, {"name": "p-1"}], "rows": [{"ts": "t1", "p-1": 2}]}
    for k in range(3):
        (tmp_path / f"{k}.json").write_text(json.dumps(page))
    pages = streams.stream_pages(spark, str(tmp_path)).selectExpr("path", "size(rows) AS n", "variant_get(meta, '$.project', 'string') AS project")
    assert [(r.n, r.project) for r in _run(spark, pages, "pages")] == [(1, "1")] * 3


def test_stream_dedup(spark, tmp_path):
    rows = spark.createDataFrame([("a", 0), ("a", 1), ("b", 2)], "publication_id string, s long").selectExpr("publication_id", "timestamp_seconds(s) AS at")
    rows.write.parquet(str(tmp_path / "f"))
    raw = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "f"))
    assert sorted(r.publication_id for r in _run(spark, streams.stream_dedup(raw, "publication_id", "at"), "feed")) == ["a", "b"]


def test_stream_merge_twice_changes_nothing(spark, tmp_path):
    from tagflow.operators.store import HistoryStore

    kind = "batch_id string, point_id string, observed_at string, val_num string"
    typed = lambda rows: spark.createDataFrame(rows, kind).selectExpr("batch_id", "'t' AS tenant_id", "'1' AS project_id", "point_id", "cast(observed_at AS timestamp_ntz) AS observed_at", "'num' AS value_kind", "cast(val_num AS decimal(18,2)) AS val_num")
    first = typed([("a", "p", "2024-01-01", "1"), ("a", "q", "2024-01-01", "2")])
    second = typed([("b", "p", "2024-01-01", "9"), ("b", "q", "2024-01-01", "2"), ("b", "r", "2024-01-02", None)])
    store = HistoryStore(spark, str(tmp_path / "store"), buckets=2)
    apply = streams.merge_into(store)
    for batch_id, batch in enumerate((first, second, second)):
        apply(batch, min(batch_id, 1))
    assert {(r.point_id, r.val_num and float(r.val_num)) for r in store.read().collect()} == {("p", 1.0), ("q", 2.0), ("r", None)} and store.read().count() == 3
    assert [(r.point_id, float(r.val_num)) for r in store.read("revisions").collect()] == [("p", 9.0)]
    second.write.parquet(str(tmp_path / "s"))
    raw = spark.readStream.schema(second.schema).parquet(str(tmp_path / "s"))
    assert streams.stream_merge(raw, lambda b, k: apply(b, k + 2), str(tmp_path / "cp")).awaitTermination(120)
    assert store.read().count() == 3 and store.read("revisions").count() == 1


def test_files_with_columns_in_other_orders_are_read_by_name(spark, tmp_path):
    import gzip

    folder = tmp_path / "e"
    folder.mkdir()
    (folder / "a.csv").write_text('id,"site, ref",fsk\np-1,s,1\n')
    (folder / "b.csv").write_text('\ufefffsk,id,"site, ref"\n2,p-2,t\n', encoding="utf-8")
    with gzip.open(folder / "c.csv.gz", "wt") as f:
        f.write('"site, ref",fsk,id,extra\nu,3,p-3,x\n')
    got = files.read_entity_export(spark, str(folder / "*"), ["id", "site, ref"])
    assert got.columns == ["id", "site, ref", "fsk", "extra"] and sorted(tuple(r) for r in got.collect()) == [("p-1", "s", "1", ""), ("p-2", "t", "2", ""), ("p-3", "u", "3", "x")]
    for bad in ("fsk,id\n1,p\n", 'id,"site, ref",id\np,s,p\n'):
        (folder / "d.csv").write_text(bad)
        with pytest.raises(ValueError, match="d.csv"):
            files.read_entity_export(spark, str(folder / "*"), ["id", "site, ref"])


def test_rows_without_a_batch_are_never_good(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "x.jsonl").write_text('{"v":1,"batch_key":"a"}\n{"v":2}\n{"v":3,"batch_key":"b"}\n')
    receipts = spark.createDataFrame([("a", 1), ("b", 2), (None, 1), ("gone", 1)], "batch_key string, row_count long")
    good, bad = files.read_certified_jsonl(spark, str(tmp_path / "j"), "v int", receipts)
    assert [r.v for r in good.collect()] == [1] and {r.batch_key for r in bad.collect()} == {None, "b", "gone"}


def test_pages_are_judged_once_and_only_good_ones_let_through(spark, tmp_path):
    scope = ["p-1", "p-2"]
    meta = {"batch_id": "b1", "project": "1", "site": "s", "complete": True, "truncated": False, "query_id": "q", "window_start": "2024-01-01T06:00:00+06:00", "window_end": "2024-01-01T00:05:00Z", "requested_ids": scope, "completed_ids": scope, "returned_rows": 1, "total_rows": 1}
    cols = [{"name": "ts", "meta": {}}, {"name": "v0", "meta": {"id": "p-1"}}, {"name": "p-2"}]
    good = {"meta": meta, "cols": cols, "rows": [{"ts": "2024-01-01T02:01:00+02:00", "v0": 1.5, "p-2": {"_kind": "na"}}]}
    late = {"meta": meta | {"batch_id": "b2"}, "cols": cols, "rows": [{"ts": "2024-01-01T02:01:00Z", "v0": 1}]}
    stray = {"meta": meta | {"batch_id": "b3"}, "cols": cols, "rows": [{"ts": "2024-01-01T00:01:00Z", "other": None}]}
    untyped = {"meta": meta | {"batch_id": "b4"}, "cols": cols, "rows": [{"ts": "2024-01-01T00:01:00Z", "v0": [1]}]}
    empty = {"meta": meta | {"batch_id": "b5", "returned_rows": 0, "total_rows": 0}, "cols": cols, "rows": []}
    unplanned = {"meta": meta | {"batch_id": "b9"}, "cols": cols, "rows": good["rows"]}
    land = tmp_path / "land"
    land.mkdir()
    for k, page in enumerate((good, late, stray, untyped, empty, unplanned)):
        (land / f"{k}.json").write_text(json.dumps(page))
    plan = spark.createDataFrame([(f"b{k}", "1", "s", meta["window_start"], meta["window_end"], scope) for k in range(1, 7)], "batch_id string, project string, site_ref string, window_start string, window_end string, scope array<string>")
    into = streams.pages_into(plan, str(tmp_path / "out"))
    for k in range(2):  # with another checkpoint the pages come again as the same micro-batch
        assert streams.stream_merge(streams.stream_pages(spark, str(land)), into, str(tmp_path / f"cp{k}")).awaitTermination(240)
    told = {r.batch_id: r.reason for r in spark.read.parquet(str(tmp_path / "out" / "verdicts")).collect()}
    assert told == {"b1": "", "b2": "outside_window", "b3": "unrequested", "b4": "value", "b5": "", "b9": "unplanned"}
    rows = spark.read.parquet(str(tmp_path / "out" / "rows")).collect()
    assert {(r.batch_id, r.point_id, str(r.observed_at), r.value_kind) for r in rows} == {("b1", "p-1", "2024-01-01 00:01:00", "num"), ("b1", "p-2", "2024-01-01 00:01:00", "na")} and len(rows) == 2


def test_landed_files_are_dealt_to_all_tasks(spark, tmp_path):
    from tagflow import roundtrips

    path = roundtrips._files(spark.range(40).coalesce(1).selectExpr("concat('b-', id) AS value"), str(tmp_path / "landed"))
    made = sorted((tmp_path / "landed").glob("*.txt"))
    assert sorted(f.read_text() for f in made) == sorted(f"b-{k}\n" for k in range(40))
    assert len({f.name.split("-")[1] for f in made}) >= 8 and spark.read.text(path).count() == 40
