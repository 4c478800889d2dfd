"""The registered queries, each an operator over the fixture views, and hand-written SQL for comparison."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagflow import roundtrips
from tagflow.fixtures import VIEWS
from tagflow.functions import normalize
from tagflow.operators import assess, coverage, fanout, guard, merge, relate, rollup, state, validators
from tagflow.oracles import ORACLES
from tagflow.plans import planning
from tagflow.sqlops import Graph, Operator, flat, operator, with_views

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
#: Nodes with shuffles of their own.
SHARED = ("classify_points", "jobs_v", "plan_v", "rule_plan_v", "landed_rows_v", "replicate_equipment", "replicate_points", "run_status", "lineage_depth", "history_told", "harvests_v", "history_verdicts", "carried_v", "handed_v", "judged_rows")
GRAPH = Graph(TABLES, SHARED)
VIEW_BIND = {"c": "classify_equipment", "classified": "classify_points", "entities": "entities_v", "jobs": "jobs_v", "batch_seed": "batch_seed_v", "plan": "plan_v", "plan_rows": "plan_rows_v", "rule_plan": "rule_plan_v", "detections": "detections_v", "equipment": "equipment_v", "points": "points_v", "dues": "dues_v", "virtual_points": "replicate_points"}
BIND = {
    "equipment": "classify_equipment", "points": "classify_points", "classified": "classify_points", "sites": "sites_v", "history": "history_v", "jobs": "jobs_v", "children": "children_v", "certifications": "certifications_v", "artifacts": "artifacts_v",
    "receipts": "receipts_v", "outbox": "outbox_v", "attempts": "attempts_v", "runs": "runs_v", "completions": "completions_v", "cursors": "cursors_v", "lineage": "lineage_v", "status": "lineage_status_v", "depths": "lineage_depth",
    "detections": "detections_v", "found": "found_v", "samples": "samples_v", "versions": "versions_v", "eligible": "eligible_versions", "registered": "registered_v", "commissioned": "commissioned", "carried": "carried_rows", "handed": "handed_rows", "judged": "judged_rows", "pins": "pins_v", "dues": "dues_v", "requests": "requests_v", "approvals": "approvals_v",
    "entities": "entities_v", "current": "entities_v", "prior": "prior_v", "a": "entities_v", "b": "prior_v", "exclusions": "exclusions_v", "staged": "staged_rows", "resend": "resend_v", "base": "stored_base", "told": "history_told", "revisions": "kept_revisions", "harvest": "harvest_v", "harvests": "harvests_v", "published": "published_v", "publications": "publications_v",
    "stored_receipts": "receipts_v", "new_receipts": "new_receipts_v", "staged_revisions": "staged_revisions_v", "stored_revisions": "stored_revisions_v", "windows": "windows12_v", "feed": "certified_batch_feed", "statuses": "run_status",
    "plan": "history_plan", "pages": "history_pages", "columns": "grid_columns_v", "rows": "landed_rows_v", "verdicts": "history_verdicts", "requested": "classify_points", "returned": "history_v",
    "tagged": "tagged_v", "json": "json_v", "marks": "marks_v", "stamps": "stamps_v", "real_equipment": "real_equipment_v", "real_points": "real_points_v", "virtual": "replicate_equipment", "virtual_points": "replicate_points", "asked": "asked_v", "chain": "chain_v", "coverage": "hour_coverage", "inventory": "site_inventory", "batches": "assign_batches",
}
#: Where an operator's input is another than by BIND.
SPECIAL = {
    "classify_equipment": {"equipment": "equipment_v"}, "classify_points": {"points": "points_v"}, "export_crossref": {"equipment": "equipment_v", "points": "points_v"}, "first_occurrence": {"points": "points_v"}, "lead_columns": {"points": "named_points_v"}, "plan_guard": {"inventory_rows": "inventory_rows_v"}, "map_detections": {"found": "source_detections_v"}, "window_labels": {"windows": "history_windows"},
    "rules_coverage": {"plan": "rule_days", "pages": "rule_pages"}, "rules_rows": {"plan": "rule_days"}, "entity_links": {"entities": "linked_v"}, "entity_shape": {"entities": "entity_rows_v"}, "ref_lists": {"json": "ref_lists_v"}, "wide_to_long": {"pages": "map_pages"},
    "history_windows": {"dues": "grid_dues_v"}, "upsert_entities": {"harvest": "part_v"},
    "eligible_versions": {"runs": "meta_runs_v", "jobs": "meta_jobs_v", "certifications": "meta_certs_v", "completions": "meta_done_v"}, "completion_scope": {"jobs": "commissioned", "completed": "completed"}, "rule_verdicts": {"plan": "rule_days", "pages": "rule_pages"}, "metadata_verdicts": {"entities": "site_entities_v"},
    "sink_guard": {"receipts": "carried_receipts"}, "entity_guard": {"receipts": "handed_receipts"}, "rule_guard": {"plan": "rule_days", "receipts": "judged_receipts"}, "entity_link_verdicts": {"entities": "linked_v"}, "entity_shape_verdicts": {"entities": "entity_rows_v"}, "lookback_windows": {"windows": "history_windows"},
}


def _lists(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.split(n, ",") for n in names})


def _tampered(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.when(F.col("tamper") == col, "changed").otherwise(F.col(col))).drop("line", "place")


def _receipts(feed: str, rows: DataFrame, batches: DataFrame) -> DataFrame:
    """A receipt of every batch, with a key that some do not carry."""
    sums = guard.checksums(guard.lined(rows, feed), 1 << 30, 1 << 40)
    odd = rows.where("tamper = 'batch_key'").select("batch_id").distinct().withColumn("odd", F.lit(True))
    own = batches.select("batch_id").distinct().join(sums, "batch_id", "left").join(odd, "batch_id", "left")
    key = guard.batch_key(feed, F.coalesce("checksum", F.sha2(F.lit(""), 256)))
    return own.select("batch_id", F.when(F.col("odd"), "changed").otherwise(key).alias("batch_key"))


def _detections(judged: DataFrame, plan: DataFrame) -> DataFrame:
    """Detections with the key and hash that they carry."""
    own = judged.join(plan.select("batch_id", "day", "site_ref", "timezone"), "batch_id")
    key = normalize.detection_key(F.lit("t"), F.lit("1001"), F.col("site_ref"), F.col("equipment_id"), F.col("rule_id"), F.col("day"), F.col("timezone"))
    revision = F.when(F.col("tamper") == "revision_hash", "changed").otherwise(normalize.row_hash(severity=F.col("severity"), spark=F.col("spark")))
    return own.select("batch_id", "equipment_id", "rule_id", "severity", "spark", F.col("found_day").cast("date").alias("source_date"), F.when(F.col("tamper") == "key", "changed").otherwise(key).alias("detection_key"), revision.alias("revision_hash"), "tamper")


#: Views as the operators take them: lists as arrays, pages as maps. No queries of their own.
SHAPES = {
    "history_plan": operator(lambda plan_v: _lists(plan_v, "scope")),
    "history_pages": operator(lambda receipt_v: _lists(receipt_v, "requested", "completed")),
    "rule_days": operator(lambda rule_plan_v: _lists(rule_plan_v, "scope")),
    "rule_pages": operator(lambda rule_receipt_v: _lists(rule_receipt_v, "requested", "completed")),
    "stored_base": operator(lambda stored_v: stored_v.withColumn("row_hash", normalize.observation_hash(stored_v))),
    "staged_rows": operator(lambda staged_v: staged_v.withColumn("row_hash", normalize.observation_hash(staged_v))),
    "history_told": operator(lambda stored_base, staged_rows: merge.merged(stored_base, staged_rows)),
    "kept_revisions": operator(lambda history_told: history_told.where("action = 'revision' AND row_no % 2 = 0")),
    "commissioned": operator(lambda commissioned_v: _lists(commissioned_v, "scope")),
    "completed": operator(lambda completed_v: _lists(completed_v, "ids")),
    "carried_rows": operator(lambda carried_v: _tampered(guard.lined(carried_v, "history").withColumn("row_hash", F.sha2("line", 256)), "row_hash")),
    "carried_receipts": operator(lambda carried_v, plan_v: _receipts("history", carried_v, plan_v)),
    "handed_rows": operator(lambda handed_v: _tampered(guard.lined(handed_v, "metadata").withColumn("row_hash", F.sha2("line", 256)), "row_hash")),
    "handed_receipts": operator(lambda handed_v: _receipts("metadata", handed_v, handed_v)),
    "judged_rows": operator(lambda judged_v, rule_plan_v: _detections(judged_v, rule_plan_v)),
    "judged_receipts": operator(lambda judged_rows, rule_plan_v: _receipts("rules", judged_rows, rule_plan_v)),
    "map_pages": operator(
        lambda plan_rows_v: plan_rows_v.groupBy("batch_id", F.col("observed_at").alias("ts"))
        .agg(F.map_from_entries(F.collect_list(F.struct("point_id", F.when(F.col("value_kind") != "error", F.col("value_kind"))))).alias("cells"))
        .groupBy("batch_id").agg(F.collect_list(F.struct("ts", "cells")).alias("rows"))
    ),
}

for _name, _view in VIEWS.items():
    GRAPH.add(_name, _view, **{k: VIEW_BIND[k] for k in _view.inputs() if k in VIEW_BIND})
for _name, _op in SHAPES.items():
    GRAPH.add(_name, _op)
OPERATORS: list[str] = []
for _module in (assess, coverage, validators, guard, relate, rollup, merge, state, fanout, normalize, planning):
    for _name, _op in list(vars(_module).items()):
        if isinstance(_op, Operator) and _name not in OPERATORS:
            OPERATORS.append(_name)
            GRAPH.add(_name, _op, **{**BIND, **SPECIAL.get(_name, {})})


def _query(name: str):
    return lambda spark, sf_dir: flat(GRAPH.frame(spark, sf_dir, name))


def export_assessment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship query: both exports classified, then summed by site."""
    return GRAPH.frame(spark, sf_dir, "site_summary")


def bisect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over-size batches of samples, halved until they fit."""
    samples = GRAPH.frame(spark, sf_dir, "samples_v")
    counts = samples.groupBy("point_id").agg(F.count("*").alias("n"))
    return planning.bisect_batches(planning.bounded_batches(counts, samples.count()), cap=60)


def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over-size batches of 64 points, split by ids and then by window."""
    seed = GRAPH.frame(spark, sf_dir, "split_seed_v")
    batches = seed.groupBy("batch_id", "window_start", "window_end").agg(F.collect_list(F.struct("id", F.col("seen_at").alias("at"))).alias("samples"))
    return flat(planning.split_batches(batches, cap=3, min_seconds=400 * 86_400))


def local_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of each local day: 23 or 25 when the clock changes."""
    days = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_shipdate").cast("date").alias("day")).distinct()
    a, b = planning.local_day_window(F.col("day"), "America/Chicago")
    return days.select("day", ((F.unix_timestamp(b) - F.unix_timestamp(a)) / 3600).cast("bigint").alias("hours"))


QUERIES = {name: _query(name) for name in OPERATORS}
QUERIES |= roundtrips.queries(GRAPH)
QUERIES |= {"export_assessment": export_assessment, "bisect_batches": bisect, "split_batches": split, "local_day_window": local_days}
_KNOWN = {name: re.sub(r"\{(\w+)\}", lambda m: VIEW_BIND.get(m[1], m[1]), view.duck()) for name, view in VIEWS.items()} | ORACLES
ORACLE = {name: with_views(sql, {k: v for k, v in _KNOWN.items() if k != name}, TABLES) for name, sql in ORACLES.items()}
