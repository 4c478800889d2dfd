"""Assessment of entity exports: first failing rule by row, counts, examples, site summary."""

from pyspark.sql import functions as F

from tagflow.functions.normalize import instant_with_zone
from tagflow.sqlops import Operator, operator

#: Rules in order; a duplicate is judged before the site rules, among rows that passed the two before.
classify_equipment = Operator(
    """
SELECT e.row_no, e.id, e.siteRef, CASE WHEN fsk <> '$project' THEN 'wrong_project' WHEN trim(e.id) = '' THEN 'missing_id'
    WHEN k > 1 THEN 'duplicate_equipment_id' WHEN trim(e.siteRef) = '' THEN 'missing_site_ref' WHEN s.site_ref IS NULL THEN 'unexpected_site_ref' ELSE 'accepted' END AS outcome
FROM (SELECT *, row_number() OVER (PARTITION BY id, fsk = '$project' AND trim(id) <> '' ORDER BY row_no) AS k FROM {equipment}) e
LEFT JOIN {sites} s ON e.siteRef = s.site_ref""",
    "One row per equipment row with its outcome.",
    project="1001",
)
classify_points = Operator(
    """
SELECT p.row_no, p.id, p.siteRef, p.equipRef, CASE WHEN fsk <> '$project' THEN 'wrong_project' WHEN trim(p.id) = '' THEN 'missing_id'
    WHEN k > 1 THEN 'duplicate_point_id' WHEN trim(p.siteRef) = '' THEN 'missing_site_ref' WHEN s.site_ref IS NULL THEN 'unexpected_site_ref'
    WHEN trim(p.equipRef) <> '' AND e.id IS NULL THEN 'unknown_equipment_ref' WHEN trim(p.equipRef) <> '' AND e.siteRef <> p.siteRef THEN 'cross_site_equipment_ref'
    WHEN lower(trim(p.his)) NOT IN ('true', 'm:', 'false', '') THEN 'unknown_historized_marker' ELSE 'accepted' END AS outcome,
  lower(trim(p.his)) IN ('true', 'm:') AS historized, trim(p.equipRef) = '' AS site_level
FROM (SELECT *, row_number() OVER (PARTITION BY id, fsk = '$project' AND trim(id) <> '' ORDER BY row_no) AS k FROM {points}) p
LEFT JOIN {sites} s ON p.siteRef = s.site_ref LEFT JOIN (SELECT id, siteRef FROM {equipment} WHERE outcome = 'accepted') e ON p.equipRef = e.id""",
    "One row per point row with its outcome; ``equipment`` is classified equipment.",
    project="1001",
)
issue_counts = Operator("SELECT outcome, count(*) AS n FROM {classified} GROUP BY outcome", "Rows by outcome.")
issue_examples = Operator(
    "SELECT row_no, id, outcome FROM {classified} WHERE outcome <> 'accepted' ORDER BY row_no LIMIT $limit", "The first rows with an issue.", limit=20
)
site_summary = Operator(
    """
SELECT s.site_ref, coalesce(e.n, 0) AS equipment, coalesce(p.n, 0) AS points, coalesce(p.h, 0) AS historized, coalesce(p.l, 0) AS site_level
FROM {sites} s LEFT JOIN (SELECT siteRef, count(*) AS n FROM {equipment} WHERE outcome = 'accepted' GROUP BY siteRef) e ON s.site_ref = e.siteRef
LEFT JOIN (SELECT siteRef, count(*) AS n, count(*) FILTER (WHERE historized) AS h, count(*) FILTER (WHERE site_level) AS l FROM {points} WHERE outcome = 'accepted' GROUP BY siteRef) p ON s.site_ref = p.siteRef""",
    "One row per expected site, sites without rows included.",
)


@operator
def export_crossref(equipment, points, detections, history, stamps):
    """Counts across the four exports in one row: one aggregate an export, one join a reference."""
    known = lambda df, name: df.where("trim(id) <> ''").select(F.trim("id").alias(name)).distinct()
    own = equipment.agg(F.count_distinct(F.when(F.trim("id") != "", F.trim("id"))).alias("unique_equipment"), F.count("*").alias("n"))
    own = own.select("unique_equipment", (F.col("n") - F.col("unique_equipment")).alias("missing_or_duplicate_equipment"))
    free, placed = F.trim("equipRef") == "", F.trim("siteRef") != ""
    parts = points.agg(F.count_distinct(F.when(F.trim("id") != "", F.trim("id"))).alias("unique_points"), F.count("*").alias("n"), F.count_if(free & placed).alias("site_level_points"), F.count_if(free & ~placed).alias("orphan_points"))
    parts = parts.withColumn("missing_or_duplicate_points", F.col("n") - F.col("unique_points")).drop("n")
    rules = detections.groupBy("targetRef", "ruleRef", "rule_date").agg(F.count("*").alias("n")).join(known(equipment, "targetRef").withColumn("known", F.lit(True)), "targetRef", "left")
    rules = rules.agg(
        F.sum(F.when(F.col("known"), F.col("n")).otherwise(0)).alias("rules_to_known"), F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).alias("rules_to_unknown"), F.count_distinct("targetRef").alias("distinct_targets"), F.sum(F.col("n") - 1).alias("duplicate_rule_rows")
    )
    kinds = {k: F.sum(F.when(F.col("value_kind") == k, F.col("n")).otherwise(0)).alias(f"{k}_values") for k in ("bool", "str", "num", "na")}
    samples = history.groupBy("point_id", "value_kind").agg(F.count("*").alias("n"), F.min("observed_at").alias("a"), F.max("observed_at").alias("z")).join(known(points, "point_id").withColumn("known", F.lit(True)), "point_id", "left")
    samples = samples.agg(
        F.sum(F.when(F.col("known"), F.col("n")).otherwise(0)).alias("history_to_known"), F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).alias("history_to_unknown"), F.count_distinct("point_id").alias("distinct_points"),
        *kinds.values(), F.min("a").alias("first_at"), F.max("z").alias("last_at"),
    )
    bad = stamps.agg(F.count_if(instant_with_zone(F.col("stamp")).isNull()).alias("bad_timestamps"))
    return own.crossJoin(parts).crossJoin(rules).crossJoin(samples).crossJoin(bad)
