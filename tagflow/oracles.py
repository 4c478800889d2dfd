"""DuckDB SQL, written by hand for each query, over the base tables and the fixture views.

The engine's plans are not derived from this text nor this text from them: each states the rule
once more, in other terms where there are any. A name of a view or of another query stands for its
rows. Comparison is by value, so lists are comma-joined and counts are BIGINT.
"""

ORACLES = {
    # --- assessment of exports
    "classify_equipment": """
SELECT row_no, id, siteRef, CASE WHEN fsk <> '1001' THEN 'wrong_project' WHEN trim(id) = '' THEN 'missing_id' WHEN row_no > (SELECT min(f.row_no) FROM equipment_v f WHERE f.id = e.id AND f.fsk = '1001') THEN 'duplicate_equipment_id'
  WHEN trim(siteRef) = '' THEN 'missing_site_ref' WHEN siteRef NOT IN (SELECT site_ref FROM sites_v) THEN 'unexpected_site_ref' ELSE 'accepted' END AS outcome FROM equipment_v e""",
    "classify_points": """
SELECT p.row_no, p.id, p.siteRef, p.equipRef, CASE WHEN fsk <> '1001' THEN 'wrong_project' WHEN trim(p.id) = '' THEN 'missing_id' WHEN p.row_no > f.first_row THEN 'duplicate_point_id' WHEN trim(p.siteRef) = '' THEN 'missing_site_ref'
    WHEN p.siteRef NOT IN (SELECT site_ref FROM sites_v) THEN 'unexpected_site_ref' WHEN trim(p.equipRef) <> '' AND q.id IS NULL THEN 'unknown_equipment_ref' WHEN trim(p.equipRef) <> '' AND q.siteRef <> p.siteRef THEN 'cross_site_equipment_ref'
    WHEN NOT list_contains(['true', 'm:', 'false', ''], lower(trim(his))) THEN 'unknown_historized_marker' ELSE 'accepted' END AS outcome, list_contains(['true', 'm:'], lower(trim(his))) AS historized, trim(p.equipRef) = '' AS site_level
FROM points_v p LEFT JOIN (SELECT id, min(row_no) AS first_row FROM points_v WHERE fsk = '1001' AND trim(id) <> '' GROUP BY id) f ON f.id = p.id LEFT JOIN (FROM classify_equipment WHERE outcome = 'accepted') q ON q.id = p.equipRef""",
    "issue_counts": "SELECT DISTINCT outcome, count(*) OVER (PARTITION BY outcome) AS n FROM classify_points",
    "issue_examples": "SELECT row_no, id, outcome FROM classify_points WHERE outcome <> 'accepted' QUALIFY row_number() OVER (ORDER BY row_no) <= 20",
    "site_summary": """
SELECT site_ref, (SELECT count(*) FROM classify_equipment e WHERE e.siteRef = site_ref AND outcome = 'accepted') AS equipment, (SELECT count(*) FROM classify_points p WHERE p.siteRef = site_ref AND outcome = 'accepted') AS points,
  (SELECT count(*) FROM classify_points p WHERE p.siteRef = site_ref AND outcome = 'accepted' AND historized) AS historized, (SELECT count(*) FROM classify_points p WHERE p.siteRef = site_ref AND outcome = 'accepted' AND site_level) AS site_level FROM sites_v""",
    "export_assessment": "SELECT * FROM site_summary",
    "export_crossref": """
SELECT (SELECT count(DISTINCT nullif(trim(id), '')) FROM equipment_v) AS unique_equipment, (SELECT count(*) - count(DISTINCT nullif(trim(id), '')) FROM equipment_v) AS missing_or_duplicate_equipment,
  (SELECT count(DISTINCT nullif(trim(id), '')) FROM points_v) AS unique_points, (SELECT count(*) - count(DISTINCT nullif(trim(id), '')) FROM points_v) AS missing_or_duplicate_points,
  (SELECT count(*) FROM points_v WHERE trim(equipRef) = '' AND trim(siteRef) <> '') AS site_level_points, (SELECT count(*) FROM points_v WHERE trim(equipRef) = '' AND trim(siteRef) = '') AS orphan_points,
  (SELECT count(*) FROM detections_v WHERE targetRef IN (SELECT id FROM equipment_v)) AS rules_to_known, (SELECT count(*) FROM detections_v WHERE targetRef NOT IN (SELECT id FROM equipment_v)) AS rules_to_unknown,
  (SELECT count(DISTINCT targetRef) FROM detections_v) AS distinct_targets, (SELECT count(*) - count(DISTINCT (targetRef, ruleRef, rule_date)) FROM detections_v) AS duplicate_rule_rows,
  (SELECT count(*) FROM history_v WHERE point_id IN (SELECT id FROM points_v)) AS history_to_known, (SELECT count(*) FROM history_v WHERE point_id NOT IN (SELECT id FROM points_v)) AS history_to_unknown,
  (SELECT count(DISTINCT point_id) FROM history_v) AS distinct_points, (SELECT count(val_bool) FROM history_v) AS bool_values, (SELECT count(val_str) FROM history_v) AS str_values, (SELECT count(val_num) FROM history_v) AS num_values,
  (SELECT count(*) FROM history_v WHERE value_kind = 'na') AS na_values, (SELECT min(observed_at) FROM history_v) AS first_at, (SELECT max(observed_at) FROM history_v) AS last_at, (SELECT count(*) FROM events WHERE event_id % 6 >= 3) AS bad_timestamps""",
    # --- coverage
    "history_coverage": """
SELECT batch_id, reason = '' AS ok, reason FROM (SELECT batch_id, CASE m WHEN 11 THEN 'no_receipt' WHEN 0 THEN 'error' WHEN 1 THEN 'incomplete' WHEN 2 THEN 'truncated' WHEN 3 THEN 'project' WHEN 4 THEN 'site' WHEN 10 THEN 'query_id' WHEN 5 THEN 'window'
  WHEN 6 THEN 'requested' WHEN 7 THEN 'completed' WHEN 8 THEN 'returned_rows' WHEN 9 THEN 'total_rows' ELSE '' END AS reason FROM plan_v) x""",
    "history_columns": """
SELECT batch_id, reason = '' AS ok, reason FROM (SELECT p.batch_id, CASE WHEN len(list_filter(coalesce(names, []), lambda x: x = 'ts')) <> 1 THEN 'ts' WHEN len(list_distinct(names)) < len(names) THEN 'names' WHEN len(list_distinct(ids)) < len(coalesce(ids, [])) THEN 'ids'
    WHEN list_sort(coalesce(ids, [])) <> list_sort(string_split(scope, ',')) THEN 'scope' ELSE '' END AS reason
  FROM plan_v p LEFT JOIN (SELECT batch_id, list(name) AS names, list(coalesce(point_id, name)) FILTER (name <> 'ts') AS ids FROM grid_columns_v GROUP BY batch_id) c ON c.batch_id = p.batch_id) x""",
    "history_rows": """
SELECT batch_id, reason = '' AS ok, reason FROM (SELECT p.batch_id, CASE WHEN EXISTS (SELECT 1 FROM landed_rows_v r WHERE r.batch_id = p.batch_id AND NOT list_contains(string_split(scope, ','), r.point_id)) THEN 'unrequested'
    WHEN EXISTS (SELECT 1 FROM landed_rows_v r WHERE r.batch_id = p.batch_id AND NOT (r.observed_at >= timezone('UTC', cast(window_start AS timestamptz)) AND r.observed_at < timezone('UTC', cast(window_end AS timestamptz)))) THEN 'outside_window'
    WHEN (SELECT count(*) - count(DISTINCT (r.point_id, r.observed_at)) FROM landed_rows_v r WHERE r.batch_id = p.batch_id) > 0 THEN 'duplicate' WHEN (SELECT count(*) FROM landed_rows_v r WHERE r.batch_id = p.batch_id) > 60 THEN 'observation_cap' ELSE '' END AS reason FROM plan_v p) x""",
    "history_values": """
SELECT p.batch_id, NOT coalesce(bad, false) AS ok, CASE WHEN bad THEN 'value' ELSE '' END AS reason FROM plan_v p LEFT JOIN (SELECT batch_id, bool_or(value_kind IS NULL) AS bad FROM landed_rows_v GROUP BY batch_id) r ON r.batch_id = p.batch_id""",
    "history_verdicts": """
SELECT batch_id, reason = '' AS ok, reason FROM (SELECT batch_id, CASE WHEN a.reason <> '' THEN a.reason WHEN b.reason <> '' THEN b.reason WHEN c.reason <> '' THEN c.reason ELSE d.reason END AS reason FROM history_coverage a JOIN history_columns b USING (batch_id) JOIN history_rows c USING (batch_id) JOIN history_values d USING (batch_id)) x""",
    "duplicate_samples": "SELECT point_id, count(DISTINCT observed_at) AS duplicate_keys, count(*) AS rows_in FROM (SELECT *, count(*) OVER (PARTITION BY point_id, observed_at) AS n FROM samples_v) x WHERE n > 1 GROUP BY point_id",
    "metadata_page_chain": """
SELECT site_ref, reason = '' AS ok, reason FROM (SELECT site_ref, CASE WHEN max(err) IS NOT NULL THEN 'error' WHEN count(DISTINCT snapshot) > 1 THEN 'snapshot' WHEN max(CASE WHEN page_index <> page THEN 1 ELSE 0 END) = 1 THEN 'page_index' WHEN sum(abs(returned_rows - actual_rows)) > 0 THEN 'returned_rows'
    WHEN max(CASE WHEN page < last AND (next_page IS NULL OR complete OR twice > 1) THEN 1 ELSE 0 END) = 1 THEN 'next_page' WHEN max(CASE WHEN page = last AND (next_page IS NOT NULL OR NOT complete OR total_rows <> all_rows) THEN 1 ELSE 0 END) = 1 OR count(DISTINCT kind) <> 2 THEN 'total' ELSE '' END AS reason
  FROM (SELECT *, max(page) OVER k AS last, sum(actual_rows) OVER k AS all_rows, count(*) OVER (PARTITION BY site_ref, kind, next_page) AS twice FROM chain_v WINDOW k AS (PARTITION BY site_ref, kind)) x GROUP BY site_ref) y""",
    "rules_coverage": """
SELECT batch_id, reason = '' AS ok, reason FROM (SELECT batch_id, CASE m WHEN 13 THEN 'no_receipt' WHEN 0 THEN 'error' WHEN 1 THEN 'incomplete' WHEN 2 THEN 'truncated' WHEN 3 THEN 'project' WHEN 4 THEN 'day' WHEN 5 THEN 'timezone' WHEN 6 THEN 'requested' WHEN 7 THEN 'completed'
  WHEN 8 THEN 'requested_count' WHEN 9 THEN 'returned_rows' WHEN 10 THEN 'paging' WHEN 11 THEN 'paging' WHEN 12 THEN 'columns' ELSE '' END AS reason FROM rule_plan_v) x""",
    "rules_rows": """
SELECT p.batch_id, coalesce(reason, '') = '' AS ok, coalesce(reason, '') AS reason FROM rule_plan_v p LEFT JOIN (SELECT batch_id, CASE WHEN bool_or(equipment_id = 'e-stray') THEN 'target' WHEN bool_or(project <> '1001') THEN 'project' WHEN bool_or(off OR tz <> 'UTC') THEN 'day_or_zone' WHEN bool_or(spark IS NULL) THEN 'no_value' WHEN count(*) > count(DISTINCT (equipment_id, rule_id)) THEN 'duplicate_detection' ELSE '' END AS reason
  FROM (SELECT *, extract(DAY FROM found_day) <> 1 AS off FROM found_v) x GROUP BY batch_id) f ON f.batch_id = p.batch_id""",
    "rule_verdicts": """
SELECT batch_id, reason = '' AS ok, reason FROM (SELECT batch_id, CASE WHEN a.reason <> '' THEN a.reason ELSE b.reason END AS reason FROM rules_coverage a JOIN rules_rows b USING (batch_id)) x""",
    "scope_equality": "(SELECT DISTINCT id, 'missing' AS fault FROM classify_points WHERE id NOT IN (SELECT point_id FROM history_v)) UNION ALL (SELECT DISTINCT point_id, 'unexpected' FROM history_v WHERE point_id NOT IN (SELECT id FROM classify_points))",
    "observed_coverage": """
SELECT batch_id, reason = '' AS ok, reason, 'observed' AS label FROM (SELECT r.batch_id, CASE WHEN err IS NOT NULL THEN 'error' WHEN regexp_matches(lower(meta_keys), 'trunc|limit') THEN 'cut'
    WHEN EXISTS (SELECT 1 FROM (SELECT unnest(string_split(p.scope, ',')) AS id) s WHERE NOT EXISTS (SELECT 1 FROM grid_columns_v c WHERE c.batch_id = r.batch_id AND c.point_id = s.id)) THEN 'missing_column' ELSE '' END AS reason FROM receipt_v r JOIN plan_v p ON p.batch_id = r.batch_id) x""",
    "drop_boundary": "SELECT point_id, sum(CASE WHEN inside THEN 1 ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN inside THEN 0 ELSE 1 END)::BIGINT AS dropped FROM (SELECT point_id, observed_at >= TIMESTAMP '2024-01-05' AND observed_at < TIMESTAMP '2024-01-20' AS inside FROM history_v) x GROUP BY point_id",
    "size_caps": """
SELECT *, CASE WHEN n_rows > 30 THEN 'rows' WHEN bytes > 1200 THEN 'bytes' WHEN entities > 7 THEN 'entities' ELSE '' END AS reason FROM (SELECT p.batch_id, count(row_no) AS n_rows, coalesce(sum(length('{"point_id":"' || point_id || '","row_no":' || row_no || ',"value_kind":' || coalesce('"' || value_kind || '"', 'null') || '}') + 1), 0)::BIGINT AS bytes, count(DISTINCT point_id) AS entities FROM plan_v p LEFT JOIN landed_rows_v r ON r.batch_id = p.batch_id GROUP BY p.batch_id) x""",
    "quarantine_split": """
SELECT batch_id, row_no, point_id, observed_at, batch_id IN (SELECT batch_id FROM history_verdicts WHERE ok) AS ok FROM landed_rows_v""",
    "accepted_rows": """
SELECT batch_id, row_no, point_id, observed_at FROM landed_rows_v SEMI JOIN (FROM history_verdicts WHERE reason = '') v USING (batch_id)""",
    "sink_guard": """
WITH l AS (SELECT c.*, scope, window_start, window_end, '{"observed_at":"' || observed_at || 'Z","point_id":"' || point_id || '","val_bool":null,"val_na":null,"val_num":null,"val_str":' || coalesce('"' || val_str || '"', 'null') || ',"value_kind":' || coalesce('"' || value_kind || '"', 'null') || '}' AS line FROM carried_v c JOIN plan_v p ON p.batch_id = c.batch_id),
b AS (SELECT batch_id, count(*) AS n, sum(length(line) + 1) AS bytes, sha256(string_agg(line || chr(10), '' ORDER BY point_id, observed_at, line)) AS h, count(*) > count(DISTINCT (point_id, observed_at)) AS twice, bool_or(tamper = 'row_hash') AS changed, bool_or(tamper = 'batch_key') AS keyed,
  bool_or(NOT list_contains(string_split(scope, ','), point_id)) AS stray, bool_or(observed_at < timezone('UTC', cast(window_start AS timestamptz)) OR observed_at >= timezone('UTC', cast(window_end AS timestamptz))) AS late FROM l GROUP BY batch_id)
SELECT batch_id, reason = '' AS ok, reason, n AS n_rows, CASE WHEN reason = '' THEN h END AS checksum FROM (SELECT *, CASE WHEN stray THEN 'scope' WHEN late THEN 'window' WHEN twice THEN 'duplicate' WHEN changed THEN 'row_hash' WHEN n > 24 THEN 'row_cap' WHEN bytes > 3500 THEN 'byte_cap' WHEN keyed THEN 'batch_key' ELSE '' END AS reason FROM b) x""",
    "entity_guard": """
WITH l AS (SELECT *, '{"equipment_ref":' || coalesce('"' || equipment_ref || '"', 'null') || ',"historized":' || historized || ',"kind":"' || kind || '","payload":' || coalesce('"' || payload || '"', 'null') || ',"site_ref":"' || site_ref || '","source_id":"' || source_id || '"}' || chr(10) AS line FROM handed_v),
b AS (SELECT batch_id, count(*) AS n, sha256(string_agg(line, '' ORDER BY kind, source_id, line)) AS h, count(*) > count(DISTINCT (kind, source_id)) AS twice, bool_or(tamper = 'row_hash') AS changed, bool_or(tamper = 'batch_key') AS keyed, bool_or(site_ref = 'site-99') AS moved, bool_or(tag_id = 'n-x') AS other, bool_or(kind = 'equipment' AND historized) AS shape FROM l GROUP BY batch_id)
SELECT batch_id, reason = '' AS ok, reason, n AS n_rows, CASE WHEN reason = '' THEN h END AS checksum FROM (SELECT *, CASE WHEN moved THEN 'site' WHEN other THEN 'id' WHEN shape THEN 'shape' WHEN twice THEN 'duplicate' WHEN changed THEN 'row_hash' WHEN keyed THEN 'batch_key' ELSE '' END AS reason FROM b) x""",
    "rule_guard": """
WITH l AS (SELECT j.batch_id, p.m, j.tamper, equipment_id, rule_id, severity, spark, cast(found_day AS date) AS found, CASE WHEN p.m = 16 THEN 'changed' ELSE sha256('{"equipment_id":"' || equipment_id || '","project_id":"1001","rule_id":"' || rule_id || '","site_ref":"' || site_ref || '","source_date":"' || cast(day AS date) || '","source_timezone":"UTC","tenant_id":"t"}') END AS k FROM judged_v j JOIN rule_plan_v p ON p.batch_id = j.batch_id),
b AS (SELECT batch_id, any_value(m) AS m, count(*) AS n, count(*) > count(DISTINCT k) AS twice, sha256(string_agg(line, '' ORDER BY k, line)) AS h FROM (SELECT *, '{"detection_key":"' || k || '","equipment_id":"' || equipment_id || '","rule_id":"' || rule_id || '","severity":"' || severity || '","source_date":"' || found || '","spark":' || spark || '}' || chr(10) AS line FROM l) x GROUP BY batch_id)
SELECT batch_id, reason = '' AS ok, reason, n AS n_rows, CASE WHEN reason = '' THEN h END AS checksum FROM (SELECT p.batch_id, coalesce(b.n, 0) AS n, coalesce(h, sha256('')) AS h, CASE WHEN b.n IS NULL THEN '' WHEN p.m = 14 THEN 'scope' WHEN p.m = 15 THEN 'day' WHEN p.m = 16 THEN 'detection_key' WHEN twice THEN 'duplicate' WHEN p.m = 17 THEN 'revision_hash' WHEN p.m = 18 THEN 'batch_key' ELSE '' END AS reason FROM rule_plan_v p LEFT JOIN b ON b.batch_id = p.batch_id) y""",
    "entity_links": """
SELECT site_ref, kind, link, count(*) AS n FROM (SELECT a.site_ref, a.kind, CASE WHEN (SELECT count(DISTINCT b.site_ref) FROM linked_v b WHERE b.kind = a.kind AND b.source_id = a.source_id) > 1 THEN 'two_sites' WHEN (SELECT count(*) FROM linked_v b WHERE b.kind = a.kind AND b.source_id = a.source_id) > 1 THEN 'duplicate'
    WHEN a.kind = 'point' AND a.parent_id IS NOT NULL AND e.site IS NULL THEN 'unknown_parent' WHEN a.kind = 'point' AND a.parent_id IS NOT NULL AND e.site <> a.site_ref THEN 'parent_elsewhere' ELSE 'linked' END AS link
  FROM linked_v a LEFT JOIN (SELECT source_id, min(site_ref) AS site FROM linked_v WHERE kind = 'equipment' GROUP BY source_id) e ON e.source_id = a.parent_id) x GROUP BY ALL""",
    "entity_link_verdicts": """
SELECT site_ref AS batch_id, max(w) = 0 AS ok, ['', 'parent_elsewhere', 'unknown_parent', 'duplicate', 'two_sites'][max(w) + 1] AS reason FROM (SELECT site_ref, CASE link WHEN 'two_sites' THEN 4 WHEN 'duplicate' THEN 3 WHEN 'unknown_parent' THEN 2 WHEN 'parent_elsewhere' THEN 1 ELSE 0 END AS w FROM entity_links) x GROUP BY site_ref""",
    "entity_shape": """
SELECT kind, source_id, CASE WHEN kind = 'equipment' THEN CASE WHEN parent_id IS NOT NULL THEN 'equipment_parent' WHEN historized THEN 'equipment_historized' WHEN site_level IS NOT NULL THEN 'equipment_site_level' ELSE '' END
  WHEN site_level IS DISTINCT FROM (parent_id IS NULL) THEN 'site_level' WHEN historized IS DISTINCT FROM (his = 'm:') THEN 'historized' ELSE '' END AS fault FROM entity_rows_v""",
    "entity_shape_verdicts": """
SELECT e.site_ref AS batch_id, min(nullif(s.fault, '')) IS NULL AS ok, coalesce(min(nullif(s.fault, '')), '') AS reason FROM entity_rows_v e JOIN entity_shape s ON s.kind = e.kind AND s.source_id = e.source_id GROUP BY e.site_ref""",
    "metadata_verdicts": """
WITH s AS (SELECT site_ref AS at, max(CASE WHEN kind = 'equipment' AND parent_id IS NOT NULL THEN 1 WHEN kind = 'equipment' AND historized THEN 2 WHEN kind = 'equipment' AND site_level IS NOT NULL THEN 3 WHEN kind = 'point' AND site_level IS DISTINCT FROM (parent_id IS NULL) THEN 4 WHEN kind = 'point' AND historized IS DISTINCT FROM (his = 'm:') THEN 5 END) IS NULL AS sound,
  min(CASE WHEN kind = 'equipment' AND parent_id IS NOT NULL THEN 'equipment_parent' WHEN kind = 'equipment' AND historized THEN 'equipment_historized' WHEN kind = 'equipment' AND site_level IS NOT NULL THEN 'equipment_site_level' WHEN kind = 'point' AND site_level IS DISTINCT FROM (parent_id IS NULL) THEN 'site_level' WHEN kind = 'point' AND historized IS DISTINCT FROM (his = 'm:') THEN 'historized' END) AS fault FROM site_entities_v GROUP BY site_ref),
l AS (SELECT a.site_ref AS at, max(CASE WHEN a.kind = 'point' AND a.parent_id IS NOT NULL AND e.site_ref IS NULL THEN 2 WHEN a.kind = 'point' AND a.parent_id IS NOT NULL AND e.site_ref <> a.site_ref THEN 1 ELSE 0 END) AS link FROM site_entities_v a LEFT JOIN (SELECT * FROM site_entities_v WHERE kind = 'equipment') e ON e.source_id = a.parent_id GROUP BY a.site_ref)
SELECT site_ref AS batch_id, r = '' AS ok, r AS reason FROM (SELECT c.site_ref, CASE WHEN c.reason <> '' THEN c.reason WHEN link > 0 THEN ['parent_elsewhere', 'unknown_parent'][link] WHEN sound IS NULL THEN 'no_verdict' WHEN NOT sound THEN fault ELSE '' END AS r FROM metadata_page_chain c LEFT JOIN s ON s.at = c.site_ref LEFT JOIN l ON l.at = c.site_ref) x""",
    "completion_scope": """
SELECT batch_id, feed, reason = '' AS ok, reason FROM (SELECT batch_id, feed, CASE m WHEN 0 THEN 'none' WHEN 1 THEN 'twice' WHEN 2 THEN 'scope' WHEN 3 THEN 'target' WHEN 4 THEN 'scope' ELSE '' END AS reason FROM commissioned_v) x""",
    # --- joins, sets, lineage
    "batch_evidence": """
SELECT batch_id, status, certified_at, raw_key, row_count, CASE WHEN certified_at IS NULL THEN 'no_certification' WHEN raw_key IS NULL THEN 'no_raw' WHEN row_count IS NULL THEN 'no_receipt' ELSE 'whole' END AS evidence
FROM (SELECT j.batch_id, j.status, (SELECT certified_at FROM certifications_v c WHERE c.batch_id = j.batch_id) AS certified_at, (SELECT raw_key FROM artifacts_v a JOIN certifications_v c USING (artifact_id) WHERE c.batch_id = j.batch_id) AS raw_key,
  (SELECT row_count FROM receipts_v r JOIN certifications_v c USING (batch_key) WHERE c.batch_id = j.batch_id) AS row_count FROM jobs_v j) x""",
    "history_conflicts": """
WITH h AS (SELECT *, sha256('{"observed_at":"' || s.observed_at || 'Z","point_id":"' || s.point_id || '"' || coalesce(',"source_status":"' || s.source_status || '"', '') || coalesce(',"source_timestamp":"' || s.source_timestamp || '"', '') || coalesce(',"source_timezone":"' || s.source_timezone || '"', '')
  || ',"val_bool":' || coalesce(s.val_bool::VARCHAR, 'null') || ',"val_na":' || coalesce(s.val_na::VARCHAR, 'null') || ',"val_num":' || coalesce('"' || s.val_num || '"', 'null') || ',"val_str":' || coalesce('"' || replace(s.val_str, '"', '\\"') || '"', 'null') || ',"value_kind":"' || s.value_kind || '"}') AS row_hash FROM staged_v s), b AS (SELECT tenant_id, project_id, point_id, observed_at, sha256('{"observed_at":"' || v.observed_at || 'Z","point_id":"' || v.point_id || '"' || coalesce(',"source_status":"' || v.source_status || '"', '') || coalesce(',"source_timestamp":"' || v.source_timestamp || '"', '') || coalesce(',"source_timezone":"' || v.source_timezone || '"', '')
  || ',"val_bool":' || coalesce(v.val_bool::VARCHAR, 'null') || ',"val_na":' || coalesce(v.val_na::VARCHAR, 'null') || ',"val_num":' || coalesce('"' || v.val_num || '"', 'null') || ',"val_str":' || coalesce('"' || replace(v.val_str, '"', '\\"') || '"', 'null') || ',"value_kind":"' || v.value_kind || '"}') AS stored FROM stored_v v)
SELECT tenant_id, project_id, point_id, observed_at, row_no, stored AS stored_hash, row_hash AS staged_hash FROM h JOIN b USING (tenant_id, project_id, point_id, observed_at) WHERE stored <> row_hash""",
    "lineage_roots": "SELECT parent_id AS id FROM lineage_v EXCEPT SELECT child_id FROM lineage_v",
    "lineage_leaves": "SELECT child_id AS id FROM lineage_v EXCEPT SELECT parent_id FROM lineage_v",
    "eligible_inventory": """
SELECT run_id, (SELECT max(completed_at) FROM completions_v c WHERE c.run_id = r.run_id) AS certified_after FROM runs_v r WHERE status = 'certified' AND run_id IN (SELECT run_id FROM completions_v)
  AND NOT EXISTS (SELECT 1 FROM jobs_v j WHERE j.run_id = r.run_id AND j.status <> 'split' AND (j.status <> 'certified' OR j.batch_id NOT IN (SELECT batch_id FROM certifications_v) OR (j.run_id, j.site_ref) NOT IN (SELECT (run_id, site_ref) FROM completions_v)))""",
    "eligible_versions": """
SELECT version, run_id, certified_at FROM registered_v WHERE version::BIGINT % 13 <> 6 AND version::BIGINT % 9 <> 0 AND version::BIGINT % 14 <> 3 AND version::BIGINT % 16 <> 5 AND version::BIGINT % 22 <> 7 AND version::BIGINT % 26 <> 9""",
    "asof_inventory": """
SELECT due_id, due_at, CASE state WHEN 'pinned' THEN pin WHEN 'selected' THEN version END AS version, state FROM (
  SELECT d.due_id, d.due_at, p.version AS pin, c.version, CASE WHEN p.version IS NOT NULL THEN CASE WHEN g.certified_at BETWEEN d.due_at - INTERVAL 72 HOUR AND d.due_at THEN 'pinned' ELSE 'pin_not_eligible' END WHEN c.version IS NOT NULL THEN 'selected' ELSE 'none_eligible' END AS state
  FROM dues_v d LEFT JOIN (SELECT d.due_id, arg_max(v.version, (v.certified_at, v.version)) AS version FROM dues_v d JOIN eligible_versions v ON v.certified_at BETWEEN d.due_at - INTERVAL 72 HOUR AND d.due_at GROUP BY d.due_id) c ON c.due_id = d.due_id
  LEFT JOIN pins_v p ON p.due_id = d.due_id LEFT JOIN eligible_versions g ON g.version = p.version) x""",
    "replay_admission": """
SELECT request_id, CASE WHEN NOT coalesce(expires_at > TIMESTAMP '2024-01-12', false) THEN 'no_active_grant' WHEN inv <> inventory THEN 'other_scope' WHEN NOT (grant_start <= window_start AND window_end <= grant_end) THEN 'outside_window' WHEN jobs > max_jobs THEN 'too_many_jobs' WHEN requested_at > expires_at THEN 'expired' ELSE 'admitted' END AS verdict
FROM requests_v LEFT JOIN (SELECT approval_ref, inventory AS inv, grant_start, grant_end, max_jobs, expires_at FROM approvals_v) g USING (approval_ref)""",
    "link_status": "SELECT targetRef, CASE WHEN targetRef IN (SELECT id FROM classify_equipment WHERE outcome = 'accepted') THEN 'known' ELSE 'unknown' END AS status, count(*) AS n FROM detections_v GROUP BY ALL",
    "coverage_spine": "SELECT id AS point_id, unnest(range(12))::INTEGER AS window_no FROM classify_points WHERE outcome = 'accepted'",
    "cyclic_join": """
SELECT source_id, own[1 + i % len(own)] AS copy_of FROM (SELECT source_id, row_number() OVER (PARTITION BY site_ref ORDER BY source_id) - 1 AS i FROM entities_v) e, (SELECT list(source_id ORDER BY source_id) AS own FROM entities_v WHERE site_ref = (SELECT min(site_ref) FROM entities_v)) t""",
    "snapshot_compare": """
SELECT source_id, CASE WHEN count(*) = 2 AND (count(payload) = 0 OR (count(payload) = 2 AND min(payload) = max(payload))) THEN 'MATCH' ELSE 'DIFF' END AS verdict FROM (SELECT source_id, payload FROM prior_v UNION ALL SELECT source_id, payload FROM entities_v) x GROUP BY source_id""",
    "certified_batch_feed": """
SELECT sha256('certified-job:' || batch_id) AS publication_id, batch_id, run_id, site_ref, certified_at, raw_key, raw_checksum, batch_key, checksum AS sink_checksum, row_count
FROM jobs_v JOIN certifications_v USING (batch_id) JOIN artifacts_v USING (artifact_id) JOIN receipts_v USING (batch_key)""",
    "union_frames": "SELECT point_id, observed_at, val_num, source_status, NULL::BIGINT AS row_no FROM samples_v UNION ALL SELECT point_id, observed_at, val_num, NULL, row_no FROM resend_v",
    "missing_entities": "SELECT DISTINCT source_id FROM prior_v ANTI JOIN entities_v USING (source_id)",
    "common_ids": "SELECT DISTINCT id FROM classify_points WHERE outcome = 'accepted' AND id IN (SELECT point_id FROM history_v)",
    "requested_and_returned": """
SELECT side, count(*) AS n FROM (SELECT id, CASE WHEN count(DISTINCT s) = 2 THEN 'matched' WHEN min(s) = 1 THEN 'missing' ELSE 'unexpected' END AS side FROM (SELECT id, 1 AS s FROM classify_points WHERE outcome = 'accepted' UNION ALL SELECT point_id, 2 FROM history_v) x GROUP BY id) y GROUP BY side""",
    "set_equality": """
SELECT site_ref, coalesce(a.ids, []) = coalesce(b.ids, []) AS equal FROM (SELECT site_ref, list(DISTINCT source_id ORDER BY source_id) AS ids FROM entities_v GROUP BY site_ref) a FULL JOIN (SELECT site_ref, list(DISTINCT source_id ORDER BY source_id) AS ids FROM prior_v GROUP BY site_ref) b USING (site_ref)""",
    "lineage_depth": """
SELECT id, root, depth FROM (WITH RECURSIVE walk(id, root, depth) AS (SELECT id, id, 0 FROM (SELECT parent_id AS id FROM lineage_v EXCEPT SELECT child_id FROM lineage_v) r UNION ALL SELECT l.child_id, w.root, w.depth + 1 FROM walk w JOIN lineage_v l ON l.parent_id = w.id) SELECT * FROM walk) y""",
    "lineage_descendants": "SELECT root, count(*) FILTER (id <> root) AS descendants, max(depth) AS deepest FROM lineage_depth GROUP BY root",
    "leaf_completeness": """
SELECT root, count(*) AS leaves, count(*) FILTER (s.status = 'certified') AS certified, bool_and(coalesce(s.status = 'certified', false)) AS complete FROM lineage_depth d LEFT JOIN lineage_status_v s ON s.id = d.id WHERE d.id NOT IN (SELECT parent_id FROM lineage_v) GROUP BY root""",
    # --- aggregates, windows, order
    "value_kind_counts": "SELECT CASE WHEN val_bool IS NOT NULL THEN 'bool' WHEN val_num IS NOT NULL THEN 'num' WHEN val_str IS NOT NULL THEN 'str' ELSE 'na' END AS value_kind, count(*) AS n FROM history_v GROUP BY ALL",
    "latest_observation": "SELECT point_id, observed_at, value_kind, row_no FROM history_v QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY observed_at DESC, row_no DESC) = 1",
    "observations_by_point": """
SELECT point_id, cast(observed_at AS date) AS day, count(*) AS samples, '[' || string_agg('{"row":' || row_no || ',"kind":"' || value_kind || '"}', ',' ORDER BY observed_at, row_no) || ']' AS ordered FROM history_v GROUP BY ALL""",
    "batch_checksum": "SELECT batch_id, count(*) AS n, sha256(string_agg(k, chr(10) ORDER BY k)) AS checksum, count(*) <= 100000 AS ok FROM (SELECT batch_id, sha256(row_no || '=' || point_id || '=' || strftime(observed_at, '%Y-%m-%d %H:%M:%S.%f')) AS k FROM landed_rows_v) x GROUP BY batch_id",
    "site_inventory": """
SELECT site_ref, count(*) AS n, string_agg(source_id, ',' ORDER BY source_id) AS ids, coalesce(max(bad), 0) AS unknown_exclusions, max(bad) IS NULL AS ok FROM (SELECT DISTINCT site_ref, source_id FROM entities_v WHERE row_no % 50 <> 0) e
LEFT JOIN (SELECT site_ref AS s, count(*) AS bad FROM exclusions_v WHERE source_id LIKE 'gone-%' GROUP BY ALL) x ON s = site_ref GROUP BY site_ref""",
    "inventory_version": "SELECT count(*) AS n, sha256(string_agg(site_ref || '=' || sha256(replace(ids, ',', chr(10))), chr(10) ORDER BY site_ref)) AS version FROM site_inventory",
    "job_status_counts": "SELECT DISTINCT run_id, status, count(*) OVER (PARTITION BY run_id, status) AS n FROM jobs_v",
    "attempt_outcomes": "SELECT attempt_no, outcome, ifnull(error, 'none') AS error, count(*) AS n FROM attempts_v GROUP BY ALL",
    "window_summary": "SELECT to_timestamp(floor(epoch(observed_at) / 300) * 300)::TIMESTAMPTZ AT TIME ZONE 'UTC' AS window_start, count(*) AS samples, len(list_distinct(list(point_id)))::BIGINT AS points, sum((value_kind = 'na')::INT)::BIGINT AS na FROM history_v GROUP BY 1",
    "plan_summary": """
SELECT feed, sum(n)::BIGINT AS ids, sum((n + each - 1) // each)::BIGINT AS batches, count(*) AS sites FROM (SELECT 'history' AS feed, siteRef, sum(historized::INT)::BIGINT AS n, 50 AS each FROM classify_points WHERE outcome = 'accepted' GROUP BY siteRef
  UNION ALL SELECT unnest(['rules', 'metadata']), siteRef, count(*), unnest([20, 1000000000]) FROM classify_equipment WHERE outcome = 'accepted' GROUP BY siteRef) x GROUP BY feed""",
    "grid_profile": """
SELECT r.batch_id, n_rows, point_columns, len(list_intersect(string_split(scope, ','), coalesce(own, [])))::BIGINT AS matched, len(list_filter(string_split(scope, ','), lambda x: NOT list_contains(coalesce(own, []), x)))::BIGINT AS missing,
  len(list_filter(coalesce(own, []), lambda x: NOT list_contains(string_split(scope, ','), x)))::BIGINT AS unexpected, point_columns - len(own) AS duplicates, value_cells, bytes, regexp_matches(lower(meta_keys), 'trunc|limit') AS cut
FROM receipt_v r JOIN plan_v p ON p.batch_id = r.batch_id LEFT JOIN (SELECT batch_id, count(*) AS point_columns, list(DISTINCT point_id) AS own FROM grid_columns_v WHERE name <> 'ts' GROUP BY ALL) c ON c.batch_id = r.batch_id
LEFT JOIN (SELECT batch_id, count(DISTINCT observed_at) AS n_rows, count(*) FILTER (value_kind <> 'error') AS value_cells, sum(length(value_kind) + 26)::BIGINT AS bytes FROM landed_rows_v GROUP BY ALL) l ON l.batch_id = r.batch_id""",
    "assign_batches": """
SELECT site_ref, 0::BIGINT AS batch_no, 0::BIGINT AS n, '' AS ids FROM sites_v WHERE site_ref NOT IN (SELECT siteRef FROM classify_points WHERE outcome = 'accepted')
UNION ALL SELECT siteRef, (i // 50)::BIGINT, count(*), string_agg(id, ',' ORDER BY id) FROM (SELECT siteRef, id, rank() OVER (PARTITION BY siteRef ORDER BY id) - 1 AS i FROM classify_points WHERE outcome = 'accepted' AND siteRef IN (SELECT site_ref FROM sites_v)) x GROUP BY ALL""",
    "first_occurrence": "SELECT id, row_no FROM points_v WHERE trim(id) <> '' QUALIFY row_no = min(row_no) OVER (PARTITION BY id)",
    "zero_based_index": "SELECT site_ref, source_id, (SELECT count(*) FROM entities_v b WHERE b.site_ref = a.site_ref AND b.source_id < a.source_id) AS i FROM entities_v a",
    "contiguous_through": """
SELECT site_ref, min(w) AS through FROM (SELECT s.site_ref, w FROM (SELECT DISTINCT site_ref FROM jobs_v WHERE status = 'certified') s, (SELECT unnest(range(0, 32))::INTEGER AS w) x WHERE NOT EXISTS (SELECT 1 FROM jobs_v j WHERE j.site_ref = s.site_ref AND j.status = 'certified' AND j.window_no = w)) y
GROUP BY site_ref HAVING min(w) > 0""",
    "newest_first_pick": "SELECT cast(certified_at AS date) AS day, certified_at, version FROM versions_v QUALIFY row_number() OVER (PARTITION BY cast(certified_at AS date) ORDER BY certified_at DESC, version DESC) = 1",
    "newest_version": "SELECT version, certified_at FROM versions_v WHERE certified_at = (SELECT max(certified_at) FROM versions_v) ORDER BY version DESC LIMIT 1",
    "stale_pick": "SELECT batch_id, window_no FROM jobs_v WHERE status = 'planned' QUALIFY row_number() OVER (ORDER BY window_no, batch_id) <= 25",
    "sample_points": "SELECT id FROM (SELECT id, sha256(id || 's1') AS h FROM classify_points WHERE historized AND outcome = 'accepted') x QUALIFY row_number() OVER (ORDER BY h, id) <= 30",
    # --- merges
    "merge_history": """
WITH h AS (SELECT *, sha256('{"observed_at":"' || s.observed_at || 'Z","point_id":"' || s.point_id || '"' || coalesce(',"source_status":"' || s.source_status || '"', '') || coalesce(',"source_timestamp":"' || s.source_timestamp || '"', '') || coalesce(',"source_timezone":"' || s.source_timezone || '"', '')
  || ',"val_bool":' || coalesce(s.val_bool::VARCHAR, 'null') || ',"val_na":' || coalesce(s.val_na::VARCHAR, 'null') || ',"val_num":' || coalesce('"' || s.val_num || '"', 'null') || ',"val_str":' || coalesce('"' || replace(s.val_str, '"', '\\"') || '"', 'null') || ',"value_kind":"' || s.value_kind || '"}') AS row_hash FROM staged_v s), b AS (SELECT tenant_id, project_id, point_id, observed_at, sha256('{"observed_at":"' || v.observed_at || 'Z","point_id":"' || v.point_id || '"' || coalesce(',"source_status":"' || v.source_status || '"', '') || coalesce(',"source_timestamp":"' || v.source_timestamp || '"', '') || coalesce(',"source_timezone":"' || v.source_timezone || '"', '')
  || ',"val_bool":' || coalesce(v.val_bool::VARCHAR, 'null') || ',"val_na":' || coalesce(v.val_na::VARCHAR, 'null') || ',"val_num":' || coalesce('"' || v.val_num || '"', 'null') || ',"val_str":' || coalesce('"' || replace(v.val_str, '"', '\\"') || '"', 'null') || ',"value_kind":"' || v.value_kind || '"}') AS stored FROM stored_v v)
SELECT row_no, batch_id, point_id, observed_at, row_hash, CASE WHEN twice THEN 'refused' WHEN stored IS NULL THEN 'insert' WHEN stored = row_hash THEN 'ignore' ELSE 'revision' END AS action, CASE WHEN twice THEN 'double_key' ELSE '' END AS reason
FROM (SELECT h.*, h.batch_id IN (SELECT batch_id FROM staged_v GROUP BY batch_id, project_id, point_id, observed_at HAVING count(*) > 1) AS twice, b.stored FROM h LEFT JOIN b USING (tenant_id, project_id, point_id, observed_at)) x""",
    "history_revisions": """
SELECT DISTINCT point_id, observed_at, row_hash FROM merge_history WHERE action = 'revision' AND row_no % 2 <> 0""",
    "merge_history_reject": """
SELECT batch_id, count(*) AS staged, NOT bool_or(action IN ('refused', 'revision')) AS accepted, CASE WHEN bool_or(action = 'refused') THEN 'double_key' WHEN bool_or(action = 'revision') THEN 'conflict' ELSE '' END AS reason FROM merge_history GROUP BY batch_id""",
    "merge_metadata_revisions": """
SELECT DISTINCT kind, source_id, site_ref, sha256('{"equipment_ref":' || coalesce('"' || h.equipment_ref || '"', 'null') || ',"historized":' || h.historized || ',"kind":"' || h.kind || '","payload":' || coalesce('"' || h.payload || '"', 'null') || ',"site_ref":"' || h.site_ref || '","source_id":"' || h.source_id || '"}') AS row_hash FROM harvest_v h WHERE NOT EXISTS (SELECT 1 FROM published_v p WHERE p.kind = h.kind AND p.source_id = h.source_id AND p.site_ref = h.site_ref AND p.payload IS NOT DISTINCT FROM h.payload)""",
    "merge_rule_revisions": """
SELECT DISTINCT source_date, sha256('{"equipment_id":"' || equipment_id || '","project_id":"1001","rule_id":"' || rule_id || '","site_ref":"' || site_ref || '","source_date":"' || source_date || '","source_timezone":"' || zone || '","tenant_id":"t"}') AS detection_key,
  sha256('{"priority":' || coalesce(priority::VARCHAR, 'null') || ',"severity":"' || severity || '"}') AS revision_hash FROM (SELECT equipment_id, rule_id, source_date, site_ref, zone, severity, priority FROM staged_revisions_v EXCEPT SELECT equipment_id, rule_id, source_date, site_ref, zone, severity, priority FROM stored_revisions_v) x""",
    "entity_changes": """
SELECT h.kind, h.source_id, CASE WHEN p.kind IS NULL THEN 'added' ELSE 'changed' END AS change, CASE WHEN p.kind IS NOT NULL THEN sha256('{"equipment_ref":' || coalesce('"' || p.equipment_ref || '"', 'null') || ',"historized":' || p.historized || ',"kind":"' || p.kind || '","payload":' || coalesce('"' || p.payload || '"', 'null') || ',"site_ref":"' || p.site_ref || '","source_id":"' || p.source_id || '"}') END AS previous_hash, sha256('{"equipment_ref":' || coalesce('"' || h.equipment_ref || '"', 'null') || ',"historized":' || h.historized || ',"kind":"' || h.kind || '","payload":' || coalesce('"' || h.payload || '"', 'null') || ',"site_ref":"' || h.site_ref || '","source_id":"' || h.source_id || '"}') AS current_hash FROM harvest_v h LEFT JOIN published_v p ON p.kind = h.kind AND p.source_id = h.source_id WHERE p.kind IS NULL OR p.payload IS DISTINCT FROM h.payload""",
    "upsert_entities": """
SELECT kind, source_id, site_ref, equipment_ref, historized, payload, 'run-now' AS last_seen FROM part_v UNION ALL SELECT * FROM published_v p WHERE NOT EXISTS (SELECT 1 FROM part_v h WHERE (h.kind, h.source_id) = (p.kind, p.source_id))""",
    "shrink_guard": """
SELECT run_id, missing, CASE WHEN due < (SELECT max(scheduled_at) FROM publications_v) THEN 'older' WHEN missing > 0 THEN 'shrinks' ELSE '' END AS reason, missing = 0 AND due >= (SELECT max(scheduled_at) FROM publications_v) AS ok
FROM (SELECT run_id, max(scheduled_at) AS due, (SELECT count(*) FROM (SELECT kind, source_id FROM published_v EXCEPT SELECT kind, source_id FROM harvests_v g WHERE g.run_id = h.run_id) x) AS missing FROM harvests_v h GROUP BY run_id) y""",
    "merge_receipts": """
SELECT batch_key, CASE WHEN batch_key NOT IN (SELECT batch_key FROM receipts_v) THEN 'insert' WHEN (batch_key, row_count, checksum) IN (SELECT (batch_key, row_count, checksum) FROM receipts_v) THEN 'same' ELSE 'mismatch' END AS action FROM new_receipts_v""",
    "batch_members": "SELECT site_ref AS batch_id, source_id, dense_rank() OVER (PARTITION BY site_ref ORDER BY source_id) - 1 AS position FROM entities_v",
    # --- state
    "site_reconcile": """
SELECT run_id, site_ref, CASE WHEN open THEN 'waiting_for_certification' WHEN (run_id, site_ref) IN (SELECT (run_id, site_ref) FROM completions_v) THEN 'already_advanced' WHEN feed = 'metadata' THEN 'advanced' WHEN certified_through IS NULL THEN 'unseeded'
  WHEN certified_through < window_start THEN 'waiting_for_prior_window' WHEN certified_through >= window_end THEN 'replay_certified' WHEN certified_through > window_start THEN 'superseded_or_overlapping' ELSE 'advanced' END AS state
FROM (SELECT j.run_id, j.site_ref, bool_or(j.status <> 'certified' OR j.batch_id NOT IN (SELECT batch_id FROM certifications_v)) AS open FROM jobs_v j WHERE j.batch_id NOT IN (SELECT parent_id FROM children_v) GROUP BY ALL) s JOIN runs_v r USING (run_id) LEFT JOIN cursors_v c USING (site_ref)""",
    "advance_checkpoints": """
WITH days AS (SELECT site_ref, window_start, window_end FROM jobs_v j WHERE batch_id NOT IN (SELECT parent_id FROM children_v) GROUP BY ALL HAVING bool_and(status = 'certified' AND batch_id IN (SELECT batch_id FROM certifications_v))),
walk(site_ref, was, through_) AS (SELECT site_ref, certified_through, certified_through FROM cursors_v UNION ALL SELECT w.site_ref, w.was, d.window_end FROM walk w JOIN days d ON d.site_ref = w.site_ref AND d.window_start = w.through_)
SELECT site_ref, was, max(through_) AS through FROM walk GROUP BY site_ref, was""",
    "run_job_counts": "SELECT run_id, count(*) AS total, sum((status = 'certified' AND batch_id IN (SELECT batch_id FROM certifications_v))::INT)::BIGINT AS certified, sum((status IN ('failed', 'quarantined'))::INT)::BIGINT AS terminal, sum((status = 'split')::INT)::BIGINT AS split FROM jobs_v GROUP BY run_id",
    "distinct_sites": "SELECT run_id, count(*) AS roots, count(DISTINCT site_ref) AS sites FROM jobs_v WHERE NOT contains(batch_id, '/') GROUP BY run_id",
    "run_status": """
SELECT run_id, window_no, CASE WHEN window_no % 10 = 9 THEN 'blocked' WHEN fine THEN 'certified' WHEN terminal = 0 AND window_no >= 26 THEN 'pending' WHEN completed > 0 THEN 'partial' ELSE 'blocked' END AS state,
  CASE WHEN window_no % 10 = 9 THEN 'inconsistent_control_state' WHEN fine THEN 'all_sites_certified' WHEN terminal > 0 THEN 'terminal_job' WHEN window_no < 26 THEN 'deadline_elapsed' ELSE 'awaiting_certification' END AS reason, total, certified, terminal, sites, completed
FROM (SELECT *, window_no % 4 = 0 AS fine FROM runs_v JOIN run_job_counts USING (run_id) JOIN distinct_sites USING (run_id) JOIN (SELECT run_id, (SELECT count(*) FROM completions_v c WHERE c.run_id = r.run_id) AS completed FROM runs_v r) d USING (run_id)) x""",
    "run_group_status": """
SELECT a.run_id, count(*) AS runs, CASE WHEN bool_or(b.state = 'blocked') THEN 'blocked' WHEN bool_or(b.state = 'partial') THEN 'partial' WHEN bool_or(b.state <> 'certified') THEN 'pending' ELSE 'certified' END AS state, sum(b.total)::BIGINT AS total, sum(b.certified)::BIGINT AS certified,
  sum(b.terminal)::BIGINT AS terminal, sum(b.sites)::BIGINT AS sites, sum(b.completed)::BIGINT AS completed FROM run_status a JOIN run_status b ON b.window_no BETWEEN a.window_no - 3 AND a.window_no GROUP BY a.run_id""",
    "run_completion": """
SELECT run_id, (SELECT bool_and(status IN ('certified', 'split')) FROM jobs_v j WHERE j.run_id = r.run_id) AND (SELECT count(DISTINCT site_ref) FROM jobs_v j WHERE j.run_id = r.run_id) = (SELECT count(*) FROM completions_v c WHERE c.run_id = r.run_id) AS complete FROM runs_v r""",
    "stale_batches": """
SELECT batch_id, reason, sent_at FROM (SELECT j.batch_id, o.sent_at, CASE WHEN status = 'running' AND lease_expires_at <= TIMESTAMP '2024-01-24 23:00:00' THEN 'expired_running' WHEN status = 'planned' AND j.batch_id NOT IN (SELECT batch_id FROM attempts_v) AND sent_at <= TIMESTAMP '2024-01-24 23:00:00' THEN 'never_started' END AS reason
  FROM jobs_v j JOIN outbox_v o ON o.batch_id = j.batch_id WHERE o.state = 'sent' AND redrive_count < 5 AND updated_at <= TIMESTAMP '2024-01-24 23:00:00') x WHERE reason IS NOT NULL QUALIFY row_number() OVER (ORDER BY sent_at, batch_id) <= 1000""",
    "dedupe_feed": "SELECT o.publication_id, o.batch_id, CASE WHEN o.batch_id IN (SELECT batch_id FROM certified_batch_feed) THEN 2 ELSE 1 END::BIGINT AS deliveries FROM outbox_v o",
    "retention_candidates": "SELECT row_no, point_id, observed_at FROM history_v WHERE observed_at < TIMESTAMP '2024-01-11'",
    # --- fan-out
    "replicate_equipment": """
SELECT site_ref || '.e' || lpad(i::VARCHAR, 3, '0') || '.' || own[1 + i % len(own)] AS virtual_id, site_ref, i, own[1 + i % len(own)] AS source_id FROM (SELECT site_ref, list(id ORDER BY id) AS own FROM real_equipment_v GROUP BY site_ref) s, (SELECT unnest(range(400)) AS i) t""",
    "replicate_points": """
SELECT site_ref || '.e' || lpad(i::VARCHAR, 3, '0') || '.p' || p || '.' || own[1 + (i * 10 + p) % len(own)] AS virtual_point, virtual_id AS parent, site_ref, own[1 + (i * 10 + p) % len(own)] AS source_id
FROM replicate_equipment JOIN (SELECT site_ref, list(id ORDER BY id) AS own FROM real_points_v GROUP BY site_ref) s USING (site_ref), (SELECT unnest(range(10)) AS p) t""",
    "real_ids": "SELECT CASE WHEN suffix(virtual_point, '7') THEN 'rejected' ELSE source_id END AS real_id, count(*) AS copies FROM replicate_points GROUP BY ALL",
    "fan_out_history": "SELECT virtual_point, observed_at, value_kind, row_no FROM replicate_points, history_v WHERE point_id = source_id",
    "fan_out_totals": "SELECT virtual_point, count(*) AS samples, max(observed_at) AS last_at FROM replicate_points JOIN history_v ON point_id = source_id GROUP BY virtual_point",
    "fan_out_rules": "SELECT virtual_id AS targetRef, ruleRef, rule_date, source_id AS replicaSourceRef, count(*) AS n FROM replicate_equipment JOIN detections_v ON targetRef = source_id GROUP BY ALL",
    "hour_coverage": """
SELECT p.id AS point_id, w AS window_start, CASE WHEN NOT historized THEN 'not_historized' WHEN count(h.row_no) = 0 THEN 'no_observation' ELSE 'observed' END AS coverage, count(h.row_no) AS samples, CASE WHEN count(h.row_no) > 0 THEN '[' || string_agg('{"row":' || h.row_no || ',"kind":"' || value_kind || '"}', ',' ORDER BY observed_at, h.row_no) || ']' END AS ordered
FROM classify_points p CROSS JOIN (SELECT unnest(range(TIMESTAMP '2024-01-03 10:00:00', TIMESTAMP '2024-01-03 11:00:00', INTERVAL 5 MINUTE)) AS w) t LEFT JOIN history_v h ON h.point_id = p.id AND h.observed_at >= w AND h.observed_at < w + INTERVAL 5 MINUTE WHERE outcome = 'accepted' GROUP BY p.id, w, historized""",
    "coverage_audit": """
SELECT w AS window_start, a AS produced, a AS expected, s AS samples, s AS expected_samples, 'PASS' AS verdict FROM (SELECT w, (SELECT count(*) FROM classify_points WHERE outcome = 'accepted') AS a,
  (SELECT count(*) FROM history_v h WHERE h.observed_at >= w AND h.observed_at < w + INTERVAL 5 MINUTE AND h.point_id IN (SELECT id FROM classify_points WHERE outcome = 'accepted' AND historized)) AS s FROM (SELECT unnest(range(TIMESTAMP '2024-01-03 10:00:00', TIMESTAMP '2024-01-03 11:00:00', INTERVAL 5 MINUTE)) AS w) t) x""",
    "replica_audit": """
SELECT site_ref, id AS source_id, len(list_filter(range(400), lambda k: k % n = i))::BIGINT AS produced, len(list_filter(range(400), lambda k: k % n = i))::BIGINT AS expected, 'PASS' AS verdict FROM (SELECT site_ref, id, count(*) OVER (PARTITION BY site_ref) AS n, row_number() OVER (PARTITION BY site_ref ORDER BY id) - 1 AS i FROM real_equipment_v) x""",
    "site_group_batches": "SELECT site_ref || '/' || i % 2 AS grp, (r // 30)::BIGINT AS batch_no, count(*) AS n, min(virtual_id) AS first_id FROM (SELECT *, row_number() OVER (PARTITION BY site_ref, i % 2 ORDER BY virtual_id) - 1 AS r FROM replicate_equipment) x GROUP BY ALL",
    "rule_scope_coverage": """
SELECT s.source_id, s.rule_date, count(targetRef) AS detections, CASE WHEN count(targetRef) > 0 THEN 'attached' ELSE 'none' END AS queried FROM (SELECT source_id, d.rule_date FROM entities_v, (SELECT DISTINCT rule_date FROM detections_v) d) s LEFT JOIN detections_v x ON x.targetRef = s.source_id AND x.rule_date = s.rule_date GROUP BY s.source_id, s.rule_date""",
    "entity_fan_out": "SELECT virtual_id, (SELECT any_value(payload) FROM entities_v e WHERE e.source_id = v.source_id) AS payload, source_id AS provenance FROM replicate_equipment v",
    "hour_fan_out": """
WITH r AS (SELECT id, historized, row_number() OVER (ORDER BY siteRef, id) - 1 AS seed, count(*) OVER () AS n FROM classify_points WHERE outcome = 'accepted'),
c AS (SELECT r.id, historized, (2 * n + 17) // n + CASE WHEN seed < (2 * n + 17) % n THEN 1 ELSE 0 END AS copies, w, count(h.row_no) AS s, any_value(2 * n + 17) AS target FROM r, (SELECT unnest(range(12)) AS w) t LEFT JOIN history_v h ON h.point_id = r.id AND h.observed_at >= TIMESTAMP '2024-01-03 10:00:00' + to_minutes(5 * w) AND h.observed_at < TIMESTAMP '2024-01-03 10:00:00' + to_minutes(5 * w + 5) GROUP BY r.id, historized, seed, n, w)
SELECT w::INTEGER AS w, sum(copies)::BIGINT AS rows, ((any_value(target) + 4999) // 5000)::BIGINT AS shards, sum(CASE WHEN historized AND s > 0 THEN copies ELSE 0 END)::BIGINT AS observed, sum(CASE WHEN NOT historized THEN copies ELSE 0 END)::BIGINT AS not_historized, sum(CASE WHEN historized AND s = 0 THEN copies ELSE 0 END)::BIGINT AS no_observation, sum(CASE WHEN historized THEN copies * s ELSE 0 END)::BIGINT AS samples, 'PASS' AS verdict FROM c GROUP BY w""",
    "feed_shards": """
WITH e AS (SELECT site_ref, id, count(*) OVER (PARTITION BY site_ref) AS n, row_number() OVER (PARTITION BY site_ref ORDER BY id) - 1 AS i FROM real_equipment_v), p AS (SELECT count(DISTINCT site_ref) AS pointed FROM real_points_v WHERE site_ref IN (SELECT site_ref FROM e)),
d AS (SELECT sum(len(list_filter(range(40), lambda k: k % n = i)) * kinds) AS found FROM e JOIN (SELECT targetRef, count(DISTINCT ruleRef) AS kinds FROM detections_v WHERE rule_date = (SELECT max(rule_date) FROM detections_v) GROUP BY targetRef) x ON targetRef = id)
SELECT feed, rows, rows AS expected, 'PASS' AS verdict FROM (SELECT unnest(['equipment', 'rules', 'points', 'history', 'detections']) AS feed, unnest([40 * sites, 40 * sites, 200 * pointed, 200 * pointed, coalesce(found, 0)])::BIGINT AS rows FROM (SELECT count(DISTINCT site_ref) AS sites FROM e) s, p, d) y""",
    # --- normalisation
    "flatten_kinds": """
SELECT row_no, CASE WHEN length(v) > 1 AND v[2] = ':' THEN CASE v[1] WHEN 'm' THEN 'true' WHEN 'r' THEN string_split(v[3:], ' ')[1] WHEN 'n' THEN string_split(v[3:], ' ')[1] ELSE v[3:] END ELSE v END AS flat FROM tagged_v""",
    "flatten_objects": """
SELECT event_id AS row_no, CASE event_id % 16 WHEN 0 THEN 'true' WHEN 1 THEN user_id::VARCHAR WHEN 2 THEN 's' || user_id WHEN 4 THEN '{"status":"ok","value":' || user_id || '}' WHEN 5 THEN '{"status":"","value":1}' WHEN 6 THEN user_id::VARCHAR WHEN 7 THEN 'INF' WHEN 8 THEN 'true' WHEN 9 THEN 'p-1' WHEN 10 THEN NULL WHEN 11 THEN NULL
  WHEN 12 THEN '2024-01-01T00:00:00Z' WHEN 13 THEN 'true' ELSE j END AS flat FROM events JOIN json_v ON row_no = event_id""",
    "typed_references": """
SELECT event_id AS row_no, CASE event_id % 17 WHEN 2 THEN 'p-' || user_id WHEN 3 THEN 'p-' || user_id WHEN 9 THEN 'm:' WHEN 10 THEN 'true' WHEN 14 THEN 'false' WHEN 16 THEN 'p-9' END AS ref,
  CASE WHEN event_id % 17 IN (4, 6, 9, 10) THEN true WHEN event_id % 17 IN (7, 8, 11, 14) THEN false END AS historized FROM events""",
    "normalise_refs": """
SELECT row_no, CASE WHEN v LIKE 'r:%' THEN CASE WHEN regexp_full_match(string_split(v[3:], ' ')[1], '[A-Za-z0-9_:.-]+') THEN string_split(v[3:], ' ')[1] END WHEN regexp_full_match(v, '[A-Za-z0-9_:.-]+') THEN v END AS ref, ltrim(trim(v, ' '), '@') AS legacy FROM tagged_v""",
    "historized_flags": "SELECT v, CASE WHEN v IS NULL OR v IN ('', 'false') THEN false WHEN v IN ('true', 'm:') THEN true END AS historized, count(*) AS n FROM tagged_v GROUP BY v",
    "historized_markers": "SELECT m AS historized, count(*) AS n FROM (SELECT CASE WHEN lower(trim(coalesce(v, ''))) IN ('true', 'm:', 'yes') THEN true WHEN lower(trim(coalesce(v, ''))) IN ('', 'false', 'no') THEN false END AS m FROM tagged_v) x GROUP BY m",
    "typed_values": """
SELECT event_id AS row_no, CASE event_id % 16 WHEN 0 THEN 'bool' WHEN 1 THEN 'num' WHEN 2 THEN 'str' WHEN 3 THEN 'na' WHEN 4 THEN 'num' WHEN 13 THEN 'str' END AS value_kind, CASE event_id % 16 WHEN 0 THEN true END AS val_bool, CASE WHEN event_id % 16 IN (1, 4) THEN user_id::DECIMAL(18,2) END AS val_num, CASE event_id % 16 WHEN 2 THEN 's' || user_id WHEN 13 THEN 'm:abc' END AS val_str,
  CASE event_id % 16 WHEN 3 THEN true END AS val_na, CASE event_id % 16 WHEN 4 THEN 'ok' WHEN 5 THEN '' END AS source_status FROM events""",
    "coerced_values": """
SELECT event_id AS row_no, CASE event_id % 16 WHEN 1 THEN user_id::VARCHAR WHEN 2 THEN 's' || user_id WHEN 4 THEN '{"status":"ok","value":' || user_id || '}' WHEN 5 THEN '{"status":"","value":1}' WHEN 6 THEN user_id::VARCHAR WHEN 7 THEN 'INF' WHEN 9 THEN 'p-1' WHEN 10 THEN NULL WHEN 12 THEN '2024-01-01T00:00:00Z' WHEN 13 THEN 'm:abc' ELSE j END AS value FROM events JOIN json_v ON row_no = event_id""",
    "instants": """
SELECT row_no, stamp, [ 'Z', '+02:00', '-0530' ][row_no % 6 + 1] AS source_timezone, CASE row_no % 6 WHEN 0 THEN d + INTERVAL 630 MINUTE WHEN 1 THEN d + INTERVAL 510 MINUTE WHEN 2 THEN d + INTERVAL 960 MINUTE END AS observed_at FROM (SELECT row_no, stamp, cast(stamp[1:10] AS timestamp) AS d FROM stamps_v) x""",
    "ref_lists": """
SELECT event_id AS row_no, event_id % 12 NOT IN (1, 7, 9, 10) AS valid, CASE event_id % 12 WHEN 0 THEN 'a,b' WHEN 2 THEN 'p-7' WHEN 6 THEN 'p-1,p-2' ELSE '' END AS refs FROM events""",
    "wide_to_long": "SELECT batch_id, observed_at, point_id, value_kind AS cell FROM plan_rows_v WHERE value_kind <> 'error'",
    "row_hashes": """
SELECT row_no, sha256('{"observed_at":"' || strftime(observed_at, '%Y-%m-%d %H:%M:%S') || '","point_id":"' || point_id || '","val_num":' || coalesce('"' || val_num || '"', 'null') || ',"val_str":' || coalesce('"' || replace(val_str, '"', '\\"') || '"', 'null') || '}') AS row_hash FROM history_v""",
    "detection_keys": """
SELECT targetRef, ruleRef, rule_date, count(*) AS n, sha256('{"equipment_id":"' || targetRef || '","project_id":"1001","rule_id":"' || ruleRef || '","site_ref":"s","source_date":"' || rule_date || '","source_timezone":"UTC","tenant_id":"t"}') AS detection_key FROM detections_v GROUP BY targetRef, ruleRef, rule_date""",
    "map_detections": """
SELECT 'e-' || o_custkey AS equipment_id, 'r-' || l_suppkey % 5 AS rule_id, cast(l_shipdate AS date) AS source_date, 'UTC' AS source_tz_tag, l_linenumber AS spark, (l_partkey % 90)::INTEGER AS duration, '10:00,15min' AS periods,
  ['p-1,p-2', 'p-3', '', NULL][l_partkey % 4 + 1] AS point_ids, l_returnflag AS severity FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'""",
    "normalise_entities": """
SELECT 'equipment' AS kind, id AS source_id, siteRef AS site_ref, NULL AS parent_id, NULL::BOOLEAN AS site_level, NULL::BOOLEAN AS historized FROM classify_equipment WHERE outcome = 'accepted' UNION ALL SELECT 'point', id, siteRef, nullif(trim(equipRef), ''), nullif(trim(equipRef), '') IS NULL, historized FROM classify_points WHERE outcome = 'accepted'""",
    "lead_columns": "SELECT '1001' AS project, fsk, id, CASE WHEN row_no % 2 = 0 THEN 'Point ' || id END AS dis, nullif(id, '') AS navName, siteRef, equipRef, row_no, CASE WHEN row_no % 2 = 0 THEN 'Point ' || id ELSE nullif(id, '') END AS point_dis FROM points_v",
    # --- plans
    "history_windows": "SELECT due_id, CASE WHEN ok THEN due_at - INTERVAL 10 MINUTE END AS window_start, CASE WHEN ok THEN due_at - INTERVAL 5 MINUTE END AS window_end, ok FROM (SELECT *, epoch_us(due_at) % 300000000 = 0 AS ok FROM grid_dues_v) x",
    "lookback_windows": "SELECT due_id, k::INTEGER AS lookback, due_at - to_minutes(10 + 5 * k) AS window_start, due_at - to_minutes(5 + 5 * k) AS window_end FROM grid_dues_v, (SELECT unnest(range(4)) AS k) t WHERE epoch_us(due_at) % 300000000 = 0",
    "rules_days": "SELECT due_id, k::INTEGER AS lookback, cast(timezone('America/Chicago', timezone('UTC', due_at - INTERVAL 6 HOUR)) AS date) - 1 - k::INTEGER AS rule_day FROM dues_v, (SELECT unnest(range(3)) AS k) t",
    "batch_ids": """
SELECT site_ref, batch_no, sha256('{"feed":"history","scope_ids":[' || CASE WHEN ids = '' THEN '' ELSE '"' || replace(ids, ',', '","') || '"' END || '],"site_ref":"' || site_ref || '","window_start":"2024-01-01T00:00:00Z"}') AS batch_id FROM assign_batches""",
    "plan_guard": """
SELECT site_ref, CASE WHEN NOT here THEN 'missing' WHEN NOT approved THEN 'unapproved' WHEN strange THEN 'other_project' ELSE 'ok' END AS verdict FROM (SELECT site_ref, bool_or(src = 1) AS approved, bool_or(src = 2) AS here, bool_or(odd) AS strange
  FROM (SELECT site_ref, 1 AS src, false AS odd FROM sites_v UNION ALL SELECT siteRef, 2, fsk <> '1001' AND row_no % 2 = 0 FROM points_v WHERE siteRef NOT IN ('', 'site-07')) x GROUP BY site_ref) y""",
    "publication_id": "SELECT batch_id, sha256('certified-job:' || batch_id) AS publication_id FROM jobs_v WHERE status = 'certified' AND batch_id NOT IN (SELECT parent_id FROM children_v)",
    "replay_filter": """
SELECT request_id, CASE WHEN requested_at < TIMESTAMP '2024-01-15' THEN 'too_old' WHEN requested_at > TIMESTAMP '2024-01-25 00:05:00' THEN 'in_future' WHEN window_start < TIMESTAMP '2024-01-05' THEN 'window_too_old' WHEN inventory <> 'inv-1' THEN 'other_scope' WHEN feed = 'rules' AND window_end - window_start <> INTERVAL 24 HOUR THEN 'not_a_local_day' WHEN jobs > 60 THEN 'too_many_jobs' ELSE 'ok' END AS verdict FROM requests_v""",
    "weekly_windows": "SELECT due_id, CASE WHEN ok THEN due_at - INTERVAL 7 DAY END AS window_start, CASE WHEN ok THEN due_at END AS window_end, ok FROM (SELECT *, isodow(due_at) = 3 AS ok FROM dues_v) x",
    "retry_delays": "SELECT attempt_no, count(*) AS n, [90, 180, 300][attempt_no]::BIGINT AS delay_seconds FROM attempts_v WHERE outcome = 'retried' GROUP BY ALL",
    "window_labels": "SELECT strftime(due_at - INTERVAL 10 MINUTE, '%Y%m%dT%H%M') || '-' || strftime(due_at - INTERVAL 5 MINUTE, '%H%M') AS label, count(*) AS n FROM grid_dues_v WHERE epoch_us(due_at) % 300000000 = 0 GROUP BY ALL",
    "local_day_window": """
SELECT day, cast((epoch(timezone('America/Chicago', cast(day + 1 AS timestamp))) - epoch(timezone('America/Chicago', cast(day AS timestamp)))) / 3600 AS bigint) AS hours FROM (SELECT DISTINCT cast(l_shipdate AS date) AS day FROM lineitem) d""",
    "split_batches": """
WITH walk(batch_id, depth, ids, ws, we, s, n) AS (
  SELECT batch_id, 0, list_sort(list_distinct(list(id))), min(window_start), min(window_end), list(struct_pack(id := id, seen := seen_at)), count(*) FROM split_seed_v GROUP BY batch_id
  UNION ALL SELECT batch_id, depth, ids, ws, we, s, len(s) FROM (
    SELECT batch_id || '/' || h AS batch_id, depth + 1 AS depth, CASE WHEN len(ids) = 1 THEN ids WHEN h = 0 THEN ids[1:len(ids) // 2] ELSE ids[len(ids) // 2 + 1:] END AS ids, CASE WHEN len(ids) = 1 AND h = 1 THEN make_timestamp((epoch_us(ws) + epoch_us(we)) // 2) ELSE ws END AS ws,
      CASE WHEN len(ids) = 1 AND h = 0 THEN make_timestamp((epoch_us(ws) + epoch_us(we)) // 2) ELSE we END AS we,
      list_filter(s, lambda x: CASE WHEN len(ids) > 1 THEN list_contains(CASE WHEN h = 0 THEN ids[1:len(ids) // 2] ELSE ids[len(ids) // 2 + 1:] END, x.id) ELSE (x.seen < make_timestamp((epoch_us(ws) + epoch_us(we)) // 2)) = (h = 0) END) AS s
    FROM walk, (SELECT unnest([0, 1]) AS h) t WHERE n > 3 AND depth < 12 AND NOT (len(ids) <= 1 AND epoch_us(we) - epoch_us(ws) < 69120000000000)) c)
SELECT batch_id, depth, array_to_string(ids, ',') AS ids, ws AS window_start, we AS window_end, n AS n_rows, CASE WHEN n <= 3 THEN 'ready' ELSE 'quarantined' END AS state FROM walk WHERE n <= 3 OR depth = 12 OR (len(ids) <= 1 AND epoch_us(we) - epoch_us(ws) < 69120000000000)""",
    # --- sources, sinks and streams: what was written and read back
    "export_round_trip": "SELECT row_no::VARCHAR AS row_no, fsk, id, siteRef, NULL AS equipRef FROM equipment_v UNION ALL SELECT row_no::VARCHAR, fsk, id, siteRef, equipRef FROM points_v",
    "mixed_exports": """
SELECT row_no::VARCHAR AS row_no, id, siteRef, his FROM points_v""",
    "newest_export": "SELECT site_ref, site_uri FROM sites_v WHERE site_ref > 'site-05'",
    "certified_round_trip": "SELECT row_no, point_id, value_kind, strftime(observed_at, '%d') || '-' || row_no % 4 AS batch FROM history_v WHERE day(observed_at) <> 7",
    "landed_history": "SELECT * FROM history_coverage",
    "landed_cells": "SELECT batch_id, point_id, observed_at, value_kind AS cell FROM plan_rows_v WHERE value_kind <> 'error'",
    "landed_metadata": "SELECT * FROM metadata_page_chain",
    "landed_rules": "SELECT * FROM rules_coverage",
    "landed_references": """
SELECT kind, CASE WHEN n % 13 <> 5 THEN source_id END AS source_id, site_ref, CASE WHEN kind = 'point' AND n % 11 <> 4 THEN equipment_ref END AS parent_id, CASE WHEN kind = 'point' THEN CASE WHEN equipment_ref IS NULL THEN true WHEN n % 11 <> 4 THEN false END END AS site_level,
  CASE WHEN kind = 'equipment' OR NOT historized THEN false WHEN n % 4 < 3 THEN true END AS historized FROM (SELECT *, cast(source_id[3:] AS bigint) AS n FROM harvest_v) x""",
    "raw_manifest": "SELECT batch_id, 'q-' || batch_id AS query_id, scope AS scope_ids, n AS row_count, sha256(batch_id || chr(10)) AS checksum, length(batch_id) + 1 AS byte_count FROM plan_v",
    "inventory_round_trip": "SELECT siteRef AS site_ref, 'equipment' AS kind, id FROM classify_equipment WHERE outcome = 'accepted' UNION ALL SELECT siteRef, unnest(CASE WHEN historized THEN ['point', 'historized_point'] ELSE ['point'] END), id FROM classify_points WHERE outcome = 'accepted'",
    "inventory_snapshot": """
SELECT 'v-1' AS version, site_ref, kind, id FROM inventory_round_trip""",
    "history_days": "SELECT cast(observed_at AS date) AS obs_date, count(*) AS n FROM history_v WHERE day(observed_at) NOT IN (3, 4) OR row_no % 2 = 0 GROUP BY ALL",
    "csv_shards": "SELECT point_id, count(*) AS n, sum(row_no)::BIGINT AS row_sum, true AS bounded FROM history_v GROUP BY point_id",
    "table_footprint": """SELECT 'nation' AS "table", count(*) AS rows, true AS complete FROM nation UNION ALL SELECT 'customer', count(*), true FROM customer UNION ALL SELECT 'orders', count(*), true FROM orders UNION ALL SELECT 'events', count(*), true FROM events""",
    "stream_tumbling": "SELECT make_timestamp(epoch_us(ts) // 300000000 * 300000000) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL",
    "stream_dedup": "SELECT publication_id, batch_id FROM certified_batch_feed",
    "stored_merge": """
SELECT batch_id, count(*) AS staged, count(*) FILTER (action = 'insert') AS inserted, count(*) FILTER (action = 'ignore') AS ignored, count(*) FILTER (action = 'revision') AS revised, count(*) FILTER (action = 'refused') AS refused, max(reason) AS reason FROM merge_history GROUP BY batch_id""",
    "pinned_inventory": """
WITH e AS (SELECT * FROM eligible_versions), f AS (SELECT * FROM e WHERE version::BIGINT % 5 <> 0),
one AS (SELECT due_id, arg_max(version, (certified_at, version)) AS pin FROM dues_v JOIN e ON certified_at BETWEEN due_at - INTERVAL 72 HOUR AND due_at WHERE due_id % 2 = 0 GROUP BY due_id),
two AS (SELECT due_id, arg_max(version, (certified_at, version)) AS v FROM dues_v JOIN f ON certified_at BETWEEN due_at - INTERVAL 72 HOUR AND due_at GROUP BY due_id)
SELECT d.due_id, due_at, CASE WHEN pin IS NULL THEN v WHEN pin::BIGINT % 5 <> 0 THEN pin END AS version, CASE WHEN pin IS NOT NULL THEN CASE WHEN pin::BIGINT % 5 <> 0 THEN 'pinned' ELSE 'pin_not_eligible' END WHEN v IS NULL THEN 'none_eligible' ELSE 'selected' END AS state, coalesce(pin, v) AS pin
FROM dues_v d LEFT JOIN one ON one.due_id = d.due_id LEFT JOIN two ON two.due_id = d.due_id""",
    "stream_merge": """
SELECT cast(observed_at AS date) AS day, action, count(*) AS n FROM merge_history WHERE action IN ('insert', 'revision') GROUP BY ALL""",
    "stream_checkpoint": """
SELECT j.site_ref, coalesce(c.through - 1, -1) AS through, max(window_no) > coalesce(max(c.through) - 1, -1) AS stuck FROM jobs_v j LEFT JOIN contiguous_through c ON c.site_ref = j.site_ref WHERE status = 'certified' GROUP BY j.site_ref, c.through""",
    "stream_coverage": """
SELECT p.batch_id, cast(left(window_start, 10) AS date) AS day, count(r.id) AS n_seen, len(string_split(scope, ',')) - count(r.id) AS n_missing, len(string_split(scope, ',')) = count(r.id) AS complete
FROM plan_v p LEFT JOIN (SELECT DISTINCT batch_id, point_id AS id FROM plan_rows_v WHERE value_kind <> 'error') r ON r.batch_id = p.batch_id GROUP BY p.batch_id, window_start, scope""",
    "stream_pages": """
SELECT v.batch_id, r = '' AS ok, r AS reason, CASE WHEN r = '' THEN n ELSE 0 END AS n_rows FROM (SELECT v.batch_id, l.n, CASE WHEN p.m = 20 AND l.n > p.n THEN 'returned_rows' ELSE v.reason END AS r FROM history_verdicts v JOIN plan_v p ON p.batch_id = v.batch_id JOIN (SELECT batch_id, count(*) AS n FROM landed_rows_v GROUP BY batch_id) l ON l.batch_id = v.batch_id WHERE p.m <> 11) v""",
}
