"""Views that give the provided tables the shapes of building telemetry."""

from __future__ import annotations

from tagflow.sqlops import Operator

VIEWS = {
    "sites_v": Operator("SELECT concat('site-', lpad(cast(n_nationkey AS string), 2, '0')) AS site_ref, n_name AS site_uri FROM {nation} WHERE n_nationkey < 23"),
    "equipment_v": Operator("""
SELECT c_custkey AS row_no, CASE WHEN c_custkey % 97 = 0 THEN 'other' ELSE '1001' END AS fsk,
  CASE WHEN c_custkey % 89 = 0 THEN '' WHEN c_custkey % 83 = 1 THEN concat('e-', cast(c_custkey - 1 AS string)) ELSE concat('e-', cast(c_custkey AS string)) END AS id,
  CASE WHEN c_custkey % 79 = 0 THEN '' ELSE concat('site-', lpad(cast(c_nationkey AS string), 2, '0')) END AS siteRef
FROM {customer}"""),
    "points_v": Operator("""
SELECT o_orderkey AS row_no, CASE WHEN o_orderkey % 97 = 0 THEN 'other' ELSE '1001' END AS fsk,
  CASE WHEN o_orderkey % 89 = 0 THEN '' WHEN o_orderkey % 83 = 1 THEN concat('p-', cast(o_orderkey - 1 AS string)) ELSE concat('p-', cast(o_orderkey AS string)) END AS id,
  CASE WHEN o_orderkey % 79 = 0 THEN '' ELSE concat('site-', lpad(cast(c_nationkey AS string), 2, '0')) END AS siteRef,
  CASE WHEN o_orderkey % 53 = 0 THEN '' WHEN o_orderkey % 61 = 0 THEN 'e-missing' WHEN o_orderkey % 67 = 0 THEN concat('e-', cast((o_custkey + 1) % 100 AS string))
       ELSE concat('e-', cast(o_custkey AS string)) END AS equipRef,
  CASE WHEN o_orderkey % 71 = 0 THEN 'maybe' WHEN o_orderstatus = 'F' THEN 'm:' WHEN o_orderstatus = 'O' THEN ' True ' ELSE '' END AS his
FROM {orders} o JOIN {customer} c ON o_custkey = c_custkey"""),
    "history_v": Operator("""
SELECT event_id AS row_no, concat('p-', cast(user_id AS string)) AS point_id, ts AS observed_at,
  CASE event_type WHEN 'click' THEN 'bool' WHEN 'view' THEN 'str' WHEN 'error' THEN 'na' ELSE 'num' END AS value_kind,
  CASE WHEN event_type = 'click' THEN value > 100 END AS val_bool, CASE WHEN event_type = 'view' THEN props END AS val_str,
  CASE WHEN event_type IN ('signup', 'purchase') THEN cast(value AS decimal(18,2)) END AS val_num
FROM {events}"""),
    "base_v": Operator("SELECT concat('p-', cast(user_id AS string)) AS point_id, ts AS observed_at, CASE WHEN event_id % 57 <> 38 THEN cast(value AS decimal(18,2)) END AS val_num FROM {events} WHERE event_id % 23 <> 5"),
    "resend_v": Operator("""
SELECT event_id AS row_no, concat('p-', cast(user_id AS string)) AS point_id, ts AS observed_at,
  CASE WHEN event_id % 38 <> 19 THEN cast(cast(value AS decimal(18,2)) + CASE WHEN event_id % 17 = 0 AND event_id % 3 = 0 THEN 1 ELSE 0 END AS decimal(18,2)) END AS val_num
FROM {events} WHERE event_id % 17 = 0 OR event_id % 19 = 0"""),
    # Samples as they are stored, by their whole typed value, and batches of them that are staged: new, sent again, corrected, and twice.
    "stored_v": Operator("""
SELECT event_id AS row_no, 't' AS tenant_id, '1001' AS project_id, concat('p-', cast(user_id AS string)) AS point_id, ts AS observed_at,
  CASE event_type WHEN 'click' THEN 'bool' WHEN 'view' THEN 'str' WHEN 'error' THEN 'na' ELSE 'num' END AS value_kind, CASE WHEN event_type = 'click' THEN value > 100 END AS val_bool, CASE WHEN event_type = 'view' THEN props END AS val_str,
  CASE WHEN event_type IN ('signup', 'purchase') THEN cast(value AS decimal(18,2)) END AS val_num, CASE WHEN event_type = 'error' THEN true END AS val_na,
  CASE WHEN event_id % 5 <> 0 THEN concat('t', cast(event_id AS string)) END AS source_timestamp, CASE WHEN event_id % 5 <> 0 THEN 'UTC' END AS source_timezone, CASE WHEN event_id % 7 = 0 THEN 'ok' END AS source_status
FROM {events} WHERE event_id % 23 <> 5"""),
    "staged_v": Operator("""
SELECT event_id + copy * 1000000000 AS row_no, concat('s-', cast(user_id % 4 AS string), '-', cast(cast(ts AS date) AS string)) AS batch_id, 't' AS tenant_id, CASE WHEN event_id % 38 = 0 THEN '1002' ELSE '1001' END AS project_id, concat('p-', cast(user_id AS string)) AS point_id, ts AS observed_at,
  CASE event_type WHEN 'click' THEN 'bool' WHEN 'view' THEN 'str' WHEN 'error' THEN 'na' ELSE 'num' END AS value_kind, CASE WHEN event_type = 'click' THEN value > 100 END AS val_bool, CASE WHEN event_type = 'view' THEN props END AS val_str,
  CASE WHEN event_type IN ('signup', 'purchase') THEN cast(cast(value AS decimal(18,2)) + CASE WHEN event_id % 34 = 0 THEN 1 ELSE 0 END AS decimal(18,2)) END AS val_num, CASE WHEN event_type = 'error' THEN true END AS val_na,
  CASE WHEN event_id % 5 <> 0 THEN concat('t', cast(event_id AS string)) END AS source_timestamp, CASE WHEN event_id % 5 <> 0 THEN 'UTC' END AS source_timezone, CASE WHEN copy = 2 THEN 'twice' WHEN event_id % 51 = 0 THEN 'corrected' WHEN event_id % 7 = 0 THEN 'ok' END AS source_status
FROM {events} e CROSS JOIN (SELECT 0 AS copy UNION ALL SELECT 1 UNION ALL SELECT 2) c WHERE (event_id % 17 = 0 OR event_id % 19 = 0) AND (copy = 0 OR (copy = 1 AND event_id % 1020 = 0) OR (copy = 2 AND event_id % 646 = 0))"""),
    "detections_v": Operator("""
SELECT concat('e-', cast(o_custkey AS string)) AS targetRef, concat('r-', cast(l_suppkey % 5 AS string)) AS ruleRef,
  cast(date_trunc('month', l_shipdate) AS date) AS rule_date, CASE l_linestatus WHEN 'F' THEN 'critical' ELSE 'warning' END AS severity, l_linenumber AS priority
FROM {lineitem} l JOIN {orders} o ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'"""),
    "samples_v": Operator("""
SELECT concat('p-', cast(l_orderkey AS string)) AS point_id, l_shipdate AS observed_at, cast(l_extendedprice AS decimal(18,2)) AS val_num, l_returnflag AS source_status FROM {lineitem}"""),
    "versions_v": Operator("SELECT cast(event_id AS string) AS version, ts AS certified_at FROM {events} WHERE event_type = 'signup'"),
    "dues_v": Operator("SELECT event_id AS due_id, ts AS due_at FROM {events} WHERE event_type = 'purchase'"),
    # Batches of a user's samples of one day; a few were split in two. Faults and states come from the day and the first event.
    "batch_seed_v": Operator("""
SELECT user_id AS u, d, k, concat('site-', lpad(cast(user_id % 25 AS string), 2, '0')) AS site_ref, cast(user_id % 25 AS int) AS site_no, concat('b-', cast(user_id AS string), '-', cast(d AS string)) AS batch_id, n,
  CASE WHEN d % 4 <> 0 AND k % 19 = 4 THEN 'split' WHEN d % 4 = 0 THEN 'certified' WHEN d % 4 = 1 AND k % 13 = 0 THEN 'quarantined' WHEN d % 4 = 3 AND d > 8 AND k % 17 = 3 THEN 'failed'
       WHEN k % 11 = 1 THEN 'planned' WHEN k % 11 = 2 THEN 'running' ELSE 'certified' END AS status
FROM (SELECT user_id, cast(extract(DAY FROM ts) AS int) - 1 AS d, min(event_id) AS k, count(*) AS n FROM {events} GROUP BY user_id, cast(extract(DAY FROM ts) AS int) - 1) x"""),
    "jobs_v": Operator("""
SELECT batch_id, concat('run-', cast(d AS string)) AS run_id, site_ref, site_no, d AS window_no, k, n, status, cast('2024-01-01 00:00:00' AS timestamp_ntz) + d * INTERVAL '1' DAY AS window_start,
  cast('2024-01-02 00:00:00' AS timestamp_ntz) + d * INTERVAL '1' DAY AS window_end FROM {batch_seed}
UNION ALL
SELECT concat(batch_id, '/', cast(half AS string)), concat('run-', cast(d AS string)), site_ref, site_no, d, k + half, n, CASE WHEN (k + half) % 5 = 1 THEN 'planned' ELSE 'certified' END,
  cast('2024-01-01 00:00:00' AS timestamp_ntz) + d * INTERVAL '1' DAY, cast('2024-01-02 00:00:00' AS timestamp_ntz) + d * INTERVAL '1' DAY
FROM {batch_seed} s CROSS JOIN (SELECT 0 AS half UNION ALL SELECT 1 AS half) h WHERE status = 'split'"""),
    "children_v": Operator("SELECT batch_id AS parent_id, concat(batch_id, '/', cast(half AS string)) AS child_id FROM {batch_seed} s CROSS JOIN (SELECT 0 AS half UNION ALL SELECT 1 AS half) h WHERE status = 'split'"),
    "certifications_v": Operator("SELECT batch_id, concat('a-', batch_id) AS artifact_id, concat('k-', batch_id) AS batch_key, window_end + INTERVAL '1' MINUTE AS certified_at FROM {jobs} WHERE status = 'certified' AND (window_no % 4 = 0 OR k % 29 <> 5)"),
    "artifacts_v": Operator("SELECT concat('a-', batch_id) AS artifact_id, concat('raw/', batch_id) AS raw_key, @sha[batch_id] AS raw_checksum FROM {jobs} WHERE status = 'certified' AND k % 31 <> 6"),
    "receipts_v": Operator("SELECT concat('k-', batch_id) AS batch_key, n AS row_count, @sha[concat(batch_id, ':', cast(n AS string))] AS checksum FROM {jobs} WHERE status = 'certified' AND k % 37 <> 7"),
    "new_receipts_v": Operator("SELECT concat('k-', batch_id) AS batch_key, CASE WHEN k % 7 = 0 THEN n + 1 ELSE n END AS row_count, @sha[concat(batch_id, ':', cast(n AS string))] AS checksum FROM {jobs} WHERE status = 'certified' AND k % 2 = 0"),
    "completions_v": Operator("""
SELECT run_id, site_ref, count(*) AS job_count, max(window_end) + INTERVAL '2' MINUTE AS completed_at FROM {jobs} WHERE window_no % 4 = 0 OR (window_no <> 5 AND (site_no + window_no) % 3 = 0) GROUP BY run_id, site_ref"""),
    "runs_v": Operator("""
SELECT run_id, CASE WHEN window_no % 6 = 5 THEN 'metadata' ELSE 'history' END AS feed, CASE WHEN window_no % 4 = 0 THEN 'certified' ELSE 'running' END AS status, window_end AS scheduled_at, window_start, window_end, window_no,
  CASE WHEN window_no % 10 = 9 THEN count(*) + 1 ELSE count(*) END AS expected_job_count
FROM (SELECT * FROM {jobs} WHERE batch_id NOT LIKE '%/%') j GROUP BY run_id, window_no, window_start, window_end"""),
    "attempts_v": Operator("""
SELECT batch_id, attempt_no, CASE WHEN attempt_no < 1 + k % 3 THEN 'retried' ELSE status END AS outcome, CASE WHEN attempt_no < 1 + k % 3 THEN CASE k % 4 WHEN 0 THEN 'timeout' WHEN 1 THEN 'too_large' END END AS error
FROM {jobs} j CROSS JOIN (SELECT 1 AS attempt_no UNION ALL SELECT 2 UNION ALL SELECT 3) t WHERE attempt_no <= 1 + k % 3 AND NOT (status = 'planned' AND k % 2 = 0)"""),
    "outbox_v": Operator("""
SELECT batch_id, CASE WHEN k % 9 = 0 THEN 'pending' ELSE 'sent' END AS state, window_end + INTERVAL '30' SECOND AS sent_at, window_end + INTERVAL '40' SECOND AS updated_at,
  CASE WHEN status = 'running' THEN window_end + INTERVAL '5' MINUTE END AS lease_expires_at, cast(k % 6 AS int) AS redrive_count, @sha[concat('certified-job:', batch_id)] AS publication_id FROM {jobs}"""),
    "cursors_v": Operator("""
SELECT site_ref, cast('2024-01-01 00:00:00' AS timestamp_ntz) AS baseline_at, CASE WHEN site_no % 7 = 4 THEN NULL ELSE cast('2024-01-01 00:00:00' AS timestamp_ntz) + (site_no % 30) * INTERVAL '1' DAY + (CASE WHEN site_no % 5 = 2 THEN 12 ELSE 0 END) * INTERVAL '1' HOUR END AS certified_through
FROM (SELECT DISTINCT site_ref, site_no FROM {jobs}) x WHERE site_no % 7 <> 3"""),
    # A plan of history batches, up to eight points of one day each, and the pages that a source gave for it.
    "plan_v": Operator("""
SELECT concat('h-', cast(g AS string), '-', cast(d AS string)) AS batch_id, '1001' AS project, concat('site-', lpad(cast(g % 25 AS string), 2, '0')) AS site_ref, cast((g * 31 + d) % 23 AS int) AS m, n,
  concat('2024-01-', lpad(cast(d + 1 AS string), 2, '0'), CASE (g * 31 + d) % 23 WHEN 21 THEN 'T06:00:00+06:00' WHEN 16 THEN 'T06:00:00Z' WHEN 17 THEN 'T00:00:00-06:00' ELSE 'T00:00:00+00:00' END) AS window_start,
  concat('2024-01-', lpad(cast(d + 1 AS string), 2, '0'), CASE (g * 31 + d) % 23 WHEN 21 THEN 'T18:59:59-05:00' ELSE 'T23:59:59+00:00' END) AS window_end, ids AS scope
FROM (SELECT g, d, cast(sum(n) AS bigint) AS n, @list[concat('p-', cast(user_id AS string))|user_id] AS ids
  FROM (SELECT cast(floor(user_id / 8) AS bigint) AS g, cast(extract(DAY FROM ts) AS int) - 1 AS d, user_id, count(*) AS n FROM {events} GROUP BY user_id, cast(extract(DAY FROM ts) AS int) - 1) x GROUP BY g, d) y"""),
    "receipt_v": Operator("""
SELECT batch_id, CASE m WHEN 0 THEN 'timed out' END AS err, m <> 1 AS complete, m = 2 AS truncated, CASE m WHEN 3 THEN '9' ELSE project END AS project, CASE m WHEN 4 THEN 'site-99' ELSE site_ref END AS site_ref,
  CASE m WHEN 10 THEN '' ELSE concat('q-', batch_id) END AS query_id, CASE m WHEN 5 THEN window_end ELSE window_start END AS window_start, window_end, CASE m WHEN 6 THEN concat('p-extra,', scope) ELSE scope END AS requested,
  CASE m WHEN 7 THEN 'p-other' WHEN 6 THEN concat('p-extra,', scope) ELSE scope END AS completed, CASE m WHEN 8 THEN n + 1 ELSE n END AS returned_rows, CASE m WHEN 9 THEN n - 1 ELSE n END AS total_rows, n AS actual_rows,
  CASE m WHEN 2 THEN 'project,truncatedAt' WHEN 3 THEN 'rowLIMIT,site' WHEN 0 THEN 'err,project' ELSE 'project,site' END AS meta_keys
FROM {plan} WHERE m <> 11"""),
    "grid_columns_v": Operator("""
SELECT batch_id, 'ts' AS name, cast(NULL AS string) AS point_id FROM {plan} WHERE m <> 17
UNION ALL SELECT batch_id, 'ts', cast(NULL AS string) FROM {plan} WHERE m = 12
UNION ALL SELECT batch_id, CASE WHEN m = 13 THEN 'v' ELSE concat('v', p) END, CASE WHEN m = 15 THEN 'p-same' ELSE p END
  FROM (SELECT DISTINCT l.batch_id, l.m, h.point_id AS p FROM {plan} l JOIN {plan_rows} h ON l.batch_id = h.batch_id) x WHERE NOT (m = 14 AND p LIKE '%1')
UNION ALL SELECT batch_id, 'vx', 'p-unexpected' FROM {plan} WHERE m = 16"""),
    "plan_rows_v": Operator("""
SELECT concat('h-', cast(cast(floor(user_id / 8) AS bigint) AS string), '-', cast(cast(extract(DAY FROM ts) AS int) - 1 AS string)) AS batch_id, event_id AS row_no, concat('p-', cast(user_id AS string)) AS point_id, ts AS observed_at, event_type AS value_kind FROM {events}"""),
    "landed_rows_v": Operator("""
SELECT r.batch_id, r.row_no, CASE WHEN m = 19 AND row_no % 3 = 0 THEN 'p-stray' ELSE r.point_id END AS point_id, CASE WHEN m = 18 AND row_no % 2 = 0 THEN r.observed_at + INTERVAL '1' DAY ELSE r.observed_at END AS observed_at, CASE WHEN m IN (10, 11, 15) AND row_no % 3 = 0 THEN NULL ELSE r.value_kind END AS value_kind
FROM {plan_rows} r JOIN {plan} l ON r.batch_id = l.batch_id
UNION ALL SELECT r.batch_id, r.row_no + 1000000000, r.point_id, r.observed_at, r.value_kind FROM {plan_rows} r JOIN {plan} l ON r.batch_id = l.batch_id WHERE m = 20 AND row_no % 5 = 0"""),
    # Pages of entities by site: 20 rows each; every fault of a chain on some sites.
    "chain_v": Operator("""
SELECT site_ref, kind, page, CASE WHEN m = 1 AND page > 0 THEN 'snap-late' WHEN m = 2 AND kind = 'points' THEN 'snap-other' ELSE concat('snap-', site_ref) END AS snapshot, CASE WHEN m = 3 AND page > 0 THEN page + 1 ELSE page END AS page_index,
  CASE WHEN m = 4 AND page = 0 THEN n + 1 ELSE n END AS returned_rows, n AS actual_rows, CASE WHEN m = 5 THEN total - 1 ELSE total END AS total_rows, CASE WHEN m = 6 THEN true WHEN m = 7 THEN false ELSE page = last END AS complete,
  CASE WHEN page < last OR m = 8 THEN CASE WHEN m = 9 THEN 'again' ELSE concat('t', cast(page + 1 AS string)) END END AS next_page, CASE WHEN m = 10 AND page = last THEN 'failed' END AS err
FROM (SELECT site_ref, kind, page, n, cast(sum(n) OVER (PARTITION BY site_ref, kind) AS bigint) AS total, max(page) OVER (PARTITION BY site_ref, kind) AS last, cast(cast(substring(site_ref, 6) AS int) % 12 AS int) AS m FROM (
  SELECT site_ref, kind, page, count(*) AS n FROM (
    SELECT concat('site-', lpad(cast(c_nationkey AS string), 2, '0')) AS site_ref, 'equipment' AS kind, cast(floor((row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) / 20) AS bigint) AS page FROM {customer}
    UNION ALL SELECT concat('site-', lpad(cast(c_nationkey AS string), 2, '0')), 'points', cast(floor((row_number() OVER (PARTITION BY c_nationkey ORDER BY o_orderkey) - 1) / 200) AS bigint) FROM {orders} o JOIN {customer} c ON o_custkey = c_custkey) r
  GROUP BY site_ref, kind, page) g) h"""),
    # Days of rule detections by equipment group.
    "rule_plan_v": Operator("""
SELECT concat('d-', cast(g AS string), '-', cast(day AS string)) AS batch_id, '1001' AS project, cast(g AS string) AS site_ref, day, 'UTC' AS timezone, cast((g * 7 + extract(MONTH FROM day)) % 19 AS int) AS m, n, scope, size
FROM (SELECT g, day, sum(c) AS n, @list[id|k] AS scope, count(*) AS size FROM (
  SELECT cast(floor(o_custkey / 200) AS bigint) AS g, cast(date_trunc('month', l_shipdate) AS date) AS day, o_custkey AS k, concat('e-', cast(o_custkey AS string)) AS id, count(*) AS c
  FROM {lineitem} l JOIN {orders} o ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' GROUP BY o_custkey, cast(date_trunc('month', l_shipdate) AS date)) x GROUP BY g, day) y"""),
    "rule_receipt_v": Operator("""
SELECT batch_id, CASE m WHEN 0 THEN 'x' END AS err, m <> 1 AS complete, m = 2 AS truncated, CASE m WHEN 3 THEN '9' ELSE project END AS project, site_ref, CASE m WHEN 4 THEN day + INTERVAL '1' DAY ELSE cast(day AS timestamp_ntz) END AS day, CASE m WHEN 5 THEN 'Chicago' ELSE timezone END AS timezone,
  concat('q', batch_id) AS query_id, CASE m WHEN 6 THEN 'e-x' ELSE scope END AS requested, CASE m WHEN 7 THEN 'e-y' WHEN 6 THEN 'e-x' ELSE scope END AS completed, CASE m WHEN 8 THEN size + 1 ELSE size END AS requested_count, CASE m WHEN 9 THEN n + 1 ELSE n END AS returned_rows, n AS total_rows, n AS actual_rows,
  CASE m WHEN 10 THEN 1 ELSE 0 END AS page_index, CASE m WHEN 11 THEN 't1' END AS next_page, CASE m WHEN 12 THEN 'ts,date,date' ELSE 'ts,date,targetRef' END AS columns
FROM {rule_plan} WHERE m <> 13"""),
    "found_v": Operator("""
SELECT concat('d-', cast(cast(floor(o_custkey / 200) AS bigint) AS string), '-', cast(cast(date_trunc('month', l_shipdate) AS date) AS string)) AS batch_id, CASE WHEN l_partkey % 67 = 5 THEN 'e-stray' ELSE concat('e-', cast(o_custkey AS string)) END AS equipment_id, concat('r-', cast(l_suppkey % 5 AS string)) AS rule_id,
  CASE WHEN l_partkey % 97 = 1 THEN 'other' WHEN l_partkey % 3 = 0 THEN NULL ELSE '1001' END AS project, cast(date_trunc('month', l_shipdate) AS date) + (CASE WHEN l_partkey % 101 = 2 THEN 1 ELSE 0 END) * INTERVAL '1' DAY AS found_day,
  CASE WHEN l_partkey % 89 = 3 THEN 'Mars' ELSE 'UTC' END AS tz, CASE WHEN l_partkey % 83 <> 4 THEN l_linenumber END AS spark
FROM {lineitem} l JOIN {orders} o ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'"""),
    # What sinks are handed: samples, entities and detections whose hashes and batch keys are computed from them, then changed here and there (``tamper``).
    "carried_v": Operator("""
SELECT r.batch_id, r.row_no, r.point_id, r.observed_at, r.value_kind, CASE WHEN r.value_kind = 'view' THEN cast(r.row_no AS string) END AS val_str, CASE WHEN l.m = 21 AND r.row_no % 2 = 0 THEN 'row_hash' WHEN l.m = 22 THEN 'batch_key' ELSE '' END AS tamper
FROM {landed_rows_v} r JOIN {plan} l ON r.batch_id = l.batch_id"""),
    "handed_v": Operator("""
SELECT site_ref AS batch_id, kind, source_id, CASE WHEN m = 1 AND n % 5 = 0 THEN 'site-99' ELSE site_ref END AS site_ref, equipment_ref, CASE WHEN m = 2 AND kind = 'equipment' THEN true ELSE historized END AS historized, CASE WHEN kind = 'point' THEN equipment_ref IS NULL END AS site_level,
  CASE WHEN m = 3 AND n % 5 = 1 THEN 'n-x' ELSE source_id END AS tag_id, payload, CASE WHEN m = 5 AND n % 3 = 0 THEN 'row_hash' WHEN m = 6 THEN 'batch_key' ELSE '' END AS tamper
FROM (SELECT *, try_cast(substring(source_id, 3) AS bigint) AS n, try_cast(substring(site_ref, 6) AS int) % 8 AS m FROM {harvest_v}) h CROSS JOIN (SELECT 0 AS copy UNION ALL SELECT 1) c WHERE copy = 0 OR (m = 4 AND n % 5 = 2)"""),
    "judged_v": Operator("""
SELECT DISTINCT p.batch_id, CASE WHEN p.m = 14 THEN 'e-stray' ELSE f.equipment_id END AS equipment_id, f.rule_id, f.severity, f.spark, p.day + (CASE WHEN p.m = 15 THEN 1 ELSE 0 END) * INTERVAL '1' DAY AS found_day, CASE p.m WHEN 16 THEN 'key' WHEN 17 THEN 'revision_hash' WHEN 18 THEN 'batch_key' ELSE '' END AS tamper
FROM (SELECT targetRef AS equipment_id, ruleRef AS rule_id, rule_date, min(severity) AS severity, min(priority) AS spark FROM {detections} GROUP BY targetRef, ruleRef, rule_date) f
JOIN {rule_plan} p ON p.day = f.rule_date AND p.site_ref = cast(cast(floor(cast(substring(f.equipment_id, 3) AS bigint) / 200) AS bigint) AS string)"""),
    # Batches with what they must complete and where to, and what was completed.
    "commissioned_v": Operator("""
SELECT batch_id, 'history' AS feed, site_ref, scope, 'table' AS target, m FROM {plan}
UNION ALL SELECT concat('md-', run_id, '-', site_ref), 'metadata', site_ref, '', 'files', cast(window_no % 7 AS int) FROM {jobs} WHERE batch_id NOT LIKE '%/%' GROUP BY run_id, site_ref, window_no"""),
    "completed_v": Operator("""
SELECT batch_id, CASE WHEN m = 1 THEN concat(own, ',', own) WHEN m = 2 THEN concat(own, ',p-extra') WHEN m = 4 THEN 'p-other' ELSE own END AS ids, CASE WHEN m = 3 THEN 'elsewhere' ELSE target END AS target
FROM (SELECT batch_id, target, m, CASE feed WHEN 'metadata' THEN site_ref ELSE scope END AS own FROM {commissioned_v}) c WHERE m <> 0"""),
    # Inventory versions and the metadata runs that they are from.
    "registered_v": Operator("SELECT cast(event_id AS string) AS version, concat('meta-', cast(event_id AS string)) AS run_id, ts AS certified_at FROM {events} WHERE event_type = 'signup'"),
    "meta_runs_v": Operator("SELECT concat('meta-', cast(event_id AS string)) AS run_id, CASE WHEN event_id % 13 = 6 THEN 'rules' ELSE 'metadata' END AS feed, CASE WHEN event_id % 9 = 0 THEN 'running' ELSE 'certified' END AS status, ts - INTERVAL '2' HOUR AS scheduled_at FROM {events} WHERE event_type = 'signup'"),
    "meta_jobs_v": Operator("""
SELECT concat('meta-', cast(event_id AS string)) AS run_id, concat('meta-', cast(event_id AS string), '-', s) AS batch_id, concat('site-', s) AS site_ref, CASE WHEN s = 'b' AND event_id % 14 = 3 THEN 'planned' ELSE 'certified' END AS status, event_id AS k
FROM {events} e CROSS JOIN (SELECT 'a' AS s UNION ALL SELECT 'b') x WHERE event_type = 'signup'"""),
    "meta_certs_v": Operator("SELECT batch_id FROM {meta_jobs_v} WHERE status = 'certified' AND NOT (site_ref = 'site-b' AND k % 16 = 5)"),
    "meta_done_v": Operator("""
SELECT j.run_id, j.site_ref, r.certified_at + (CASE WHEN site_ref = 'site-b' AND k % 26 = 9 THEN 60 ELSE -5 END) * INTERVAL '1' MINUTE AS completed_at FROM {meta_jobs_v} j JOIN {registered_v} r ON r.run_id = j.run_id WHERE NOT (site_ref = 'site-b' AND k % 22 = 7)"""),
    # The texts of tagged values, one of each kind in turn.
    "inventory_rows_v": Operator("SELECT siteRef, CASE WHEN row_no % 2 = 1 THEN '1001' ELSE fsk END AS fsk FROM {points} WHERE siteRef NOT IN ('', 'site-07')"),
    "named_points_v": Operator("SELECT row_no, fsk, id, siteRef, equipRef, his, CASE WHEN id <> '' THEN id END AS navName, CASE WHEN row_no % 2 = 0 THEN concat('Point ', id) END AS dis FROM {points}"),
    "source_detections_v": Operator("""
SELECT concat('r:e-', cast(o_custkey AS string), ' An Equipment') AS targetRef, concat('r-', cast(l_suppkey % 5 AS string)) AS ruleRef, cast(cast(l_shipdate AS date) AS string) AS date, 'UTC' AS tz, l_linenumber AS spark, cast(l_partkey % 90 AS int) AS dur, '10:00,15min' AS periods,
  CASE l_partkey % 4 WHEN 0 THEN '["p-1","r:p-2 Two"]' WHEN 1 THEN '"p-3"' WHEN 2 THEN 'null' ELSE '["p-1","p-1"]' END AS points, l_returnflag AS severity FROM {lineitem} l JOIN {orders} o ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'"""),
    "tagged_v": Operator("""
SELECT event_id AS row_no, CASE event_id % 16 WHEN 0 THEN concat('n:', cast(user_id AS string), ' kW') WHEN 1 THEN 'm:' WHEN 2 THEN 'z:' WHEN 3 THEN concat('r:', 'p.', cast(user_id AS string), ' A Name') WHEN 4 THEN 'a:b' WHEN 5 THEN NULL WHEN 6 THEN '' WHEN 7 THEN concat('@p', cast(user_id AS string))
  WHEN 8 THEN 'bad id!' WHEN 9 THEN ' True ' WHEN 10 THEN 'false' WHEN 11 THEN 'maybe' WHEN 12 THEN concat(' @p', cast(user_id AS string), ' ') WHEN 13 THEN concat('m:', cast(user_id AS string)) WHEN 14 THEN concat('p-', cast(user_id AS string), ' x') ELSE concat('d:2024-01-0', cast(1 + user_id % 9 AS string)) END AS v FROM {events}"""),
    "json_v": Operator("""
SELECT event_id AS row_no, CASE event_id % 16 WHEN 0 THEN 'true' WHEN 1 THEN cast(user_id AS string) WHEN 2 THEN concat('"s', cast(user_id AS string), '"') WHEN 3 THEN '{"_kind":"na"}' WHEN 4 THEN concat('{"value":', cast(user_id AS string), ',"status":"ok"}') WHEN 5 THEN '{"value":1,"status":""}'
  WHEN 6 THEN concat('{"_kind":"number","val":', cast(user_id AS string), ',"unit":"kW"}') WHEN 7 THEN '{"_kind":"number","val":"INF"}' WHEN 8 THEN '{"_kind":"marker"}' WHEN 9 THEN '{"_kind":"ref","val":"p-1","dis":"P"}' WHEN 10 THEN 'null' WHEN 11 THEN '{"_kind":"dateTime","tz":"UTC"}'
  WHEN 12 THEN '{"_kind":"dateTime","val":"2024-01-01T00:00:00Z"}' WHEN 13 THEN '"m:abc"' WHEN 14 THEN '{"_kind":"coord","lat":1}' ELSE '[1,2]' END AS j FROM {events}"""),
    "marks_v": Operator("""
SELECT event_id AS row_no, CASE event_id % 17 WHEN 0 THEN '"p-1 x"' WHEN 1 THEN '"bad id!"' WHEN 2 THEN concat('"r:p-', cast(user_id AS string), ' A Name"') WHEN 3 THEN concat('{"_kind":"ref","val":"p-', cast(user_id AS string), '","dis":"Four"}') WHEN 4 THEN '{"_kind":"marker"}' WHEN 5 THEN '{"_kind":"ref","val":"bad id"}' WHEN 6 THEN 'true'
  WHEN 7 THEN 'false' WHEN 8 THEN 'null' WHEN 9 THEN '"m:"' WHEN 10 THEN '"true"' WHEN 11 THEN '""' WHEN 12 THEN '5' WHEN 13 THEN '{"_kind":"ref"}' WHEN 14 THEN '"false"' WHEN 15 THEN '{"_kind":"uri","val":"p-1"}' ELSE '{"_kind":"ref","val":"r:p-9 Nine"}' END AS j FROM {events}"""),
    "stamps_v": Operator("""
SELECT event_id AS row_no, concat('2024-01-', lpad(cast(1 + user_id % 28 AS string), 2, '0'), CASE event_id % 6 WHEN 0 THEN 'T10:30:00Z' WHEN 1 THEN 'T10:30:00+02:00' WHEN 2 THEN 'T10:30:00-0530' WHEN 3 THEN 'T10:30:00' WHEN 4 THEN 'T99:30:00Z' ELSE ' nonsense' END) AS stamp FROM {events}"""),
    "ref_lists_v": Operator("""
SELECT event_id AS row_no, CASE event_id % 12 WHEN 0 THEN '["r:a A","b"]' WHEN 1 THEN '["a","r:a Again"]' WHEN 2 THEN '"r:p-7 Seven"' WHEN 3 THEN '[]' WHEN 4 THEN 'null' WHEN 5 THEN '{"x":1}' WHEN 6 THEN '[{"_kind":"ref","val":"p-1","dis":"One"},"r:p-2 Two"]' WHEN 7 THEN '[{"_kind":"marker"}]' WHEN 8 THEN '"bad id!"'
  WHEN 9 THEN '"r:bad! x"' WHEN 10 THEN '[{"_kind":"ref","val":"p-1"},"p-1"]' ELSE '""' END AS j FROM {events}"""),
    "entity_rows_v": Operator("""
SELECT 'equipment' AS kind, id AS source_id, siteRef AS site_ref, CASE WHEN row_no % 41 = 2 THEN 'e-1' END AS parent_id, row_no % 43 = 3 AS historized, CASE WHEN row_no % 47 = 5 THEN true END AS site_level, CASE WHEN row_no % 43 = 3 THEN 'm:' ELSE '' END AS his FROM {c} WHERE outcome = 'accepted'
UNION ALL SELECT 'point', id, siteRef, CASE WHEN trim(equipRef) <> '' THEN equipRef END, CASE WHEN row_no % 59 = 7 THEN NOT historized ELSE historized END, CASE WHEN row_no % 73 = 9 THEN trim(equipRef) <> '' ELSE trim(equipRef) = '' END, CASE WHEN historized THEN 'm:' ELSE '' END FROM {classified} WHERE outcome = 'accepted'"""),
    "site_entities_v": Operator("""
SELECT * FROM {entity_rows_v} WHERE NOT (site_ref IN ('site-00', 'site-12') AND ((kind = 'equipment' AND (parent_id IS NOT NULL OR historized OR site_level IS NOT NULL)) OR (kind = 'point' AND (site_level <> (parent_id IS NULL) OR historized <> (his = 'm:')))))"""),
    "pins_v": Operator("SELECT event_id AS due_id, CASE WHEN event_id % 3 = 0 THEN '-1' ELSE cast(event_id - 5 AS string) END AS version FROM {events} WHERE event_type = 'purchase' AND event_id % 40 < 3"),
    "requests_v": Operator("""
SELECT event_id AS request_id, ts AS requested_at, cast(cast(ts AS date) AS timestamp_ntz) - (event_id % 20) * INTERVAL '1' DAY AS window_start, cast(cast(ts AS date) AS timestamp_ntz) - (event_id % 20) * INTERVAL '1' DAY + (CASE WHEN event_id % 13 = 1 THEN 23 ELSE 24 END) * INTERVAL '1' HOUR AS window_end,
  CASE WHEN event_id % 4 = 0 THEN 'rules' ELSE 'history' END AS feed, CASE WHEN event_id % 11 = 5 THEN 'inv-other' ELSE 'inv-1' END AS inventory, cast(event_id % 70 AS int) AS jobs, concat('g-', cast(event_id % 50 AS string)) AS approval_ref FROM {events} WHERE event_type = 'purchase'"""),
    "approvals_v": Operator("""
SELECT concat('g-', cast(g AS string)) AS approval_ref, CASE WHEN g % 5 = 0 THEN 'inv-9' ELSE 'inv-1' END AS inventory, cast('2023-12-20 00:00:00' AS timestamp_ntz) + (g % 9) * INTERVAL '1' DAY AS grant_start, cast('2024-01-20 00:00:00' AS timestamp_ntz) + (g % 11) * INTERVAL '1' DAY AS grant_end,
  10 + cast(g AS int) AS max_jobs, cast('2024-01-10 00:00:00' AS timestamp_ntz) + g * INTERVAL '1' DAY AS expires_at FROM (SELECT DISTINCT event_id % 50 AS g FROM {events} WHERE event_id % 50 <> 7) x"""),
    "real_equipment_v": Operator("SELECT site_ref, source_id AS id FROM {entities}"),
    "real_points_v": Operator("SELECT siteRef AS site_ref, id, equipRef FROM {classified} WHERE outcome = 'accepted' AND historized"),
    "exclusions_v": Operator("SELECT source_id, site_ref FROM {entities} WHERE row_no % 50 = 0 UNION ALL SELECT concat('gone-', source_id), site_ref FROM {entities} WHERE row_no % 400 = 7"),
    "stored_revisions_v": Operator("SELECT targetRef AS equipment_id, ruleRef AS rule_id, rule_date AS source_date, concat('site-', cast(cast(substring(targetRef, 3) AS int) % 25 AS string)) AS site_ref, CASE WHEN priority = 2 THEN 'UTC' ELSE 'America/Chicago' END AS zone, severity, priority FROM {detections} WHERE priority <= 4"),
    "staged_revisions_v": Operator("SELECT targetRef AS equipment_id, ruleRef AS rule_id, rule_date AS source_date, concat('site-', cast(cast(substring(targetRef, 3) AS int) % 25 AS string)) AS site_ref, CASE WHEN priority = 5 THEN 'UTC' ELSE 'America/Chicago' END AS zone, severity, CASE WHEN priority = 6 THEN NULL ELSE priority END AS priority FROM {detections} WHERE priority >= 3"),
    "lineage_status_v": Operator("SELECT p_partkey AS id, CASE WHEN cast(floor(p_partkey / 256) AS bigint) % 3 <> 0 AND p_size % 7 = 0 THEN 'planned' ELSE 'certified' END AS status FROM {part}"),
    "lineage_v": Operator("""
SELECT cast(p_partkey - k + floor((k - 1) / 2) AS bigint) AS parent_id, p_partkey AS child_id FROM (SELECT p_partkey, p_partkey % 256 AS k FROM {part}) p WHERE k > 0"""),
    "entities_v": Operator("SELECT id AS source_id, siteRef AS site_ref, cast(row_no AS bigint) AS row_no, CASE WHEN row_no % 23 <> 6 THEN concat('v', cast(row_no % 13 AS string)) END AS payload FROM {c} WHERE outcome = 'accepted'"),
    "prior_v": Operator("SELECT source_id, site_ref, row_no, CASE WHEN row_no % 7 = 0 THEN 'old' WHEN row_no % 29 = 8 THEN NULL ELSE payload END AS payload FROM {entities} WHERE row_no % 10 <> 3 UNION ALL SELECT concat('gone-', source_id), site_ref, row_no, payload FROM {entities} WHERE row_no % 101 = 9"),
    # What three metadata runs found, equipment and points with ids alike, and what is published.
    "harvests_v": Operator("""
SELECT run_id, scheduled_at, kind, concat('n-', substring(id, 3)) AS source_id, siteRef AS site_ref, equipment_ref, historized, CASE WHEN row_no % 23 <> 6 THEN concat('v', cast(row_no % 13 AS string)) END AS payload
FROM (SELECT 'equipment' AS kind, id, siteRef, cast(NULL AS string) AS equipment_ref, false AS historized, row_no FROM {c} WHERE outcome = 'accepted'
      UNION ALL SELECT 'point', id, siteRef, nullif(trim(equipRef), ''), historized, row_no FROM {classified} WHERE outcome = 'accepted') e
CROSS JOIN (SELECT 'm-1' AS run_id, cast('2024-01-08 03:00:00' AS timestamp_ntz) AS scheduled_at UNION ALL SELECT 'm-2', cast('2024-01-15 03:00:00' AS timestamp_ntz) UNION ALL SELECT 'm-3', cast('2023-12-20 03:00:00' AS timestamp_ntz)) r
WHERE run_id <> 'm-2' OR row_no % 31 <> 4"""),
    "harvest_v": Operator("SELECT kind, source_id, site_ref, equipment_ref, historized, payload FROM {harvests_v} WHERE run_id = 'm-1'"),
    "part_v": Operator("SELECT kind, source_id, site_ref, equipment_ref, historized, payload FROM {harvests_v} WHERE run_id = 'm-2'"),
    "published_v": Operator("""
SELECT kind, source_id, site_ref, equipment_ref, historized, CASE WHEN n % 7 = 0 THEN 'old' WHEN n % 29 = 8 THEN NULL ELSE payload END AS payload, concat('run-', cast(n % 5 AS string)) AS last_seen
FROM (SELECT *, try_cast(substring(source_id, 3) AS bigint) AS n FROM {harvest_v}) h WHERE n % 10 <> 3 AND NOT (kind = 'point' AND n % 41 = 2)"""),
    "publications_v": Operator("SELECT concat('m-0', cast(n_nationkey AS string)) AS run_id, cast('2023-12-01 03:00:00' AS timestamp_ntz) + n_nationkey * INTERVAL '1' DAY AS scheduled_at FROM {nation}"),
    "linked_v": Operator("""
SELECT 'equipment' AS kind, id AS source_id, siteRef AS site_ref, cast(NULL AS string) AS parent_id FROM {equipment} WHERE id <> ''
UNION ALL SELECT 'point', id, siteRef, CASE WHEN equipRef <> '' THEN equipRef END FROM {points} WHERE id <> ''"""),
    "grid_dues_v": Operator("SELECT due_id, CASE WHEN due_id % 3 = 0 THEN @floor5[due_at] ELSE due_at END AS due_at FROM {dues}"),
    "split_seed_v": Operator("""
SELECT concat('s', cast(cast(floor(l_orderkey / 64) AS bigint) AS string)) AS batch_id, cast('1992-01-01 00:00:00' AS timestamp_ntz) AS window_start, cast('1999-01-01 00:00:00' AS timestamp_ntz) AS window_end, concat('p-', cast(l_orderkey AS string)) AS id, l_shipdate AS seen_at FROM {lineitem}"""),
    "asked_v": Operator("SELECT CASE WHEN virtual_point LIKE '%7' THEN 'site-99' ELSE site_ref END AS site_ref, virtual_point FROM {virtual_points}"),
    "windows12_v": Operator("SELECT DISTINCT cast(event_id % 12 AS int) AS window_no FROM {events}"),
}
