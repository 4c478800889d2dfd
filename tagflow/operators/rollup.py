"""Aggregations, analytic functions, order and limit."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagflow.sqlops import Operator, operator

_c = F.col

value_kind_counts = Operator("SELECT value_kind, count(*) AS n FROM {history} GROUP BY value_kind", "Samples by kind of value.")


@operator
def latest_observation(history):
    """The last sample of each point; the last row wins ties. Combined where the rows are, then by point."""
    last = F.max_by(F.struct("observed_at", "value_kind", "row_no"), F.struct("observed_at", "row_no"))
    return history.groupBy("point_id").agg(last.alias("x")).select("point_id", "x.*")


@operator
def observations_by_point(history):
    """A point's samples of a day in order of time, as JSON; a day bounds the list."""
    own = history.groupBy("point_id", F.to_date("observed_at").alias("day")).agg(F.count("*").alias("samples"), F.array_sort(F.collect_list(F.struct("observed_at", "row_no", "value_kind"))).alias("rows"))
    ordered = F.transform("rows", lambda r: F.struct(r.row_no.alias("row"), r.value_kind.alias("kind")))
    return own.select("point_id", "day", "samples", F.to_json(ordered).alias("ordered"))


@operator
def batch_checksum(rows, max_rows=100_000):
    """Row count and order-defined checksum by batch. A batch over ``max_rows`` has no checksum and is not ok.

    The hashes of rows are listed, not the rows, and only for batches within the cap.
    """
    h = rows.select("batch_id", F.sha2(F.concat_ws("=", "row_no", "point_id", F.date_format("observed_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")), 256).alias("h"))
    sizes = h.groupBy("batch_id").agg(F.count("*").alias("n"))
    sums = h.join(sizes.where(_c("n") <= max_rows).select("batch_id"), "batch_id", "left_semi").groupBy("batch_id").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), "\n"), 256).alias("checksum"))
    return sizes.join(sums, "batch_id", "left").select("batch_id", "n", "checksum", (_c("n") <= max_rows).alias("ok"))


@operator
def site_inventory(entities, exclusions):
    """Sorted ids by site without the excluded ones; an exclusion of an unknown id refuses its site.

    A site's ids are one list, as its inventory is; ``assign_batches`` cuts them into bounded ones.
    """
    known = entities.select("site_ref", "source_id").distinct()
    unknown = exclusions.select("site_ref", "source_id").distinct().join(known, ["site_ref", "source_id"], "left_anti").groupBy("site_ref").agg(F.count("*").alias("unknown"))
    kept = known.join(exclusions.select("site_ref", "source_id"), ["site_ref", "source_id"], "left_anti")
    lists = kept.groupBy("site_ref").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("source_id")).alias("ids"))
    return lists.join(unknown, "site_ref", "left").select("site_ref", "n", "ids", F.coalesce("unknown", F.lit(0)).alias("unknown_exclusions"), _c("unknown").isNull().alias("ok"))


@operator
def inventory_version(inventory):
    """Content hash: first by site, then over the sites' hashes in order."""
    sites = inventory.select("site_ref", F.sha2(F.array_join("ids", "\n"), 256).alias("h"))
    return sites.agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "site_ref", "h"))), "\n"), 256).alias("version"))


job_status_counts = Operator("SELECT run_id, status, count(*) AS n FROM {jobs} GROUP BY run_id, status", "Batches by run and status.")
attempt_outcomes = Operator("SELECT attempt_no, outcome, coalesce(error, 'none') AS error, count(*) AS n FROM {attempts} GROUP BY attempt_no, outcome, coalesce(error, 'none')", "Attempts by number, outcome and error.")
window_summary = Operator(
    "SELECT @floor5[observed_at] AS window_start, count(*) AS samples, count(DISTINCT point_id) AS points, count(*) FILTER (WHERE value_kind = 'na') AS na FROM {history} GROUP BY @floor5[observed_at]", "Totals by five-minute window."
)
plan_summary = Operator(
    """
SELECT feed, cast(sum(ids) AS bigint) AS ids, cast(sum(ceil(ids / each)) AS bigint) AS batches, count(*) AS sites FROM (
  SELECT 'history' AS feed, siteRef, count(*) FILTER (WHERE historized) AS ids, $history AS each FROM {points} WHERE outcome = 'accepted' GROUP BY siteRef
  UNION ALL SELECT 'rules', siteRef, count(*), $rules FROM {equipment} WHERE outcome = 'accepted' GROUP BY siteRef
  UNION ALL SELECT 'metadata', siteRef, count(*), 1000000000 FROM {equipment} WHERE outcome = 'accepted' GROUP BY siteRef) x GROUP BY feed""",
    "Batches that each feed's ids need, site by site.",
    history=50,
    rules=20,
)


@operator
def grid_profile(plan, pages, columns, rows, markers=("trunc", "limit")):
    """What each batch's grid holds: rows, columns, points matched, missing, unexpected and twice, cells, bytes, and whether a key tells of a cut."""
    own = columns.where("name <> 'ts'").withColumn("point", F.coalesce("point_id", "name"))
    cols = own.groupBy("batch_id").agg(F.count("*").alias("point_columns"), F.collect_set("point").alias("own"))
    cells = rows.groupBy("batch_id").agg(F.count_distinct("observed_at").alias("n_rows"), F.count_if(_c("value_kind") != "error").alias("value_cells"), F.sum(F.octet_length("value_kind") + 26).alias("bytes"))
    df = plan.select("batch_id", "scope").join(pages.select("batch_id", F.lower("meta_keys").alias("keys")), "batch_id").join(cols, "batch_id", "left").join(cells, "batch_id", "left")
    told = F.lit(False)
    for m in markers:
        told = told | _c("keys").contains(m)
    have = F.coalesce("own", F.array().cast("array<string>"))
    return df.select(
        "batch_id", "n_rows", "point_columns", F.size(F.array_intersect("scope", have)).cast("long").alias("matched"), F.size(F.array_except("scope", have)).cast("long").alias("missing"), F.size(F.array_except(have, "scope")).cast("long").alias("unexpected"),
        (_c("point_columns") - F.size(have)).alias("duplicates"), "value_cells", "bytes", told.alias("cut"),
    )


def chunks(df: DataFrame, site: str, key: str, size: int) -> DataFrame:
    """``df`` with ``batch_no``: ``key``'s rank in ``site`` in chunks of ``size``."""
    at = F.row_number().over(Window.partitionBy(site).orderBy(key)) - 1
    return df.withColumn("batch_no", F.floor(at / size).cast("long"))


@operator
def assign_batches(sites, points, max_ids=50):
    """Sorted ids of a site in chunks; a site without ids has one empty batch, and no batch crosses sites."""
    own = chunks(points.where("outcome = 'accepted'").select("siteRef", "id"), "siteRef", "id", max_ids)
    lists = own.groupBy("siteRef", "batch_no").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return sites.join(lists, sites.site_ref == lists.siteRef, "left").select("site_ref", F.coalesce("batch_no", F.lit(0)).cast("long").alias("batch_no"), F.size(ids).cast("long").alias("n"), ids.alias("ids"))


@operator
def first_occurrence(points):
    """The first row of each id."""
    return points.where("trim(id) <> ''").groupBy("id").agg(F.min("row_no").alias("row_no"))


zero_based_index = Operator("SELECT site_ref, source_id, cast(row_number() OVER (PARTITION BY site_ref ORDER BY source_id) - 1 AS bigint) AS i FROM {entities}", "Position of an entity in its site.")
contiguous_through = Operator(
    """
SELECT site_ref, max(window_no) + 1 AS through FROM (
  SELECT site_ref, window_no, max(gap) OVER (PARTITION BY site_ref ORDER BY window_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gapped FROM (
    SELECT site_ref, window_no, CASE WHEN window_no = coalesce(lag(window_no) OVER (PARTITION BY site_ref ORDER BY window_no), $baseline - 1) + 1 THEN 0 ELSE 1 END AS gap
    FROM (SELECT DISTINCT site_ref, window_no FROM {jobs} WHERE status = 'certified') d) g) x WHERE gapped = 0 GROUP BY site_ref""",
    "The furthest end that each site reaches without a gap.",
    baseline=0,
)


@operator
def newest_first_pick(versions):
    """Each day's newest version, the larger one on ties."""
    return versions.groupBy(F.to_date("certified_at").alias("day")).agg(F.max(F.struct("certified_at", "version")).alias("x")).select("day", "x.*")


@operator
def newest_version(versions):
    """The newest version of all."""
    return versions.orderBy(F.desc("certified_at"), F.desc("version")).limit(1)


stale_pick = Operator("SELECT batch_id, window_no FROM {jobs} WHERE status = 'planned' ORDER BY window_no, batch_id LIMIT $limit", "The oldest batches first.", limit=25)
sample_points = Operator("SELECT id FROM {points} WHERE historized AND outcome = 'accepted' ORDER BY @sha[concat(id, '$seed')], id LIMIT $n", "So many historised points, all if fewer, picked by a seeded hash.", n=30, seed="s1")
