"""Coverage checks by batch. A batch with a fault gives no rows; the others go on.

Every check gives (batch_id, ok, reason); the reason is the first fault in the order listed.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagflow.functions.normalize import detection_key, instant_with_zone, utc_clock
from tagflow.sqlops import Operator, operator
from tagflow.tables import tasks


def first_fault(*rules: tuple[Column, str]) -> Column:
    """The name of the first rule whose condition holds; a condition that is null counts as a fault."""
    chain = None
    for broken, name in rules:
        broken = F.coalesce(broken, F.lit(True))
        chain = F.when(broken, name) if chain is None else chain.when(broken, name)
    return F.coalesce(chain, F.lit(""))


def verdict(df: DataFrame, *rules: tuple[Column, str]) -> DataFrame:
    return df.select("batch_id", first_fault(*rules).alias("reason")).select("batch_id", (F.col("reason") == "").alias("ok"), "reason")


def _planned(plan: DataFrame, pages: DataFrame) -> DataFrame:
    """Each batch with its page under p_; a batch without a page has nulls there."""
    return plan.join(pages.select(*(F.col(c).alias(f"p_{c}") for c in pages.columns)), plan.batch_id == F.col("p_batch_id"), "left")


_c = F.col
#: Batches of a task that judges a plan of rule days; each has its scope, its receipt's, and as many detections.
BATCHES = 8_000


def dealt(plan: DataFrame) -> DataFrame:
    """``plan`` in tasks of ``BATCHES`` batches; what it is joined with by batch goes to as many."""
    return plan.repartition(tasks(plan, BATCHES), "batch_id")


@operator
def history_coverage(plan, pages, max_rows=100_000):
    """Receipts of history pages against the plan: scope in order, completed, rows, window, project and site."""
    df = _planned(plan, pages)
    return verdict(
        df, (_c("p_batch_id").isNull(), "no_receipt"), (_c("p_err").isNotNull(), "error"), (~_c("p_complete"), "incomplete"), (_c("p_truncated"), "truncated"),
        (_c("p_project") != _c("project"), "project"), (_c("p_site_ref") != _c("site_ref"), "site"), (F.coalesce(_c("p_query_id"), F.lit("")) == "", "query_id"),
        ((_c("p_window_start") != _c("window_start")) | (_c("p_window_end") != _c("window_end")), "window"), (_c("p_requested") != _c("scope"), "requested"), (_c("p_completed") != _c("p_requested"), "completed"),
        (_c("p_returned_rows") != _c("p_actual_rows"), "returned_rows"), (_c("p_total_rows") != _c("p_actual_rows"), "total_rows"), (_c("p_actual_rows") > max_rows, "row_cap"),
    )


@operator
def history_columns(plan, columns):
    """Columns of each page: exactly one ``ts``, names and ids unique, ids those of the scope."""
    point = F.when(_c("name") != "ts", F.coalesce("point_id", "name"))
    seen = columns.groupBy("batch_id").agg(
        F.count_if(_c("name") == "ts").alias("stamps"), F.count("name").alias("n"), F.count_distinct("name").alias("names"), F.count(point).alias("ids"), F.count_distinct(point).alias("distinct_ids"), F.collect_set(point).alias("own")
    )
    df = plan.select("batch_id", "scope").join(seen, "batch_id", "left")
    other = (F.size(F.array_except("own", "scope")) > 0) | (F.size(F.array_except("scope", "own")) > 0)
    return verdict(df, (_c("stamps") != 1, "ts"), (_c("n") != _c("names"), "names"), (_c("ids") != _c("distinct_ids"), "ids"), (other, "scope"))


@operator
def history_rows(plan, rows, max_observations=60):
    """Samples of each batch: inside the half-open window, of requested points, unique by point and instant, within the cap.

    Windows are texts with their zone, whatever it is; a window without one is a fault of its batch.
    """
    start, end = (utc_clock(instant_with_zone(_c(c))) for c in ("window_start", "window_end"))
    own = rows.join(plan.select("batch_id", "scope", start.alias("s"), end.alias("e")), "batch_id")
    keys = own.groupBy("batch_id", "point_id", "observed_at").agg(
        F.count("*").alias("n"), F.max(F.coalesce((_c("observed_at") < _c("s")) | (_c("observed_at") >= _c("e")), F.lit(True))).alias("late"), F.max(~F.array_contains("scope", _c("point_id"))).alias("stray")
    )
    found = keys.groupBy("batch_id").agg(F.bool_or("late").alias("late"), F.bool_or("stray").alias("stray"), (F.max("n") > 1).alias("again"), F.sum("n").alias("n"))
    df = plan.select("batch_id").join(found, "batch_id", "left").fillna(False, ["late", "stray", "again"]).fillna(0, ["n"])
    return verdict(df, (_c("stray"), "unrequested"), (_c("late"), "outside_window"), (_c("again"), "duplicate"), (_c("n") > max_observations, "observation_cap"))


@operator
def history_values(plan, rows):
    """Samples of each batch have a type; a batch without samples is sound."""
    bad = rows.groupBy("batch_id").agg(F.bool_or(_c("value_kind").isNull()).alias("bad"))
    return verdict(plan.select("batch_id").join(bad, "batch_id", "left").fillna(False, ["bad"]), (_c("bad"), "value"))


@operator
def duplicate_samples(samples):
    """Points with more than one sample at an instant."""
    again = samples.groupBy("point_id", "observed_at").agg(F.count("*").alias("n")).where("n > 1")
    return again.groupBy("point_id").agg(F.count("*").alias("duplicate_keys"), F.sum("n").alias("rows_in"))


@operator
def metadata_page_chain(chain, max_entities=100_000):
    """Pages of a site's equipment and points: one snapshot, indices without a gap, counts, and only the last complete.

    Gives (site_ref, ok, reason).
    """
    by = Window.partitionBy("site_ref", "kind").orderBy("page")
    kinds = chain.withColumns({"at": F.row_number().over(by) - 1, "sofar": F.sum("actual_rows").over(by), "again": F.count("*").over(Window.partitionBy("site_ref", "kind", "next_page")) > 1, "more": F.lead("page").over(by).isNotNull()})
    bad_token = _c("more") & (_c("next_page").isNull() | (_c("next_page") == "") | _c("again") | _c("complete"))
    bad_end = ~_c("more") & (_c("next_page").isNotNull() | ~_c("complete") | (_c("total_rows") != _c("sofar")))
    site = kinds.groupBy("site_ref").agg(
        F.bool_or(_c("err").isNotNull()).alias("err"), F.count_distinct("snapshot").alias("snapshots"), F.bool_or(_c("page_index") != _c("at")).alias("gap"), F.bool_or(_c("returned_rows") != _c("actual_rows")).alias("rows"),
        F.bool_or(bad_token).alias("token"), F.bool_or(bad_end).alias("end"), F.max("sofar").alias("most"), F.count_distinct("kind").alias("kinds"),
    )
    rules = ((_c("err"), "error"), (_c("snapshots") != 1, "snapshot"), (_c("gap"), "page_index"), (_c("rows"), "returned_rows"), (_c("token"), "next_page"), (_c("end") | (_c("kinds") != 2), "total"), (_c("most") > max_entities, "entity_cap"))
    return verdict(site.withColumnRenamed("site_ref", "batch_id"), *rules).withColumnRenamed("batch_id", "site_ref")


@operator
def rules_coverage(plan, pages):
    """Receipts of rule days: as for history, and day, zone, requested count, a single page and unique columns."""
    df = _planned(dealt(plan), pages)
    names = F.split("p_columns", ",")
    return verdict(
        df, (_c("p_batch_id").isNull(), "no_receipt"), (_c("p_err").isNotNull(), "error"), (~_c("p_complete"), "incomplete"), (_c("p_truncated"), "truncated"), (_c("p_project") != _c("project"), "project"), (_c("p_site_ref") != _c("site_ref"), "site"),
        (_c("p_day").cast("date") != _c("day"), "day"), (_c("p_timezone") != _c("timezone"), "timezone"), (_c("p_requested") != _c("scope"), "requested"), (_c("p_completed") != _c("p_requested"), "completed"),
        (_c("p_requested_count") != F.size("scope"), "requested_count"), (_c("p_returned_rows") != _c("p_actual_rows"), "returned_rows"), (_c("p_total_rows") != _c("p_actual_rows"), "total_rows"),
        ((_c("p_page_index") != 0) | _c("p_next_page").isNotNull(), "paging"), (F.size(F.array_distinct(names)) != F.size(names), "columns"),
    )


@operator
def rules_rows(plan, found, project="1001", zones=("UTC",)):
    """Detections of each day: of requested equipment, of the project (or none named), of that day and zone, with a value, each identity once.

    A day without detections is sound.
    """
    plan = dealt(plan)
    own = found.join(plan.select("batch_id", "scope", "day", "site_ref", "timezone"), "batch_id")
    key = detection_key(F.lit("t"), F.lit(project), _c("site_ref"), _c("equipment_id"), _c("rule_id"), _c("day"), _c("timezone"))
    keys = own.groupBy("batch_id", key.alias("key")).agg(
        F.count("*").alias("n"), F.bool_or(~F.array_contains("scope", _c("equipment_id"))).alias("target"), F.bool_or(F.coalesce("project", F.lit(project)) != project).alias("project"),
        F.bool_or((_c("found_day").cast("date") != _c("day")) | ~_c("tz").isin(*zones)).alias("day"), F.bool_or(_c("spark").isNull()).alias("spark"),
    )
    batch = keys.groupBy("batch_id").agg(*(F.bool_or(x).alias(x) for x in ("target", "project", "day", "spark")), (F.max("n") > 1).alias("again"))
    batch = plan.select("batch_id").join(batch, "batch_id", "left").fillna(False, ["target", "project", "day", "spark", "again"])
    return verdict(batch, (_c("target"), "target"), (_c("project"), "project"), (_c("day"), "day_or_zone"), (_c("spark"), "no_value"), (_c("again"), "duplicate_detection"))


scope_equality = Operator(
    """
SELECT coalesce(a.id, b.id) AS id, CASE WHEN b.id IS NULL THEN 'missing' ELSE 'unexpected' END AS fault
FROM (SELECT DISTINCT id FROM {requested}) a FULL JOIN (SELECT DISTINCT point_id AS id FROM {returned}) b ON a.id = b.id WHERE a.id IS NULL OR b.id IS NULL""",
    "Ids on one side only; none means the scope is met.",
)


@operator
def observed_coverage(plan, pages, columns, markers=("trunc", "limit")):
    """The weaker receipt, made from the response: no error, no key that tells of a cut, a column for every requested point."""
    have = columns.where("name <> 'ts'").groupBy("batch_id").agg(F.collect_set(F.coalesce("point_id", "name")).alias("own"))
    df = plan.select("batch_id", "scope").join(pages.select("batch_id", "err", F.split(F.lower("meta_keys"), ",").alias("keys")), "batch_id").join(have, "batch_id", "left")
    told = F.exists("keys", lambda k: reduce(lambda a, b: a | b, (k.contains(m) for m in markers)))
    missing = F.size(F.array_except("scope", F.coalesce("own", F.array().cast("array<string>")))) > 0
    return verdict(df, (_c("err").isNotNull() | F.array_contains("keys", "err"), "error"), (told, "cut"), (missing, "missing_column")).withColumn("label", F.lit("observed"))


@operator
def drop_boundary(history, start="2024-01-05 00:00:00", end="2024-01-20 00:00:00"):
    """Lenient mode: samples outside the half-open window are dropped and counted."""
    inside = (_c("observed_at") >= F.lit(start).cast("timestamp_ntz")) & (_c("observed_at") < F.lit(end).cast("timestamp_ntz"))
    return history.groupBy("point_id").agg(F.count_if(inside).alias("kept"), F.count_if(~inside).alias("dropped"))


@operator
def size_caps(plan, rows, max_rows=30, max_bytes=1_200, max_entities=7):
    """Rows, bytes of their JSON lines and distinct points by batch, and the first cap that is exceeded; a batch without rows is within all.

    Null fields count as they are written, so one of them does not hide a row's bytes.
    """
    line = F.to_json(F.struct("point_id", "row_no", "value_kind"), {"ignoreNullFields": "false"})
    got = rows.groupBy("batch_id").agg(F.count("*").alias("n_rows"), F.sum(F.octet_length(line) + 1).alias("bytes"), F.count_distinct("point_id").alias("entities"))
    df = plan.select("batch_id").join(got, "batch_id", "left").fillna(0, ["n_rows", "bytes", "entities"])
    return df.withColumn("reason", first_fault((_c("n_rows") > max_rows, "rows"), (_c("bytes") > max_bytes, "bytes"), (_c("entities") > max_entities, "entities")))


#: Links from sound to worst.
LINKS = ("linked", "parent_elsewhere", "unknown_parent", "duplicate", "two_sites")


def linked(entities: DataFrame) -> DataFrame:
    """Entities with ``link``, the first fault: an id twice in its kind, an id in two sites, a parent unknown or elsewhere."""
    same = entities.groupBy("kind", "source_id").agg(F.count("*").alias("n"), F.count_distinct("site_ref").alias("sites"))
    parents = entities.where("kind = 'equipment'").groupBy(_c("source_id").alias("parent_id")).agg(F.min("site_ref").alias("parent_site"))
    df = entities.join(same, ["kind", "source_id"]).join(parents, "parent_id", "left")
    lonely = (_c("kind") == "point") & _c("parent_id").isNotNull()
    link = F.when(_c("sites") > 1, "two_sites").when(_c("n") > 1, "duplicate").when(lonely & _c("parent_site").isNull(), "unknown_parent").when(lonely & (_c("parent_site") != _c("site_ref")), "parent_elsewhere").otherwise("linked")
    return df.withColumn("link", link)


@operator
def entity_links(entities):
    """Entities by site and the first fault of their links."""
    return linked(entities).groupBy("site_ref", "kind", "link").agg(F.count("*").alias("n"))


@operator
def entity_link_verdicts(entities):
    """Sites by the worst of their entities' links."""
    worst = F.max(F.array_position(F.array(*map(F.lit, LINKS)), _c("link")))
    site = linked(entities).groupBy(_c("site_ref").alias("batch_id")).agg(worst.cast("int").alias("w"))
    return site.select("batch_id", (_c("w") == 1).alias("ok"), F.when(_c("w") == 1, "").otherwise(F.get(F.array(*map(F.lit, LINKS)), _c("w") - 1)).alias("reason"))


def _shape() -> Column:
    equipment = _c("kind") == "equipment"
    return first_fault(
        (equipment & _c("parent_id").isNotNull(), "equipment_parent"), (equipment & _c("historized"), "equipment_historized"), (equipment & _c("site_level").isNotNull(), "equipment_site_level"),
        (~equipment & (_c("site_level") != _c("parent_id").isNull()), "site_level"), (~equipment & (_c("historized") != (_c("his") == "m:")), "historized"),
    )


@operator
def entity_shape(entities):
    """Entities whose fields contradict one another, with the first fault; sound ones have none."""
    return entities.select("kind", "source_id", _shape().alias("fault"))


@operator
def entity_shape_verdicts(entities):
    """Sites by the first fault of their entities' shapes, by name."""
    site = entities.groupBy(_c("site_ref").alias("batch_id")).agg(F.min(F.when(_shape() != "", _shape())).alias("fault"))
    return site.select("batch_id", _c("fault").isNull().alias("ok"), F.coalesce("fault", F.lit("")).alias("reason"))


@operator
def completion_scope(jobs, completed):
    """Completions against their batch, the first fault: an id twice, ids that are not those expected, a target of another kind.

    ``jobs`` have feed, site_ref, scope and target; a metadata batch is expected to complete its site, another one its scope.
    ``completed`` have batch_id, ids and target. A batch without a completion has ``none``.
    """
    done = completed.select("batch_id", "ids", _c("target").alias("got"), F.lit(True).alias("told"))
    expected = F.when(_c("feed") == "metadata", F.array("site_ref")).otherwise(_c("scope"))
    same = F.array_sort(F.array_distinct("ids")) == F.array_sort(F.array_distinct(expected))
    df = jobs.join(done, "batch_id", "left")
    reason = F.when(_c("told").isNull(), "none").otherwise(first_fault((F.size(F.array_distinct("ids")) != F.size("ids"), "twice"), (~same, "scope"), (_c("got") != _c("target"), "target")))
    return df.select("batch_id", "feed", (reason == "").alias("ok"), reason.alias("reason"))
