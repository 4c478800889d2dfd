"""Idempotent merges against stored tables. Each gives what to add; base tables are never rewritten.

There is no transactional table format here: what a merge gives is appended as one partition
directory, and a repeated merge gives nothing new.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagflow.functions.normalize import detection_key, row_hash
from tagflow.sqlops import operator

_c = F.col
POLICIES = ("reject", "append_revision")


#: The key of an observation.
KEY = ["tenant_id", "project_id", "point_id", "observed_at"]


#: Parts that a batch's rows are dealt to where they are told what becomes of the batch, as one batch may be all rows that there are.
SLOTS = 1024


def _marked(rows: DataFrame, slots: DataFrame, batches: DataFrame, why: str) -> DataFrame:
    """``rows`` with ``reason`` where their batch is among ``batches`` and has none yet; both have a ``_slot``, of which ``slots`` has each batch's."""
    bad = slots.join(batches.select("batch_id").distinct(), "batch_id", "left_semi").withColumn("_bad", F.lit(why))
    return rows.join(bad, ["batch_id", "_slot"], "left").withColumn("reason", F.coalesce("reason", "_bad")).drop("_bad")


def merged(base: DataFrame, staged: DataFrame, policy: str = "append_revision") -> DataFrame:
    """``staged`` with what becomes of each sample, ``action``, and why its batch is refused, ``reason`` (else null).

    insert: a new key; ignore: the key is stored with the same hash; on another hash ``append_revision``
    makes a revision beside the base, and ``reject`` refuses the whole batch (``conflict``). A batch that
    holds a key twice is refused under either policy (``double_key``), whatever the values. Of batches
    that are staged together and share a key the first by ``batch_id`` comes first; under ``reject`` a
    later one that contradicts it is refused, whatever becomes of the first.
    Both sides have the key, ``row_hash`` (the stored one, not computed again), and ``staged`` a batch_id.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy is one of {POLICIES}")
    twice = staged.groupBy("batch_id", *KEY).agg(F.count("*").alias("n")).where("n > 1")
    stored = base.select(*KEY, _c("row_hash").alias("stored_hash"))
    dealt = staged.withColumns({"reason": F.lit(None).cast("string"), "_slot": F.pmod(F.xxhash64(*KEY), F.lit(SLOTS))})
    slots = dealt.select("batch_id", "_slot").distinct()
    told = _marked(dealt, slots, twice, "double_key").join(stored, KEY, "left")
    by = Window.partitionBy(*KEY, _c("reason").isNull()).orderBy("batch_id")
    first = F.first("row_hash").over(by)
    if policy == "reject":
        told = _marked(told, slots, told.where("reason IS NULL AND stored_hash <> row_hash"), "conflict")
        told = _marked(told, slots, told.withColumn("first", first).where("reason IS NULL AND first <> row_hash"), "conflict")
    at = told.withColumns({"first": F.coalesce("stored_hash", first), "place": F.row_number().over(by)})
    action = F.when(_c("reason").isNotNull(), "refused").when(_c("stored_hash").isNull() & (_c("place") == 1), "insert").when(_c("row_hash") == _c("first"), "ignore").otherwise("revision")
    return at.withColumn("action", action).drop("first", "place", "stored_hash", "_slot")


@operator
def merge_history(base, staged, policy="append_revision"):
    """What becomes of each staged sample, as in ``merged``."""
    told = merged(base, staged, policy)
    return told.select("row_no", "batch_id", "point_id", "observed_at", "row_hash", "action", F.coalesce("reason", F.lit("")).alias("reason"))


@operator
def history_revisions(told, revisions):
    """The revisions to append: those of the merge that are not stored yet, each once."""
    key = ["point_id", "observed_at", "row_hash"]
    return told.where("action = 'revision'").select(*key).distinct().join(revisions.select(*key), key, "left_anti")


@operator
def merge_history_reject(base, staged):
    """The strict policy by batch: one conflict, or one key twice, refuses it."""
    told = merged(base, staged, "reject")
    return told.groupBy("batch_id").agg(F.count("*").alias("staged"), (F.count_if(_c("action") == "refused") == 0).alias("accepted"), F.coalesce(F.max("reason"), F.lit("")).alias("reason"))


#: The key of an entity: an equipment and a point may share an id.
ENTITY = ["kind", "source_id"]


def entity_hash(df: DataFrame) -> DataFrame:
    """``df`` with ``row_hash`` of an entity's whole content; null fields are values like any other."""
    fields = ("kind", "source_id", "site_ref", "equipment_ref", "historized", "payload")
    return df.withColumn("row_hash", row_hash(**{k: _c(k) for k in fields}))


@operator
def merge_metadata_revisions(harvest, published):
    """Entity revisions, by kind, id, site and hash, that are not stored yet."""
    key = [*ENTITY, "site_ref", "row_hash"]
    return entity_hash(harvest).select(*key).distinct().join(entity_hash(published).select(*key), key, "left_anti")


def rule_revisions(df: DataFrame, tenant: str = "t", project: str = "1001") -> DataFrame:
    """(source_date, detection_key, revision_hash) of detections with their site and zone."""
    key = detection_key(F.lit(tenant), F.lit(project), _c("site_ref"), _c("equipment_id"), _c("rule_id"), _c("source_date"), _c("zone"))
    return df.select("source_date", key.alias("detection_key"), row_hash(severity=_c("severity"), priority=_c("priority")).alias("revision_hash"))


@operator
def merge_rule_revisions(staged_revisions, stored_revisions):
    """Revisions of detections not stored yet, each once; the key leaves the payload out."""
    return rule_revisions(staged_revisions).distinct().join(rule_revisions(stored_revisions), ["source_date", "detection_key", "revision_hash"], "left_anti")


@operator
def entity_changes(harvest, published):
    """Added and changed entities by kind and id, with both hashes; unchanged ones are silent and nothing is deleted."""
    old = entity_hash(published).select(*ENTITY, _c("row_hash").alias("previous_hash"))
    told = entity_hash(harvest).join(old, ENTITY, "left").where(~_c("previous_hash").eqNullSafe(_c("row_hash")))
    return told.select(*ENTITY, F.when(_c("previous_hash").isNull(), "added").otherwise("changed").alias("change"), "previous_hash", _c("row_hash").alias("current_hash"))


@operator
def upsert_entities(harvest, published, run_id="run-now"):
    """Current state by kind and id: a new row wins as a whole, nulls too; others stay, with the run that last saw them."""
    fields = ("site_ref", "equipment_ref", "historized", "payload")
    old = published.select(*ENTITY, F.struct(*fields, "last_seen").alias("old"))
    new = harvest.select(*ENTITY, F.struct(*fields, F.lit(run_id).alias("last_seen")).alias("new"))
    return old.join(new, ENTITY, "full").select(*ENTITY, F.coalesce("new", "old").alias("x")).select(*ENTITY, "x.*")


@operator
def shrink_guard(harvests, published, publications):
    """By run, whether its harvest as a whole may be published: not ``older`` than a published run, and nothing missing (``shrinks``).

    ``harvests`` hold the entities of each run with its ``scheduled_at``, ``publications`` the runs published before.
    """
    runs = harvests.groupBy("run_id").agg(F.max("scheduled_at").alias("at"))
    newest = publications.agg(F.max("scheduled_at").alias("newest"))
    known = published.select(*ENTITY).distinct()
    kept = harvests.select("run_id", *ENTITY).distinct().join(known, ENTITY, "left_semi").groupBy("run_id").agg(F.count("*").alias("kept"))
    told = runs.join(kept, "run_id", "left").crossJoin(F.broadcast(newest)).crossJoin(F.broadcast(known.agg(F.count("*").alias("n"))))  # single aggregates
    missing = _c("n") - F.coalesce("kept", F.lit(0))
    reason = F.when(_c("newest") > _c("at"), "older").when(missing > 0, "shrinks").otherwise("")
    return told.select("run_id", missing.alias("missing"), reason.alias("reason"), (reason == "").alias("ok"))


def publish(harvests: DataFrame, published: DataFrame, publications: DataFrame, run_id: str) -> DataFrame:
    """The current state after publishing a run; a run that ``shrink_guard`` refuses is an error, and changes nothing."""
    told = shrink_guard(harvests=harvests.where(_c("run_id") == run_id), published=published, publications=publications).first()
    if told is None or not told.ok:
        raise ValueError(f"run {run_id} is not published: {told.reason if told else 'it has no entities'}")
    return upsert_entities(harvest=harvests.where(_c("run_id") == run_id), published=published, run_id=run_id)


@operator
def merge_receipts(stored_receipts, new_receipts):
    """Receipts to insert, those known already, and those that contradict the stored one, which is an error of the batch."""
    old = stored_receipts.select("batch_key", _c("row_count").alias("n"), _c("checksum").alias("sum"), F.lit(True).alias("known"))
    same = _c("row_count").eqNullSafe(_c("n")) & _c("checksum").eqNullSafe(_c("sum"))
    return new_receipts.join(old, "batch_key", "left").select("batch_key", F.when(_c("known").isNull(), "insert").when(same, "same").otherwise("mismatch").alias("action"))


def check_receipts(merged: DataFrame) -> DataFrame:
    """``merge_receipts`` without the rows known already; a mismatch raises and names some batches."""
    bad = [r.batch_key for r in merged.where("action = 'mismatch'").limit(5).collect()]
    if bad:
        raise ValueError(f"receipts contradict those stored, among others of {bad}")
    return merged.where("action = 'insert'")


@operator
def batch_members(entities):
    """Members of a batch by position, each once."""
    at = F.row_number().over(Window.partitionBy("site_ref").orderBy("source_id")) - 1
    return entities.select("site_ref", "source_id").distinct().select(_c("site_ref").alias("batch_id"), "source_id", at.cast("long").alias("position"))
