"""Joins, set operations and recursion over lineage."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagflow.functions.normalize import instant_of
from tagflow.operators.merge import KEY
from tagflow.plans.planning import dealt_rank
from tagflow.sqlops import Operator, operator
from tagflow.tables import exists, materialize, new_path

_c = F.col
#: Windows that a spine may have: a day's five-minute windows, twelve times over.
MOST_WINDOWS = 3_456

batch_evidence = Operator(
    """
SELECT j.batch_id, j.status, c.certified_at, a.raw_key, r.row_count, CASE WHEN c.batch_id IS NULL THEN 'no_certification' WHEN a.artifact_id IS NULL THEN 'no_raw' WHEN r.batch_key IS NULL THEN 'no_receipt' ELSE 'whole' END AS evidence
FROM {jobs} j LEFT JOIN {certifications} c ON j.batch_id = c.batch_id LEFT JOIN {artifacts} a ON c.artifact_id = a.artifact_id LEFT JOIN {receipts} r ON c.batch_key = r.batch_key""",
    "Batches with what evidence they have: certification, raw artifact, receipt.",
)


@operator
def history_conflicts(base, staged):
    """Staged samples of a stored key whose hash differs from the stored one; the key is of tenant, project, point and instant."""
    stored = base.select(*KEY, _c("row_hash").alias("stored_hash"))
    return staged.join(stored, KEY).where(_c("row_hash") != _c("stored_hash")).select(*KEY, "row_no", "stored_hash", _c("row_hash").alias("staged_hash"))


lineage_roots = Operator("SELECT DISTINCT a.parent_id AS id FROM {lineage} a @anti {lineage} b ON a.parent_id = b.child_id", "Batches that are nobody's child.")
lineage_leaves = Operator("SELECT DISTINCT a.child_id AS id FROM {lineage} a @anti {lineage} b ON a.child_id = b.parent_id", "Batches that are nobody's parent.")


@operator
def eligible_inventory(runs, jobs, certifications, completions):
    """Runs whose metadata may serve as inventory: certified, at least one site complete, and no batch without certificate or completed site.

    A batch that was split stands for its children. Gives (run_id, certified_after), the time of the last completion.
    """
    last = completions.groupBy("run_id").agg(F.max("completed_at").alias("certified_after"))
    leaf = jobs.where("status <> 'split'").join(completions.select("run_id", "site_ref", F.lit(True).alias("done")), ["run_id", "site_ref"], "left")
    bad = leaf.join(certifications.select("batch_id", F.lit(True).alias("cert")), "batch_id", "left").where("status <> 'certified' OR cert IS NULL OR done IS NULL")
    return runs.where("status = 'certified'").join(last, "run_id").join(bad, "run_id", "left_anti").select("run_id", "certified_after")


@operator
def eligible_versions(registered, runs, jobs, certifications, completions):
    """Inventory versions that may serve: of an eligible metadata run, and not certified before its last completion, or before it was due."""
    run = eligible_inventory(runs=runs.where("feed = 'metadata'"), jobs=jobs, certifications=certifications, completions=completions)
    due = runs.select("run_id", "scheduled_at")
    good = registered.join(run, "run_id").join(due, "run_id").where((_c("certified_at") >= _c("certified_after")) & (_c("certified_at") >= _c("scheduled_at")))
    return good.select("version", "run_id", "certified_at")


def _hours(clock: Column) -> Column:
    """Hours from 1970 on a UTC clock."""
    return F.floor(F.unix_micros(instant_of(clock)) / 3_600_000_000)


@operator
def asof_inventory(dues, eligible, pins, age=72):
    """The newest eligible version at most ``age`` hours older than each due time, the larger version on ties.

    An earlier pin of a due time sticks; if its version is no longer eligible, or not of that time, that is a failure.
    Versions and due times are merged in order within hours, so no due time meets all versions: an
    hour's last version is carried to the hours after it.
    """
    good = eligible.select(_c("certified_at").alias("at"), "version")
    asked = dues.select(_c("due_at").alias("at"), "due_id")
    both = good.unionByName(asked, allowMissingColumns=True).withColumn("hour", _hours(_c("at")))
    # at equal times versions come before due times
    so_far = Window.partitionBy("hour").orderBy("at", F.col("due_id").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    newest = F.max(F.when(_c("version").isNotNull(), F.struct("at", "version"))).over(so_far)
    lasts = good.groupBy(_hours(_c("at")).alias("hour")).agg(F.max(F.struct("at", "version")).alias("last"))
    carried = lasts.select("last", "hour", F.explode(F.sequence(F.lit(1), F.lit(age + 1))).alias("after")).select("last", (_c("hour") + _c("after")).alias("hour"))
    carried = carried.groupBy("hour").agg(F.max("last").alias("last"))
    found = both.withColumn("newest", newest).where("due_id IS NOT NULL").join(carried, "hour", "left")
    pick = F.coalesce("newest", "last")
    in_time = pick["at"] >= _c("at") - F.make_dt_interval(hours=F.lit(age))
    chosen = found.select("due_id", _c("at").alias("due_at"), F.when(in_time, pick["version"]).alias("candidate"))
    fixed = pins.select("due_id", _c("version").alias("pin")).join(good.select(_c("version").alias("pin"), _c("at").alias("pin_at")), "pin", "left")
    own = chosen.join(fixed, "due_id", "left")
    holds = (_c("pin_at") <= _c("due_at")) & (_c("pin_at") >= _c("due_at") - F.make_dt_interval(hours=F.lit(age)))
    state = F.when(_c("pin").isNotNull(), F.when(F.coalesce(holds, F.lit(False)), "pinned").otherwise("pin_not_eligible")).when(_c("candidate").isNotNull(), "selected").otherwise("none_eligible")
    version = F.when(state == "pinned", _c("pin")).when(state == "selected", _c("candidate"))
    return own.select("due_id", "due_at", version.alias("version"), state.alias("state"))


PINS = "due_id long, version string, put long"


def read_pins(spark: SparkSession, root: str) -> DataFrame:
    """(due_id, version) of the pins below ``root``; of a due time pinned twice the first put holds."""
    if not exists(spark, root):
        return spark.createDataFrame([], "due_id long, version string")
    return spark.read.schema(PINS).option("basePath", root).parquet(root).groupBy("due_id").agg(F.min_by("version", "put").alias("version"))


def pin_versions(dues: DataFrame, eligible: DataFrame, root: str, put: int, age: int = 72) -> DataFrame:
    """``asof_inventory`` with the pins below ``root``; what it selects is pinned as put number ``put``, once and for all.

    A put owns the folder of its number; run again it pins the same, as it does not read its own pins.
    """
    spark = dues.sparkSession
    before = spark.createDataFrame([], PINS) if not exists(spark, root) else spark.read.schema(PINS).option("basePath", root).parquet(root).where(_c("put") != put)
    pins = before.groupBy("due_id").agg(F.min_by("version", "put").alias("version"))
    told = materialize(asof_inventory(dues=dues, eligible=eligible, pins=pins, age=age), "asof")
    told.where("state = 'selected'").select(_c("due_id").cast("long").alias("due_id"), "version").write.mode("overwrite").parquet(f"{root}/put={put}")
    return told


replay_admission = Operator(
    """
SELECT r.request_id, CASE WHEN g.approval_ref IS NULL OR g.expires_at <= cast('$now' AS timestamp_ntz) THEN 'no_active_grant' WHEN g.inventory <> r.inventory THEN 'other_scope'
  WHEN g.grant_start > r.window_start OR g.grant_end < r.window_end THEN 'outside_window' WHEN g.max_jobs < r.jobs THEN 'too_many_jobs' WHEN g.expires_at < r.requested_at THEN 'expired' ELSE 'admitted' END AS verdict
FROM {requests} r LEFT JOIN {approvals} g ON r.approval_ref = g.approval_ref""",
    "Requests whose window lies inside their grant, within its job cap and before it expires.",
    now="2024-01-12 00:00:00",
)
link_status = Operator(
    "SELECT d.targetRef, CASE WHEN e.id IS NULL THEN 'unknown' ELSE 'known' END AS status, count(*) AS n FROM {detections} d LEFT JOIN (SELECT id FROM {equipment} WHERE outcome = 'accepted') e ON d.targetRef = e.id GROUP BY d.targetRef, CASE WHEN e.id IS NULL THEN 'unknown' ELSE 'known' END",
    "Detections on known and unknown equipment.",
)


@operator
def coverage_spine(points, windows):
    """Every accepted point in every window. The distinct windows are one list, of at most MOST_WINDOWS."""
    each = windows.agg(F.array_sort(F.collect_set("window_no")).alias("w"))
    few = each.select(F.when(F.size("w") <= MOST_WINDOWS, _c("w")).otherwise(F.raise_error(F.lit("too many windows")).cast(each.schema["w"].dataType)).alias("w"))
    return points.where("outcome = 'accepted'").select(_c("id").alias("point_id")).crossJoin(few).select("point_id", F.explode("w").alias("window_no"))


@operator
def cyclic_join(entities):
    """Each site's entities paired in turn with all entities of one whole site, the first by name."""
    ranked = dealt_rank(entities.select("site_ref", "source_id"), "site_ref", F.substring("source_id", 1, 6), ["source_id"], "i")
    first = entities.agg(F.min("site_ref").alias("site_ref"))
    template = ranked.join(F.broadcast(first), "site_ref").select(_c("source_id").alias("copy_of"), "i")
    n = entities.join(F.broadcast(first), "site_ref").agg(F.count("*").alias("n"))
    turns = ranked.crossJoin(F.broadcast(n)).select("source_id", (_c("i") % _c("n")).alias("i"))
    return turns.join(template, "i").select("source_id", "copy_of")


@operator
def snapshot_compare(prior, current):
    """Two snapshots side by side by key and payload, nulls compared as values; a key on one side only differs."""
    a = prior.select("source_id", _c("payload").alias("a"), F.lit(True).alias("in_a"))
    b = current.select("source_id", _c("payload").alias("b"), F.lit(True).alias("in_b"))
    same = _c("in_a").isNotNull() & _c("in_b").isNotNull() & _c("a").eqNullSafe(_c("b"))
    return a.join(b, "source_id", "full").select("source_id", F.when(same, "MATCH").otherwise("DIFF").alias("verdict"))


certified_batch_feed = Operator(
    """
SELECT o.publication_id, j.batch_id, j.run_id, j.site_ref, c.certified_at, a.raw_key, a.raw_checksum, r.batch_key, r.checksum AS sink_checksum, r.row_count
FROM {outbox} o JOIN {jobs} j ON j.batch_id = o.batch_id JOIN {certifications} c ON c.batch_id = j.batch_id JOIN {artifacts} a ON a.artifact_id = c.artifact_id JOIN {receipts} r ON r.batch_key = c.batch_key WHERE j.status = 'certified'""",
    "Certified batches with all their evidence, named stably.",
)


@operator
def union_frames(samples, resend):
    """Frames with differing columns, one above the other by name."""
    return samples.unionByName(resend, allowMissingColumns=True).select("point_id", "observed_at", "val_num", "source_status", "row_no")


missing_entities = Operator("SELECT source_id FROM {prior} EXCEPT SELECT source_id FROM {current}", "Prior entities that are gone.")
common_ids = Operator("SELECT id FROM {points} WHERE outcome = 'accepted' INTERSECT SELECT point_id AS id FROM {history}", "Ids both requested and returned.")


@operator
def requested_and_returned(points, history):
    """How many ids were requested and returned, requested only, returned only."""
    a = points.where("outcome = 'accepted'").select("id").distinct().withColumn("a", F.lit(True))
    b = history.select(_c("point_id").alias("id")).distinct().withColumn("b", F.lit(True))
    side = F.when(_c("b").isNull(), "missing").when(_c("a").isNull(), "unexpected").otherwise("matched")
    return a.join(b, "id", "full").groupBy(side.alias("side")).agg(F.count("*").alias("n"))


@operator
def set_equality(a, b):
    """By site: whether two id sets are equal."""
    sides = a.select("site_ref", "source_id", F.lit(1).alias("x")).distinct().unionByName(b.select("site_ref", "source_id", F.lit(2).alias("x")).distinct())
    return sides.groupBy("site_ref", "source_id").agg(F.sum("x").alias("x")).groupBy("site_ref").agg(F.bool_and(_c("x") == 3).alias("equal"))


@operator
def lineage_depth(lineage):
    """Root and depth of each batch of an acyclic lineage, a level at a time.

    The loop is over levels, not rows; each level is written as a table and the next one joins it.
    An acyclic lineage has no more levels than edges; a deeper walk is refused as a cycle.
    """
    spark, path = lineage.sparkSession, new_path(lineage.sparkSession, "lineage")
    kind = lineage.schema["parent_id"].dataType
    edges = lineage.where("parent_id IS NOT NULL").select(_c("parent_id").cast(kind).alias("id"), _c("child_id").cast(kind).alias("child_id"))
    roots = edges.select("id").join(edges.select(_c("child_id").alias("id")), "id", "left_anti").distinct()
    level, levels, most = roots.select("id", _c("id").alias("root"), F.lit(0).alias("depth")), [], None
    while True:
        at = f"{path}/level-{len(levels)}"
        level.write.option("compression", "zstd").parquet(at)
        schema, levels = level.schema, [*levels, at]
        level = spark.read.schema(schema).parquet(at)
        if level.isEmpty():
            return spark.read.schema(schema).parquet(*levels)
        if len(levels) % 100 == 0:
            most = most or edges.count()
            if len(levels) > most + 1:
                raise ValueError("the lineage has a cycle")
        level = level.join(edges, "id").select(_c("child_id").alias("id"), "root", F.lit(len(levels)).alias("depth"))


lineage_descendants = Operator("SELECT root, count(*) - 1 AS descendants, max(depth) AS deepest FROM {depths} GROUP BY root", "Size and depth of each root's tree.")


@operator
def leaf_completeness(depths, lineage, status):
    """A root is complete once all its leaves are certified."""
    leaves = depths.join(lineage.select(_c("parent_id").alias("id")).distinct(), "id", "left_anti").join(status, "id", "left")
    done = F.count_if(F.coalesce("status", F.lit("")) == "certified")
    return leaves.groupBy("root").agg(F.count("*").alias("leaves"), done.alias("certified"), (done == F.count("*")).alias("complete"))
