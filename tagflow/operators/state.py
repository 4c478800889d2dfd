"""State of runs, sites and checkpoints."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagflow.sqlops import Operator, operator

_c = F.col


def _leaves(jobs: DataFrame, children: DataFrame, certifications: DataFrame) -> DataFrame:
    """Batches that were not split, with whether they are certified with evidence."""
    done = certifications.select("batch_id", F.lit(True).alias("cert"))
    leaf = jobs.join(children.select(_c("parent_id").alias("batch_id")).distinct(), "batch_id", "left_anti")
    return leaf.join(done, "batch_id", "left").withColumn("whole", (_c("status") == "certified") & _c("cert").isNotNull())


@operator
def site_reconcile(jobs, runs, children, certifications, completions, cursors):
    """State of each run and site against the site's checkpoint, the first that holds:

    waiting_for_certification, already_advanced, advanced (metadata has no cursor), unseeded, waiting_for_prior_window,
    replay_certified, superseded_or_overlapping, advanced.
    """
    site = _leaves(jobs, children, certifications).groupBy("run_id", "site_ref").agg(F.count_if(~_c("whole")).alias("open"))
    own = site.join(runs.select("run_id", "feed", "window_start", "window_end"), "run_id").join(completions.select("run_id", "site_ref", F.lit(True).alias("done")), ["run_id", "site_ref"], "left").join(cursors, "site_ref", "left")
    through = _c("certified_through")
    state = (
        F.when(_c("open") > 0, "waiting_for_certification").when(_c("done"), "already_advanced").when(_c("feed") == "metadata", "advanced").when(through.isNull() | _c("baseline_at").isNull(), "unseeded")
        .when(through < _c("window_start"), "waiting_for_prior_window").when(through >= _c("window_end"), "replay_certified").when(through > _c("window_start"), "superseded_or_overlapping").otherwise("advanced")
    )
    return own.select("run_id", "site_ref", state.alias("state"))


@operator
def advance_checkpoints(jobs, children, certifications, cursors):
    """Checkpoints moved over windows whose leaves are all certified, one after another without a gap; never back.

    A site without a baseline or checkpoint stays as it is. Windows are told once, however often they came.
    """
    windows = _leaves(jobs, children, certifications).groupBy("site_ref", "window_start", "window_end").agg(F.bool_and("whole").alias("whole")).where("whole")
    ahead = windows.join(cursors, "site_ref").where("baseline_at IS NOT NULL AND window_start >= certified_through")
    by = Window.partitionBy("site_ref").orderBy("window_start")
    gap = _c("window_start") != F.coalesce(F.lag("window_end").over(by), _c("certified_through"))
    reached = ahead.withColumn("gap", gap.cast("int")).withColumn("gaps", F.sum("gap").over(by.rowsBetween(Window.unboundedPreceding, 0))).where("gaps = 0")
    moved = reached.groupBy("site_ref").agg(F.max("window_end").alias("to"))
    return cursors.join(moved, "site_ref", "left").select("site_ref", _c("certified_through").alias("was"), F.greatest("certified_through", "to").alias("through"))


@operator
def run_job_counts(jobs, certifications):
    """Batches by run: all, certified with evidence, terminal, split."""
    own = jobs.join(certifications.select("batch_id", F.lit(True).alias("cert")), "batch_id", "left")
    return own.groupBy("run_id").agg(
        F.count("*").alias("total"), F.count_if((_c("status") == "certified") & _c("cert").isNotNull()).alias("certified"), F.count_if(_c("status").isin("failed", "quarantined")).alias("terminal"), F.count_if(_c("status") == "split").alias("split")
    )


@operator
def distinct_sites(jobs, children):
    """Root batches and their sites by run."""
    roots = jobs.join(children.select(_c("child_id").alias("batch_id")), "batch_id", "left_anti")
    return roots.groupBy("run_id").agg(F.count("*").alias("roots"), F.count_distinct("site_ref").alias("sites"))


@operator
def run_status(runs, jobs, children, certifications, completions, observed_at="2024-01-27 12:00:00", max_seconds=900):
    """State of each run: blocked where its counts contradict one another; certified; partial or blocked after a failure or the deadline; pending."""
    done = completions.groupBy("run_id").agg(F.count("*").alias("completed"))
    df = runs.join(run_job_counts(jobs=jobs, certifications=certifications), "run_id", "left").join(distinct_sites(jobs=jobs, children=children), "run_id", "left").join(done, "run_id", "left")
    df = df.fillna(0, ["total", "certified", "terminal", "split", "roots", "sites", "completed"])
    all_done = (_c("certified") + _c("split") == _c("total")) & (_c("completed") == _c("sites"))
    odd = (_c("total") == 0) | (_c("roots") != _c("expected_job_count")) | (_c("sites") == 0) | (_c("completed") > _c("sites")) | ((_c("status") == "certified") & ~all_done)
    late = F.lit(observed_at).cast("timestamp_ntz") >= _c("scheduled_at") + F.make_dt_interval(secs=F.lit(max_seconds))
    reason = F.when(odd, "inconsistent_control_state").when((_c("status") == "certified") & all_done, "all_sites_certified").when(_c("terminal") > 0, "terminal_job").when(late, "deadline_elapsed").otherwise("awaiting_certification")
    short = F.when(_c("completed") > 0, "partial").otherwise("blocked")
    state = F.when(reason == "inconsistent_control_state", "blocked").when(reason == "all_sites_certified", "certified").when(reason.isin("terminal_job", "deadline_elapsed"), short).otherwise("pending")
    return df.select("run_id", "window_no", state.alias("state"), reason.alias("reason"), "total", "certified", "terminal", "sites", "completed")


@operator
def run_group_status(statuses, lookback=3):
    """A run and its ``lookback`` runs before: summed counters and the worst state, blocked before partial before pending."""
    if not 0 <= lookback <= 12:
        raise ValueError("a lookback is of at most 12 runs")
    each = statuses.withColumn("of", F.explode(F.sequence(_c("window_no"), _c("window_no") + lookback))).join(statuses.select(_c("window_no").alias("of"), _c("run_id").alias("group_run")), "of")
    rank = F.when(_c("state") == "blocked", 3).when(_c("state") == "partial", 2).when(_c("state") == "pending", 1).otherwise(0)
    sums = each.groupBy(_c("group_run").alias("run_id")).agg(F.count("*").alias("runs"), F.max(rank).alias("worst"), *(F.sum(x).alias(x) for x in ("total", "certified", "terminal", "sites", "completed")))
    return sums.select("run_id", "runs", F.element_at(F.array(*map(F.lit, ("certified", "pending", "partial", "blocked"))), _c("worst") + 1).alias("state"), "total", "certified", "terminal", "sites", "completed")


@operator
def run_completion(runs, jobs, children, completions):
    """Runs without a batch that is neither certified nor split, all of whose sites are completed."""
    open_ = jobs.where("status NOT IN ('certified', 'split')").select("run_id").distinct().withColumn("open", F.lit(True))
    roots = jobs.join(children.select(_c("child_id").alias("batch_id")), "batch_id", "left_anti").select("run_id", "site_ref").distinct()
    lacking = roots.join(completions, ["run_id", "site_ref"], "left_anti").select("run_id").distinct().withColumn("lacks", F.lit(True))
    return runs.join(open_, "run_id", "left").join(lacking, "run_id", "left").select("run_id", (_c("open").isNull() & _c("lacks").isNull()).alias("complete"))


@operator
def stale_batches(jobs, outbox, attempts, now="2024-01-25 00:00:00", grace_seconds=3600, max_redrives=5, limit=1000):
    """Sent batches that wait too long: running past their lease, or planned and never tried; the oldest first, a report only."""
    before = F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(secs=F.lit(grace_seconds))
    df = jobs.join(outbox.drop("publication_id"), "batch_id").join(attempts.select("batch_id", F.lit(True).alias("tried")).distinct(), "batch_id", "left")
    expired = (_c("status") == "running") & (_c("lease_expires_at") <= before) & (_c("updated_at") <= before)
    never = (_c("status") == "planned") & _c("tried").isNull() & (_c("sent_at") <= before) & (_c("updated_at") <= before)
    found = df.where((_c("state") == "sent") & (_c("redrive_count") < max_redrives) & (expired | never))
    return found.orderBy("sent_at", "batch_id").limit(limit).select("batch_id", F.when(_c("status") == "running", "expired_running").otherwise("never_started").alias("reason"), "sent_at")


dedupe_feed = Operator("SELECT publication_id, min(batch_id) AS batch_id, count(*) AS deliveries FROM (SELECT publication_id, batch_id FROM {feed} UNION ALL SELECT publication_id, batch_id FROM {outbox}) x GROUP BY publication_id", "A feed and a later delivery of it, each publication once.")


@operator
def retention_candidates(history, now="2024-01-31 00:00:00", days=20, replay_days=10):
    """Rows past their age; nothing is deleted. A policy that is shorter than the age of replays is refused."""
    if days < replay_days:
        raise ValueError("rows must stay at least as long as they may be replayed")
    return history.where(_c("observed_at") < F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(days))).select("row_no", "point_id", "observed_at")
