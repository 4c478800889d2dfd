"""Derivation of windows, local days, batches and their identities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagflow.functions.normalize import instant_of, local_clock, local_midnight, row_hash, utc_clock
from tagflow.sqlops import Operator, operator
from tagflow.tables import materialize

_c = F.col


@operator
def history_windows(dues, minutes=5, lag=5):
    """[due - lag - minutes, due - lag) of each due time; one off the grid of ``minutes`` is refused, not moved.

    ``lag`` must be a multiple of ``minutes``. Gives due_id, window_start, window_end (null where refused), ok.
    """
    if minutes < 1 or 60 % minutes or lag % minutes:
        raise ValueError("minutes must divide an hour, and lag must be a multiple of minutes")
    on_grid = (F.minute("due_at") % minutes == 0) & (F.date_part(F.lit("SECOND"), "due_at") == 0)
    back = lambda m: F.when(on_grid, _c("due_at") - F.make_dt_interval(mins=F.lit(m)))
    return dues.select("due_id", back(lag + minutes).alias("window_start"), back(lag).alias("window_end"), on_grid.alias("ok"))


@operator
def lookback_windows(windows, k=3, minutes=5):
    """Each window and the ``k`` before it, at most 12."""
    if not 0 <= k <= 12:
        raise ValueError("a lookback is of at most 12 windows")
    each = windows.where("ok").withColumn("lookback", F.explode(F.sequence(F.lit(0), F.lit(k))))
    back = F.make_dt_interval(mins=_c("lookback") * minutes)
    return each.select("due_id", "lookback", (_c("window_start") - back).alias("window_start"), (_c("window_end") - back).alias("window_end"))


@operator
def rules_days(dues, settlement_hours=6, zone="America/Chicago", lookback=2):
    """The local day before (due time - settlement) in ``zone``, and ``lookback`` days before that."""
    local = local_clock(_c("due_at") - F.make_dt_interval(hours=F.lit(settlement_hours)), zone)
    each = dues.select("due_id", F.date_sub(local.cast("date"), 1).alias("day"), F.explode(F.sequence(F.lit(0), F.lit(lookback))).alias("lookback"))
    return each.select("due_id", "lookback", F.date_sub("day", _c("lookback")).alias("rule_day"))


@operator
def batch_ids(batches, feed="history", window_start="2024-01-01T00:00:00Z"):
    """Identities from the scope: the same plan gives the same, whatever the order of its rows."""
    scope = {"feed": F.lit(feed), "site_ref": _c("site_ref"), "scope_ids": _c("ids"), "window_start": F.lit(window_start)}
    return batches.select("site_ref", "batch_no", row_hash(**scope).alias("batch_id"))




@operator
def plan_guard(sites, inventory_rows, project="1001"):
    """Approved sites against those of an inventory: missing, unapproved, or with rows of another project."""
    here = inventory_rows.groupBy(_c("siteRef").alias("site_ref")).agg(F.bool_or(_c("fsk") != project).alias("foreign"))
    both = sites.select("site_ref", F.lit(True).alias("approved")).join(here, "site_ref", "full")
    verdict = F.when(_c("foreign").isNull(), "missing").when(_c("approved").isNull(), "unapproved").when(_c("foreign"), "other_project").otherwise("ok")
    return both.select("site_ref", verdict.alias("verdict"))


@operator
def weekly_windows(dues, day="wednesday"):
    """The week that ends at each due time of the configured weekday; other due times are refused."""
    ok = F.lower(F.date_format("due_at", "EEEE")) == day
    return dues.select("due_id", F.when(ok, _c("due_at") - F.make_dt_interval(days=F.lit(7))).alias("window_start"), F.when(ok, _c("due_at")).alias("window_end"), ok.alias("ok"))


def retry_delay(attempt, base: int, most: int):
    """Column: seconds before the next attempt, doubling from ``base`` up to ``most``."""
    return F.least(F.lit(float(most)), base * F.pow(F.lit(2.0), F.least(attempt - 1, F.lit(20)))).cast("long")


@operator
def retry_delays(attempts, base=90, most=300):
    """When a failed attempt may be repeated."""
    return attempts.where("outcome = 'retried'").groupBy("attempt_no").agg(F.count("*").alias("n")).withColumn("delay_seconds", retry_delay(_c("attempt_no"), base, most))


@operator
def window_labels(windows):
    """Labels of accepted windows, as file and report names have them."""
    label = F.concat_ws("-", F.date_format("window_start", "yyyyMMdd'T'HHmm"), F.date_format("window_end", "HHmm"))
    return windows.where("ok").groupBy(label.alias("label")).agg(F.count("*").alias("n"))


publication_id = Operator("SELECT j.batch_id, @sha[concat('certified-job:', j.batch_id)] AS publication_id FROM {jobs} j @anti {children} c ON j.batch_id = c.parent_id WHERE status = 'certified'", "A stable name by certified leaf.")


@operator
def replay_filter(requests, now="2024-01-25 00:00:00", max_age_hours=240, skew_minutes=5, max_window_days=20, inventory="inv-1", max_jobs=60, zone="UTC"):
    """Requests by the first rule they break: age, clock, age of the window, scope, whole local day (rules), job cap."""
    at = F.lit(now).cast("timestamp_ntz")
    day = F.to_date(local_clock(_c("window_start"), zone))
    whole = (_c("window_start") == local_midnight(day, zone)) & (_c("window_end") == local_midnight(F.date_add(day, 1), zone))
    verdict = (
        F.when(_c("requested_at") < at - F.make_dt_interval(hours=F.lit(max_age_hours)), "too_old").when(_c("requested_at") > at + F.make_dt_interval(mins=F.lit(skew_minutes)), "in_future")
        .when(at - F.make_dt_interval(days=F.lit(max_window_days)) > _c("window_start"), "window_too_old").when(_c("inventory") != inventory, "other_scope")
        .when((_c("feed") == "rules") & ~whole, "not_a_local_day").when(_c("jobs") > max_jobs, "too_many_jobs").otherwise("ok")
    )
    return requests.select("request_id", verdict.alias("verdict"))


def local_day_window(day: Column, zone: str) -> tuple[Column, Column]:
    """Instants of a local day's midnights: 23 or 25 hours apart when the clock changes, whatever the session's zone."""
    return instant_of(local_midnight(day, zone)), instant_of(local_midnight(F.date_add(day, 1), zone))


def dealt_rank(df: DataFrame, group: str, piece: Column, keys: list[str], name: str) -> DataFrame:
    """dense_rank from 0 of ``keys`` in ``group``, but no task holds a group: ranks inside a piece plus its offset.

    ``piece`` must rise with ``keys``; a group's pieces (seconds of a day, prefixes of an id) are few.
    """
    cut = df.withColumn("_piece", piece)
    sizes = cut.select(group, "_piece", *keys).distinct().groupBy(group, "_piece").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group, "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    at = F.dense_rank().over(Window.partitionBy(group, "_piece").orderBy(*keys)) - 1
    return cut.withColumn("_at", at).join(starts, [group, "_piece"]).withColumn(name, F.col("_start") + F.col("_at")).drop("_piece", "_at", "_start")


def bounded_batches(counts: DataFrame, rows: int, rows_each: int = 2048, max_ids: int = 4096) -> DataFrame:
    """Batches for ``bisect_batches`` of (point_id, n): their number grows with ``rows``, none has over ``max_ids`` ids.

    At most 2 ** max_depth ids a batch are single ids at the last depth, so only an id over the cap is quarantined.
    """
    dealt = counts.withColumn("b", F.pmod(F.xxhash64("point_id"), F.lit(max(64, -(-rows // rows_each)))))
    at = F.row_number().over(Window.partitionBy("b").orderBy("point_id")) - 1
    by = dealt.withColumn("k", F.floor(at / max_ids)).groupBy("b", "k").agg(F.array_sort(F.collect_list(F.struct("point_id", "n"))).alias("x"))
    name = F.concat(F.lit("b"), F.col("b").cast("string"), F.when(F.col("k") > 0, F.concat(F.lit("."), F.col("k").cast("string"))).otherwise(""))
    return by.select(name.alias("batch_id"), F.col("x.point_id").alias("ids"), F.col("x.n").alias("counts"))


def bisect_batches(batches: DataFrame, cap: int, max_depth: int = 12) -> DataFrame:
    """Halve batches of more than ``cap`` rows until none is left or ``max_depth`` is reached.

    ``batches`` are (batch_id, ids array<string>, counts array<bigint>), ids sorted. The loop is over
    levels, not rows. Result: batch_id, ids, depth, n_rows, state (ready, or quarantined where one id
    alone is over the cap or the depth is used up). Each level is written, so that none is computed
    twice, and the loop ends with the first empty one.
    """
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)
    level = batches.select("batch_id", "ids", "counts", F.lit(0).alias("depth"))
    done = None
    for depth in range(max_depth + 1):
        level = materialize(level, f"bisect-{depth}")
        if depth and level.isEmpty():
            break
        sized = level.withColumn("n_rows", total("counts"))
        stuck = (F.size("ids") <= 1) | F.lit(depth == max_depth)
        ready = sized.where((F.col("n_rows") <= cap) | stuck).withColumn("state", F.when(F.col("n_rows") <= cap, "ready").otherwise("quarantined"))
        done = ready if done is None else done.unionByName(ready)
        half = F.floor(F.size("ids") / 2).cast("int")
        cut = lambda c, first: F.slice(c, 1, half) if first else F.slice(c, half + 1, F.size("ids"))
        parts = F.array(*(F.struct(F.concat("batch_id", F.lit(s)).alias("batch_id"), cut("ids", f).alias("ids"), cut("counts", f).alias("counts"), F.lit(depth + 1).alias("depth")) for s, f in (("/0", True), ("/1", False))))
        level = sized.where((F.col("n_rows") > cap) & ~stuck).select(F.inline(parts))
    return done.select("batch_id", F.array_join("ids", ",").alias("ids"), "depth", "n_rows", "state")


def split_batches(batches: DataFrame, cap: int, max_depth: int = 12, min_seconds: int = 60, max_descendants: int = 1 << 14) -> DataFrame:
    """Halve batches of more than ``cap`` rows: their ids while they have several, then their window at its midpoint.

    ``batches`` are (batch_id, window_start, window_end, samples array<struct<id, at>>), a batch's
    samples being bounded by its plan. Result: batch_id, depth, ids, window_start, window_end,
    n_rows, state. ``ready`` batches are within the cap; ``quarantined`` are those of one id whose
    window is shorter than twice ``min_seconds``, at ``max_depth``, or of a root whose halves would
    be more than ``max_descendants``. The loop is over levels, not rows; each level is written, and
    the loop ends with the first empty one.
    """
    root = F.split_part(_c("batch_id"), F.lit("/"), F.lit(1))
    ids = F.array_sort(F.array_distinct(F.transform("samples", lambda x: x.id)))
    level = batches.select("batch_id", "window_start", "window_end", "samples", ids.alias("ids"), F.lit(0).alias("depth"))
    done, made = [], None
    for depth in range(max_depth + 1):
        level = materialize(level, f"split-{depth}")
        if level.isEmpty():
            break
        sized = level.withColumn("n_rows", F.size("samples").cast("long"))
        over = _c("n_rows") > cap
        short = (F.size("ids") <= 1) & (F.unix_micros(instant_of(_c("window_end"))) - F.unix_micros(instant_of(_c("window_start"))) < 2_000_000 * min_seconds)
        here = sized.where(over).groupBy(root.alias("root")).agg((2 * F.count("*")).alias("made"))
        made = here if made is None else made.unionByName(here).groupBy("root").agg(F.sum("made").alias("made"))
        made = materialize(made, f"descendants-{depth}")
        full = made.where(_c("made") > max_descendants).select(_c("root"), F.lit(True).alias("full"))
        told = sized.withColumn("root", root).join(full, "root", "left").withColumn("stuck", over & (short | F.coalesce("full", F.lit(False)) | F.lit(depth == max_depth)))
        told = materialize(told, f"told-{depth}")
        done.append(told.where(~(_c("n_rows") > cap) | _c("stuck")).withColumn("state", F.when(_c("stuck"), "quarantined").otherwise("ready")))
        half = F.floor(F.size("ids") / 2).cast("int")
        middle = F.timestamp_micros(F.floor((F.unix_micros(instant_of(_c("window_start"))) + F.unix_micros(instant_of(_c("window_end")))) / 2))
        middle = utc_clock(middle)
        by_id = F.size("ids") > 1

        def part(which: int):
            own = F.when(by_id, F.slice("ids", 1, half) if which == 0 else F.slice("ids", half + 1, F.size("ids"))).otherwise(_c("ids"))
            inside = lambda x: F.when(by_id, F.array_contains(own, x.id)).otherwise(x.at < _c("middle") if which == 0 else x.at >= _c("middle"))
            start = _c("window_start") if which == 0 else F.when(by_id, _c("window_start")).otherwise(_c("middle"))
            end = F.when(by_id, _c("window_end")).otherwise(_c("middle")) if which == 0 else _c("window_end")
            return F.struct(F.concat("batch_id", F.lit(f"/{which}")).alias("batch_id"), start.alias("window_start"), end.alias("window_end"), F.filter("samples", inside).alias("samples"), own.alias("ids"), F.lit(depth + 1).alias("depth"))

        level = told.where(~_c("stuck") & (_c("n_rows") > cap)).withColumn("middle", middle).select(F.inline(F.array(part(0), part(1))))
    out = done[0] if done else level.withColumn("n_rows", F.lit(0).cast("long")).withColumn("state", F.lit(""))
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("batch_id", "depth", "ids", "window_start", "window_end", "n_rows", "state")
