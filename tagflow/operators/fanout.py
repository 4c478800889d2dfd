"""Fan-out of a small real site to many virtual ones, and the audit of the result.

A real site's sorted entities are dealt out in turn, so n virtual entities use them evenly. Ids are
``<site>.e<i>.<real>`` and ``<site>.e<i>.p<j>.<real>``, the indices padded to the width of the last.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagflow.operators.rollup import chunks
from tagflow.plans.planning import dealt_rank
from tagflow.sqlops import operator
from tagflow.tables import brief_shuffles, folders, materialize, measured, setting

_c = F.col
#: Rule days that a spine may have: a century's.
MOST_DAYS = 36_525


def _turns(real: DataFrame) -> DataFrame:
    """(site_ref, id, i, n): position in the site by id, and the site's size."""
    by = Window.partitionBy("site_ref")
    return real.select("site_ref", "id", (F.row_number().over(by.orderBy("id")) - 1).alias("i"), F.count("*").over(by).alias("n"))


@operator
def replicate_equipment(real_equipment, n=400):
    """``n`` virtual equipment by site, the real ones in turn: virtual_id, site_ref, i, source_id."""
    slots = _turns(real_equipment).withColumn("at", F.explode(F.sequence("i", F.lit(n - 1), "n")))
    # a real entity beyond the n-th is not used; ``sequence`` would count down there
    slots = slots.where(_c("i") < n)
    virtual = F.concat("site_ref", F.lit(".e"), F.lpad(_c("at").cast("string"), len(str(n - 1)), "0"), F.lit("."), "id")
    return slots.where(_c("at") < n).select(virtual.alias("virtual_id"), "site_ref", _c("at").cast("long").alias("i"), _c("id").alias("source_id"))


@operator
def replicate_points(virtual, real_points, m=10, n=400):
    """``m`` virtual points under each virtual equipment: the site's historised points in turn, by (i * m + p) mod N."""
    own = _turns(real_points.select("site_ref", "id")).select("site_ref", _c("id").alias("real"), _c("i").alias("k"), "n")
    sizes = own.groupBy("site_ref").agg(F.max("n").alias("n"))
    slots = virtual.join(sizes, "site_ref").withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(m - 1)))).withColumn("k", ((_c("i") * m + _c("p")) % _c("n")).cast("int"))
    point = F.concat("site_ref", F.lit(".e"), F.lpad(_c("i").cast("string"), len(str(n - 1)), "0"), F.lit(".p"), F.lpad(_c("p").cast("string"), len(str(m - 1)), "0"), F.lit("."), "real")
    return slots.drop("n").join(own.drop("n"), ["site_ref", "k"]).select(point.alias("virtual_point"), _c("virtual_id").alias("parent"), "site_ref", _c("real").alias("source_id"))


def real_id(site, virtual, points: bool = False):
    """Column: the real id inside a virtual one of ``site``, null where it is not one of that site."""
    rest = F.when(F.startswith(virtual, F.concat(site, F.lit("."))), F.substring(virtual, F.length(site) + 2, F.lit(1 << 30)))
    shape = r"^e\d+\.p\d+\.(.+)$" if points else r"^e\d+\.(.+)$"
    real = F.regexp_extract(rest, shape, 1)
    return F.when(real != "", real)


@operator
def real_ids(asked):
    """The real ids inside the virtual points asked of sites, each with how many read it; ids of another site are rejected."""
    real = real_id(_c("site_ref"), _c("virtual_point"), points=True)
    return asked.groupBy(F.coalesce(real, F.lit("rejected")).alias("real_id")).agg(F.count("*").alias("copies"))


@operator
def fan_out_history(virtual_points, history):
    """The samples of each real point copied to every virtual one by one join: virtual_point, observed_at, value_kind."""
    own = history.select(_c("point_id").alias("source_id"), "observed_at", "value_kind", "row_no")
    return virtual_points.select("virtual_point", "source_id").join(own, "source_id").select("virtual_point", "observed_at", "value_kind", "row_no")


@operator
def fan_out_totals(virtual_points, history):
    """Samples by virtual point without copying them: counted by real point first, then joined."""
    own = history.groupBy(_c("point_id").alias("source_id")).agg(F.count("*").alias("samples"), F.max("observed_at").alias("last_at"))
    return virtual_points.select("virtual_point", "source_id").join(own, "source_id").select("virtual_point", "samples", "last_at")


@operator
def fan_out_rules(virtual, detections):
    """Detections on each virtual equipment, with the real one they are from; repeats are counted before they are copied."""
    own = detections.groupBy(_c("targetRef").alias("source_id"), "ruleRef", "rule_date").agg(F.count("*").alias("n"))
    return virtual.select("virtual_id", "source_id").join(own, "source_id").select(_c("virtual_id").alias("targetRef"), "ruleRef", "rule_date", _c("source_id").alias("replicaSourceRef"), "n")


def five_minutes(at):
    """Column: the start of the five-minute window of ``at``."""
    at = F.col(at) if isinstance(at, str) else at
    return at - F.make_dt_interval(mins=F.minute(at) % 5, secs=F.date_part(F.lit("SECOND"), at))


def _sampled(history: DataFrame, start, windows: int) -> DataFrame:
    """(id, window_start, n, ordered) of the five-minute windows that have samples; ``ordered`` are these as JSON."""
    end = start + F.make_dt_interval(mins=F.lit(5 * windows))
    own = history.where((_c("observed_at") >= start) & (_c("observed_at") < end)).groupBy("point_id", five_minutes("observed_at").alias("window_start"))
    own = own.agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("observed_at", "row_no", "value_kind"))).alias("rows"))
    return own.select(_c("point_id").alias("id"), "window_start", "n", F.to_json(F.transform("rows", lambda r: F.struct(r.row_no.alias("row"), r.value_kind.alias("kind")))).alias("ordered"))


@operator
def hour_coverage(points, history, hour="2024-01-03 10:00:00", windows=12):
    """Every accepted point in each five-minute window of an hour: coverage, samples, and these in order as JSON."""
    start = F.lit(hour).cast("timestamp_ntz")
    sampled = _sampled(history, start, windows)
    each = F.transform(F.sequence(F.lit(0), F.lit(windows - 1)), lambda k: start + F.make_dt_interval(mins=k * 5))
    spine = points.where("outcome = 'accepted'").select("id", "historized", F.explode(each).alias("window_start"))
    coverage = F.when(~_c("historized"), "not_historized").when(_c("n").isNull(), "no_observation").otherwise("observed")
    return spine.join(sampled, ["id", "window_start"], "left").select(_c("id").alias("point_id"), "window_start", coverage.alias("coverage"), F.coalesce("n", F.lit(0)).cast("long").alias("samples"), "ordered")


@operator
def coverage_audit(points, history, coverage, hour="2024-01-03 10:00:00", windows=12):
    """Rows, observed windows and samples produced by window, against what the source's own rows give.

    The expectation counts the source: accepted points from their outcomes, samples of historised ones from history.
    """
    start = F.lit(hour).cast("timestamp_ntz")
    accepted = points.where("outcome = 'accepted'")
    total = accepted.agg(F.count("*").alias("expected"))
    own = history.where((_c("observed_at") >= start) & (_c("observed_at") < start + F.make_dt_interval(mins=F.lit(5 * windows))))
    known = accepted.where("historized").select(_c("id").alias("point_id"))
    per = own.join(known, "point_id", "left_semi").groupBy(five_minutes("observed_at").alias("window_start")).agg(F.count("*").alias("expected_samples"), F.count_distinct("point_id").alias("expected_observed"))
    made = coverage.groupBy("window_start").agg(F.count("*").alias("produced"), F.sum(F.when(_c("coverage") == "observed", _c("samples")).otherwise(0)).alias("samples"), F.count_if(_c("coverage") == "observed").alias("observed"))
    df = made.join(per, "window_start", "left").fillna(0, ["expected_samples", "expected_observed"]).crossJoin(F.broadcast(total))
    good = (_c("produced") == _c("expected")) & (_c("samples") == _c("expected_samples")) & (_c("observed") == _c("expected_observed"))
    return df.select("window_start", "produced", "expected", "samples", "expected_samples", F.when(good, "PASS").otherwise("FAIL").alias("verdict"))


@operator
def replica_audit(virtual, real_equipment, n=400):
    """Copies of each real equipment against the rule: full turns, and one more for the first of the rest."""
    made = virtual.groupBy("site_ref", "source_id").agg(F.count("*").alias("produced"))
    turns = _turns(real_equipment).select("site_ref", _c("id").alias("source_id"), (F.floor(F.lit(n) / _c("n")) + (_c("i") < F.lit(n) % _c("n")).cast("int")).cast("long").alias("expected"))
    df = turns.join(made, ["site_ref", "source_id"], "full").fillna(0, ["produced", "expected"])
    return df.select("site_ref", "source_id", "produced", "expected", F.when(_c("produced") == _c("expected"), "PASS").otherwise("FAIL").alias("verdict"))


@operator
def site_group_batches(virtual, size=30, groups=2):
    """Batches of a fixed size in a copy's group of each site; the sizes add up to the target."""
    grouped = virtual.withColumn("copy", (_c("i") % groups).cast("int")).withColumn("grp", F.concat_ws("/", "site_ref", "copy"))
    return chunks(grouped.select("grp", "virtual_id"), "grp", "virtual_id", size).groupBy("grp", "batch_no").agg(F.count("*").alias("n"), F.min("virtual_id").alias("first_id"))


@operator
def rule_scope_coverage(entities, detections):
    """Every equipment on each rule day, with its detections or none. The distinct days are one list, of at most MOST_DAYS."""
    found = detections.groupBy(_c("targetRef").alias("source_id"), "rule_date").agg(F.count("*").alias("n"))
    days = found.agg(F.array_sort(F.collect_set("rule_date")).alias("d"))
    few = days.select(F.when(F.size("d") <= MOST_DAYS, _c("d")).otherwise(F.raise_error(F.lit("too many days")).cast("array<date>")).alias("d"))
    spine = entities.select("source_id").crossJoin(few).select("source_id", F.explode("d").alias("rule_date"))
    return spine.join(found, ["source_id", "rule_date"], "left").select("source_id", "rule_date", F.coalesce("n", F.lit(0)).cast("long").alias("detections"), F.when(_c("n").isNull(), "none").otherwise("attached").alias("queried"))


@operator
def entity_fan_out(virtual, entities):
    """Metadata copies with where they are from."""
    own = entities.select("source_id", "payload")
    return virtual.join(own, "source_id").select("virtual_id", "payload", _c("source_id").alias("provenance"))


def fan_out_feeds(real_equipment: DataFrame, real_points: DataFrame, history: DataFrame, detections: DataFrame, out: str, n: int, m: int, window: str) -> dict[str, DataFrame]:
    """All three feeds of ``n`` virtual equipment by site with ``m`` points each, written as Parquet below ``out``.

    Tables: equipment and points (metadata), history (each point in the five-minute window that starts
    at ``window``, observed or not), rules (each equipment on the latest rule day, with how many
    detections) and detections. Real samples and detections are counted before they are copied, and
    the real side of every join is small, so no virtual row is shuffled.
    """
    spark = real_points.sparkSession
    shapes = {"equipment": "virtual_id string, site_ref string, i long, source_id string", "points": "virtual_point string, parent string, site_ref string, source_id string"}

    def kept(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{out}/{name}")
        return spark.read.schema(shapes.get(name, df.schema)).parquet(f"{out}/{name}")

    made = {"equipment": kept("equipment", replicate_equipment(real_equipment=real_equipment, n=n))}
    made["points"] = kept("points", replicate_points(virtual=made["equipment"], real_points=real_points, m=m, n=n))
    start = F.lit(window).cast("timestamp_ntz")
    own = history.where((_c("observed_at") >= start) & (_c("observed_at") < start + F.make_dt_interval(mins=F.lit(5)))).groupBy(_c("point_id").alias("source_id")).agg(F.count("*").alias("samples"), F.max_by("value_kind", "observed_at").alias("last_kind"))
    covered = made["points"].select("virtual_point", "source_id").join(own, "source_id", "left")
    made["history"] = kept("history", covered.select("virtual_point", start.alias("window_start"), F.when(_c("samples").isNull(), "no_observation").otherwise("observed").alias("coverage"), F.coalesce("samples", F.lit(0)).cast("long").alias("samples"), "last_kind"))
    day = detections.agg(F.max("rule_date").alias("rule_date"))
    latest = detections.join(F.broadcast(day), "rule_date")
    made["detections"] = kept("detections", fan_out_rules(virtual=made["equipment"], detections=latest))
    counts = latest.groupBy(_c("targetRef").alias("source_id")).agg(F.count("*").alias("detections"))
    asked = made["equipment"].select("virtual_id", "source_id").crossJoin(F.broadcast(day)).join(counts, "source_id", "left")
    made["rules"] = kept("rules", asked.select("virtual_id", "rule_date", F.coalesce("detections", F.lit(0)).cast("long").alias("detections")))
    return made


SHARD = "virtual_point string, copy long, site_ref string, source_id string, window_start string, window_end string, status string, samples long, ordered string"
#: Real points by window that a fan-out broadcasts, at most; with more it joins by shuffle.
BROADCAST_REAL, BROADCAST_BYTES = 500_000, 64 << 20
#: Rows that a task puts in order, about, where virtual rows are shuffled; a shard is never cut.
TASK_ROWS = 500_000


def _real_points(points: DataFrame, history: DataFrame, hour: str, windows: int) -> DataFrame:
    """(seed, site_ref, id, historized, seen) of accepted points; seeds are positions by site and id, ``seen`` maps windows to their samples' n and order."""
    real = points.where("outcome = 'accepted'").select(_c("siteRef").alias("site_ref"), "id", "historized").withColumn("all", F.lit(1))
    seeds = dealt_rank(real, "all", F.concat_ws("/", "site_ref", F.substring("id", 1, 5)), ["site_ref", "id"], "seed").drop("all")
    start = F.lit(hour).cast("timestamp_ntz")
    own = _sampled(history, start, windows).withColumn("w", F.floor(F.timestamp_diff("MINUTE", start, _c("window_start")) / 5).cast("int"))
    own = own.where(_c("window_start") == start + F.make_dt_interval(mins=_c("w") * 5))
    seen = own.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("w", F.struct("n", "ordered")))).alias("seen"))
    return seeds.join(seen, "id", "left").select("seed", "site_ref", "id", "historized", "seen")


def _in_windows(real: DataFrame, each) -> DataFrame:
    """``real`` points in windows ``each``: historized and seen become w, status, samples and ordered."""
    rows = real.withColumn("w", F.explode(each)).withColumn("s", F.when(_c("historized"), _c("seen")[_c("w")]))  # what a point that is not historised has was not asked for
    status = F.when(~_c("historized"), "not_historized").when(_c("s").isNull(), "no_observation").otherwise("observed")
    return rows.withColumns({"status": status, "samples": F.coalesce("s.n", F.lit(0)).cast("long"), "ordered": _c("s.ordered")}).drop("historized", "seen", "s")


def _all_windows(windows: int):
    return F.sequence(F.lit(0), F.lit(windows - 1))


def _real_windows(points: DataFrame, history: DataFrame, hour: str, windows: int) -> DataFrame:
    """(seed, site_ref, id, w, status, samples, ordered) of accepted points by window; seeds are positions by site and id."""
    return _in_windows(_real_points(points, history, hour, windows), _all_windows(windows))


def hour_fan_out(points: DataFrame, history: DataFrame, out: str, target: int, hour: str, windows: int = 12, shard_rows: int = 500_000) -> DataFrame:
    """``target`` virtual points in each window of an hour, as gzip CSV shards of at most ``shard_rows`` rows by window below ``out``; the audit is returned.

    Virtual point i copies real point i mod N, so real points are dealt out in turn, copy after copy.
    A task makes one shard, in the order of its points, from a range and a table of real points by
    window, which is broadcast behind a check of its size; so no virtual row is shuffled. With a larger
    table the copies of real points are shuffled, without their windows: a task puts several whole shards
    in order, of about ``TASK_ROWS`` rows together, and writes them in all windows, or where shards are so
    long that these were too many rows, in some. Tasks grow with the rows, and not with the shards, and a
    copy is once on disk, not once a window.
    """
    spark = points.sparkSession
    real = materialize(_real_points(points, history, hour, windows), "real-points", drop_shuffles=True)
    listed = F.coalesce(F.octet_length(F.to_json(F.map_values("seen"))), F.lit(0))
    size = real.agg((F.count("*") * windows).alias("rows"), F.count_distinct("seed").alias("n"), F.coalesce(F.sum(listed + 100 * windows), F.lit(0)).alias("bytes")).first()
    if not size.n or target < 1:
        raise ValueError("there is no point to copy, or no copy to make")
    shards = -(-target // shard_rows)
    if size.rows <= BROADCAST_REAL and size.bytes <= BROADCAST_BYTES:
        index = F.explode(F.sequence(_c("k") * shard_rows, F.least((_c("k") + 1) * shard_rows, F.lit(target)) - 1))
        each = spark.range(0, windows * shards, 1, windows * shards).select(F.floor(_c("id") / shards).cast("int").alias("w"), (_c("id") % shards).alias("k")).select("w", index.alias("i"))
        virtual = each.select("w", "i", (_c("i") % size.n).alias("seed"))
        both = virtual.join(F.broadcast(_in_windows(real, _all_windows(windows))), ["w", "seed"])
    else:
        tasks = min(windows * shards, -(-windows * target // TASK_ROWS))
        groups = -(-tasks // shards)  # of windows, each a task's; at most as many as there are windows
        copies = real.where(_c("seed") < target).withColumn("i", F.explode(F.sequence("seed", F.lit(target - 1).cast("long"), F.lit(size.n).cast("long"))))
        if groups > 1:
            copies = copies.withColumn("g", F.explode(_all_windows(groups)))
        else:
            copies = copies.withColumn("g", F.lit(0))
        own = copies.drop("seed").repartition(tasks, "g", F.floor(_c("i") / shard_rows)).sortWithinPartitions("i")
        both = _in_windows(own, F.sequence("g", F.lit(windows - 1), F.lit(groups)))
    start = F.lit(hour).cast("timestamp_ntz")
    at = lambda k: F.date_format(start + F.make_dt_interval(mins=k * 5), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    copy = F.floor(_c("i") / size.n)
    name = F.concat(F.lit("c"), F.lpad(copy.cast("string"), 6, "0"), F.lit("."), "id")
    rows = both.select(name.alias("virtual_point"), copy.alias("copy"), "site_ref", _c("id").alias("source_id"), at(_c("w")).alias("window_start"), at(_c("w") + 1).alias("window_end"), "status", "samples", F.coalesce("ordered", F.lit("[]")).alias("ordered"), "w")
    # a writer open by window, so that the rows, which are in order, are not sorted by window again
    with brief_shuffles(spark), setting(spark, "spark.sql.maxConcurrentOutputFileWriters", windows):
        rows.write.partitionBy("w").options(header=True, compression="gzip", maxRecordsPerFile=shard_rows, escape='"').csv(out)
    return hour_audit(_in_windows(real, _all_windows(windows)), out, target, windows, shard_rows)


def hour_audit(real: DataFrame, out: str, target: int, windows: int = 12, shard_rows: int = 500_000) -> DataFrame:
    """What ``hour_fan_out`` wrote, read back, against what the real points by window give: one row a window, PASS or FAIL.

    Real point ``seed`` has target div N copies, and one more if it is among the first target mod N. Windows are
    read one after the other, so that the driver holds the names of one window's shards at a time, and a row of each.
    """
    spark, n, told = real.sparkSession, lambda s: F.count_if(_c("status") == s), []
    for folder in folders(spark, out):
        back = spark.read.options(header=True, escape='"').schema(f"{SHARD}, w int").option("basePath", out).csv(f"{out}/{folder}")
        files = back.groupBy("w", F.input_file_name().alias("file")).agg(F.count("*").alias("rows"), n("observed").alias("observed"), n("not_historized").alias("not_historized"), F.sum("samples").alias("samples"), F.count_if(F.get_json_object("ordered", "$[0]").isNotNull()).alias("listed"))
        told += files.groupBy("w").agg(F.count("*").alias("shards"), F.max("rows").alias("largest"), *(F.sum(c).alias(c) for c in ("rows", "observed", "not_historized", "samples", "listed"))).collect()
    made = spark.createDataFrame(told, "w int, shards long, largest long, rows long, observed long, not_historized long, samples long, listed long")
    total = real.agg(F.count_distinct("seed").alias("n"))
    copies = F.floor(F.lit(target) / _c("n")) + (_c("seed") < F.lit(target) % _c("n")).cast("long")
    own = real.crossJoin(F.broadcast(total)).withColumn("copies", copies)  # a single aggregate
    want = own.groupBy("w").agg(F.sum("copies").alias("want_rows"), F.sum(F.when(_c("status") == "observed", _c("copies")).otherwise(0)).alias("want_observed"), F.sum(F.when(_c("status") == "not_historized", _c("copies")).otherwise(0)).alias("want_not_historized"), F.sum(F.when(_c("status") == "observed", _c("copies") * _c("samples")).otherwise(0)).alias("want_samples"))
    every = spark.range(windows).select(_c("id").cast("int").alias("w")).join(want, "w", "left").join(made, "w", "left").fillna(0)
    good = (_c("rows") == target) & (_c("rows") == _c("want_rows")) & (_c("observed") == _c("want_observed")) & (_c("listed") == _c("observed")) & (_c("not_historized") == _c("want_not_historized")) & (_c("samples") == _c("want_samples")) & (_c("largest") <= shard_rows) & (_c("shards") >= -(-target // shard_rows))
    return every.select("w", "rows", "shards", "observed", "not_historized", (_c("rows") - _c("observed") - _c("not_historized")).alias("no_observation"), "samples", F.when(good, "PASS").otherwise("FAIL").alias("verdict"))


def shard_feeds(made: dict[str, DataFrame], real_points: DataFrame, out: str, n: int, m: int, shard_rows: int = 500_000) -> DataFrame:
    """``fan_out_feeds``'s tables as gzip CSV shards below ``out``, read back and audited: feed, rows, expected, shards, largest, verdict.

    Expected are ``n`` equipment a site with ``m`` points each, a row of history a point, a row of rules an
    equipment, and the detections that the rules' rows tell of.
    """
    spark, told = real_points.sparkSession, None
    for name, df in made.items():
        df.write.options(header=True, compression="gzip", maxRecordsPerFile=shard_rows).csv(f"{out}/{name}")
        back = spark.read.option("header", True).schema(", ".join(f"{c} string" for c in df.columns)).csv(f"{out}/{name}")
        one = back.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("rows"), F.count(df.columns[0]).alias("named")).agg(F.sum("rows").alias("rows"), F.sum("named").alias("named"), F.count("*").alias("shards"), F.max("rows").alias("largest")).withColumn("feed", F.lit(name))
        told = one if told is None else told.unionByName(one)
    sites = made["equipment"].select("site_ref").distinct().agg(F.count("*").alias("sites"))
    pointed = real_points.select("site_ref").distinct().join(made["equipment"].select("site_ref").distinct(), "site_ref").agg(F.count("*").alias("pointed"))
    found = made["rules"].where("detections > 0").select("virtual_id").join(made["detections"].groupBy(_c("targetRef").alias("virtual_id")).agg(F.count("*").alias("kinds")), "virtual_id").agg(F.coalesce(F.sum("kinds"), F.lit(0)).alias("found"))
    df = told.crossJoin(sites).crossJoin(pointed).crossJoin(found)  # single aggregates
    expected = F.when(_c("feed").isin("equipment", "rules"), _c("sites") * n).when(_c("feed").isin("points", "history"), _c("pointed") * n * m).otherwise(_c("found"))
    good = (_c("rows") == _c("expected")) & (_c("named") == _c("rows")) & (_c("largest") <= shard_rows)
    return df.withColumn("expected", expected).select("feed", "rows", "expected", "shards", "largest", F.when(F.coalesce(good, F.lit(False)) | ((_c("expected") == 0) & (F.coalesce("rows", F.lit(0)) == 0)), "PASS").otherwise("FAIL").alias("verdict"))
