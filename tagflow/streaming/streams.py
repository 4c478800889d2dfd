"""Tumbling counts, deduplication, landed pages, merges, coverage and cursors over a file stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tagflow.operators.store import HistoryStore
from tagflow.operators.validators import NAMED, fold, settled
from tagflow.sources.files import PAGE, RECEIPT, WINDOWED, landed_samples, receipts_of
from tagflow.tables import materialize


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A file stream over Parquet; times become instants, as watermarks need."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{folder}/{name}.parquet*")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def stream_tumbling(events: DataFrame, lag: str = "5 minutes", size: str = "5 minutes") -> DataFrame:
    """Counts by window and kind; the watermark is the source's lag."""
    w = F.window("ts", size)
    return events.withWatermark("ts", lag).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "event_type", "n")


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_dedup(feed: DataFrame, key: str, at: str, lag: str = "5 minutes") -> DataFrame:
    """The first delivery of each key; another one within ``lag`` of event time is left out, null keys count as one.

    State holds every key of ``lag``, so it is kept on disk: the session's state store is set to RocksDB, all of an executor's
    in one memory of a bounded size.
    """
    feed.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    feed.sparkSession.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    return feed.withWatermark(at, lag).dropDuplicatesWithinWatermark([key])


def stream_pages(spark: SparkSession, folder: str, names: str = "*.json", lines: bool = False) -> DataFrame:
    """Landed grids as they come, one row a file, or with ``lines`` one row a line of files that hold many: path, meta, cols, rows."""
    pages = spark.readStream.schema(PAGE).option("multiLine", not lines).option("pathGlobFilter", names).json(folder)
    return pages.withColumn("path", F.col("_metadata.file_path"))


def pages_into(plan: DataFrame, root: str, validator: str = "history_window_coverage", samples: Callable[[DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """For ``stream_merge`` over ``stream_pages``: each landed history page judged against a static plan, good batches' samples let through.

    A micro-batch judges the planned batches whose pages are in it, by the named validators; a page of
    no planned batch is ``unplanned``. Verdicts go to ``verdicts`` and samples of good batches to
    ``rows`` below ``root``, in a folder of the micro-batch's number that is replaced as a whole, so one
    that is run again gives the same; with ``samples`` they are handed on instead, as to ``merge_into``.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        pages = materialize(receipts_of(batch, RECEIPT | WINDOWED), "pages").withColumnsRenamed({"site": "site_ref", "requested_ids": "requested", "completed_ids": "completed"})
        here = pages.select("batch_id").distinct()
        own = plan.join(here, "batch_id", "left_semi")
        columns = pages.select("batch_id", F.explode("cols").alias("c")).select("batch_id", F.col("c.name").alias("name"), F.try_variant_get("c.meta", "$.id", "string").alias("point_id"))
        rows = materialize(landed_samples(pages), "samples")
        judged = fold(own, NAMED[validator], {"plan": own, "pages": pages, "columns": columns, "rows": rows})
        stray = here.join(plan.select("batch_id"), "batch_id", "left_anti").select("batch_id", F.lit(False).alias("ok"), F.lit("unplanned").alias("reason"))
        verdicts = materialize(judged.unionByName(stray), "verdicts")
        good, _ = settled(rows, verdicts)
        if samples:
            samples(good, batch_id)
        else:
            good.write.mode("overwrite").parquet(f"{root}/rows/put={batch_id}")
        verdicts.write.mode("overwrite").parquet(f"{root}/verdicts/put={batch_id}")

    return apply


def stream_merge(staged: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str):
    """Run ``apply(batch, batch_id)`` on each micro-batch; applying a batch id twice must change nothing."""
    return staged.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_into(store: HistoryStore) -> Callable[[DataFrame, int], None]:
    """For ``stream_merge``: batches of samples merged into a store, a micro-batch as the put of its number.

    A micro-batch that is run again after a failure gives the same. Late or corrected samples become
    revisions; the base is never changed, and only the days that are staged are read.
    """
    return lambda batch, batch_id: store.put(batch, batch_id) and None


def stream_coverage(returned: DataFrame, batches: DataFrame, size: str = "5 minutes", lag: str = "5 minutes") -> DataFrame:
    """Windows' batches once the watermark has passed them: the ids seen, and whether all requested ones were.

    ``returned`` streams (batch_id, id, ts); ``batches`` holds (batch_id, scope_ids), a batch's ids being bounded by its plan.
    A row with a null id announces a batch, so that one of which nothing comes back is told as well.
    """
    seen = returned.withWatermark("ts", lag).groupBy(F.window("ts", size).alias("w"), "batch_id").agg(F.collect_set("id").alias("ids"))
    missing = F.size(F.array_except("scope_ids", "ids"))
    return seen.join(batches, "batch_id").select("batch_id", F.col("w.start").alias("window_start"), F.size("ids").alias("n_seen"), missing.alias("n_missing"), (missing == 0).alias("complete"))


class Cursor(StatefulProcessor):
    """A site's cursor (value state) and the stretches of windows that wait behind a gap (list state).

    A timer runs while stretches wait: it is set anew whenever the cursor moves, and tells of a site
    whose cursor has stood for ``wait_ms`` of event time behind a gap.
    """

    def __init__(self, baseline: int, wait_ms: int):
        self.baseline, self.wait_ms = baseline, wait_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.through, self.waiting = handle.getValueState("through", "through long"), handle.getListState("waiting", "first long, last long")

    def _at(self) -> int:
        return self.through.get()[0] if self.through.exists() else self.baseline

    def _told(self, key: tuple, through: int, gaps: int, stuck: bool) -> pd.DataFrame:
        return pd.DataFrame({"site_ref": [key[0]], "through": [through], "gaps": [gaps], "stuck": [stuck]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before, new, last = self._at(), set(), 0
        for f in rows:
            new |= {int(w) for w in f["window_no"]}
            last = max(last, int(f["at"].max().timestamp() * 1000))
        waited = [(a, b) for a, b in self.waiting.get()] if self.waiting.exists() else []
        through, merged = before, []
        for a, b in sorted([*waited, *((w, w) for w in new)]):
            if merged and a <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        waiting = []
        for a, b in merged:
            if a <= through + 1:
                through = max(through, b)
            else:
                waiting.append((a, b))
        if through > before:
            self.through.update((through,))
        self.waiting.put(waiting) if waiting else self.waiting.clear()
        timers = [x if isinstance(x, int) else x[0] for x in self.handle.listTimers()]
        if timers and (through > before or not waiting):
            for t in timers:
                self.handle.deleteTimer(t)
            timers = []
        if waiting and not timers:
            self.handle.registerTimer(last + self.wait_ms)
        if through > before:
            yield self._told(key, through, len(waiting), False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.waiting.exists():
            yield self._told(key, self._at(), len(list(self.waiting.get())), True)

    def close(self) -> None:
        pass


def stream_checkpoint(certified: DataFrame, baseline: int = -1, wait_seconds: int = 3600, lag: str = "5 minutes") -> DataFrame:
    """(site_ref, through, gaps, stuck) whenever a site's cursor moves over windows without a gap, and once it is stuck behind one.

    ``certified`` streams (site_ref, window_no, at), ``at`` being when a window was certified; rows that come
    more than ``lag`` after later ones are late and left out. The cursor never goes back. State by site: the
    cursor, and the stretches of windows that wait behind a gap, so it grows with the gaps and not with
    the windows. Windows that come again, or lie at or before the cursor, change nothing; null windows
    and times are left out. The session's state store is set to RocksDB, which stateful processors need.
    """
    certified.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows = certified.select("site_ref", F.col("window_no").cast("long").alias("window_no"), "at").where("window_no IS NOT NULL AND at IS NOT NULL").withWatermark("at", lag)
    return rows.groupBy("site_ref").transformWithStateInPandas(Cursor(baseline, 1000 * wait_seconds), "site_ref string, through long, gaps long, stuck boolean", "Append", "EventTime")
