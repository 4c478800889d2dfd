"""The guard before a write: what rows and receipts carry is computed once more.

Rows carry their hash, receipts the batch's key, which ends in the checksum of the batch's canonical
lines in order. Each guard names the first difference: the rows' scope, their identity, a key twice,
a row's hash, the caps, the batch's key. Lines go through a batch's checksum in order and one at a
time, so no task holds a batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.functions.normalize import canonical, detection_key, instant_with_zone, observation_line, utc_clock
from tagflow.operators.coverage import first_fault
from tagflow.sqlops import operator
from tagflow.tables import tasks

_c = F.col
ENTITY_FIELDS = ("kind", "source_id", "site_ref", "equipment_ref", "historized", "payload")
NO_FAULT = 1 << 30
DIGEST = pa.schema({"batch_id": pa.string(), "n_rows": pa.int64(), "n_bytes": pa.int64(), "checksum": pa.string(), "fault": pa.int32(), "differs": pa.bool_(), "twice": pa.bool_()})


def lined(rows: DataFrame, feed: str) -> DataFrame:
    """``rows`` of a feed with ``line``, their canonical JSON, and ``place``, by which a batch is ordered and each row is one."""
    if feed == "history":
        return rows.withColumns({"line": observation_line(rows), "place": F.struct("point_id", "observed_at")})
    if feed == "metadata":
        return rows.withColumns({"line": canonical(**{k: _c(k) for k in ENTITY_FIELDS}), "place": F.struct("kind", "source_id")})
    if feed == "rules":
        fields = ("detection_key", "equipment_id", "rule_id", "severity", "spark")
        return rows.withColumns({"line": canonical(**{k: _c(k) for k in fields}, source_date=_c("source_date").cast("string")), "place": F.struct("detection_key")})
    raise ValueError(f"no feed {feed}")


def _repeats(column: pa.Array) -> np.ndarray:
    """Whether each row equals the one before; nulls are equal."""
    here, before = column.slice(1), column.slice(0, max(0, len(column) - 1))
    same = pc.or_(pc.fill_null(pc.equal(here, before), False), pc.and_(pc.is_null(here), pc.is_null(before)))
    return np.concatenate([[False], same.to_numpy(zero_copy_only=False)]).astype(bool)


def _digests(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of batch and place become one a batch; lines go through the hash as they come, so no batch is held."""
    own, last = None, None
    for part in (p for p in parts if p.num_rows):
        ids, place, lines = part.column("batch_id"), part.column("place"), part.column("line").cast(pa.large_binary())
        ends = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
        data = memoryview(lines.buffers()[2] or b"")
        repeats = _repeats(ids)
        again = np.logical_and.reduce([repeats, *map(_repeats, place.flatten())])
        starts = np.flatnonzero(~repeats)
        faults = np.minimum.reduceat(part.column("fault").to_numpy(), starts)
        differs, twice = (np.logical_or.reduceat(x, starts) for x in (part.column("differs").to_numpy(zero_copy_only=False).astype(bool), again))
        done = []
        for k, (i, j) in enumerate(zip(starts, [*starts[1:], len(lines)], strict=True)):
            name = ids[int(i)].as_py()
            if own is None or k or name != own["batch_id"]:
                done += [own] if own else []
                own, last = {"batch_id": name, "n_rows": 0, "n_bytes": 0, "checksum": hashlib.sha256(), "fault": NO_FAULT, "differs": False, "twice": False}, None
            own["checksum"].update(data[ends[i] : ends[j]])
            own["n_rows"] += int(j - i)
            own["n_bytes"] += int(ends[j] - ends[i])
            own["fault"] = min(own["fault"], int(faults[k]))
            own["differs"] |= bool(differs[k])
            own["twice"] |= bool(twice[k]) or (last is not None and last == place[int(i)].as_py())
            last = place[int(j) - 1].as_py()
        yield _told(done)
    yield _told([own] if own else [])


def _told(done: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{**x, "checksum": x["checksum"].hexdigest()} for x in done], DIGEST)


def digests(rows: DataFrame, n: int) -> DataFrame:
    """(batch_id, n_rows, n_bytes, checksum, fault, differs, twice) of rows (batch_id, place, line, fault, differs): one shuffle to ``n`` tasks and one sort."""
    own = rows.select("batch_id", "place", "line", "fault", "differs").repartition(n, "batch_id").sortWithinPartitions("batch_id", "place", "line")
    return own.withColumn("line", F.concat("line", F.lit("\n"))).mapInArrow(_digests, "batch_id string, n_rows long, n_bytes long, checksum string, fault int, differs boolean, twice boolean")


def checksums(rows: DataFrame, max_rows: int, max_bytes: int) -> DataFrame:
    """(batch_id, n_rows, n_bytes, checksum) of ``lined`` rows; a batch over a cap has no checksum."""
    told = digests(rows.withColumns({"fault": F.lit(NO_FAULT), "differs": F.lit(False)}), tasks(rows))
    return told.select("batch_id", "n_rows", "n_bytes", F.when((_c("n_rows") <= max_rows) & (_c("n_bytes") <= max_bytes), _c("checksum")).alias("checksum"))


def batch_key(feed: str, checksum: Column, tenant: str = "t", project: str = "1001") -> Column:
    return F.concat_ws("/", F.lit(feed), F.lit(tenant), F.lit(project), "batch_id", checksum)


def guarded(feed: str, receipts: DataFrame, rows: DataFrame, *faults: tuple[Column, str], n: int, carried: str = "row_hash", max_rows: int, max_bytes: int) -> DataFrame:
    """(batch_id, ok, reason, n_rows, checksum) of every batch of ``receipts`` (batch_id, batch_key).

    ``faults`` are conditions over a row, a null one too; ``carried`` is the row's hash; ``n`` tasks share the rows. A batch
    without rows has the checksum of nothing.
    """
    own, names = lined(rows, feed), F.array(*(F.lit(n) for _, n in faults))
    first = first_fault(*faults)
    differs = ~F.sha2(_c("line") if carried == "row_hash" else _c("revision_line"), 256).eqNullSafe(_c(carried))
    told = digests(own.withColumns({"fault": F.when(first == "", NO_FAULT).otherwise(F.array_position(names, first).cast("int")), "differs": differs}), n)
    df = receipts.join(told, "batch_id", "left").fillna(False, ["twice", "differs"]).fillna(0, ["n_rows", "n_bytes"]).fillna(NO_FAULT, ["fault"])
    checksum = F.when(_c("n_rows") == 0, F.sha2(F.lit(""), 256)).otherwise(_c("checksum"))
    reason = (
        F.when(_c("fault") != NO_FAULT, F.get(names, _c("fault") - 1)).when(_c("twice"), "duplicate").when(_c("differs"), carried).when(_c("n_rows") > max_rows, "row_cap")
        .when(_c("n_bytes") > max_bytes, "byte_cap").when(~_c("batch_key").eqNullSafe(batch_key(feed, checksum)), "batch_key").otherwise("")
    )
    return df.withColumns({"reason": reason, "sum": checksum}).select("batch_id", (_c("reason") == "").alias("ok"), "reason", _c("n_rows").cast("long").alias("n_rows"), F.when(_c("reason") == "", _c("sum")).alias("checksum"))


@operator
def sink_guard(plan, carried, receipts, max_rows=24, max_bytes=3_500):
    """History batches: requested points, inside the window, each key once, hashes, caps, batch key."""
    start, end = (utc_clock(instant_with_zone(_c(c))) for c in ("window_start", "window_end"))
    n = tasks(carried)
    own = carried.repartition(n, "batch_id").join(plan.select("batch_id", "scope", start.alias("s"), end.alias("e")), "batch_id")
    late = (_c("observed_at") < _c("s")) | (_c("observed_at") >= _c("e"))
    return guarded("history", receipts, own, (~F.array_contains("scope", _c("point_id")), "scope"), (late, "window"), n=n, max_rows=max_rows, max_bytes=max_bytes)


@operator
def entity_guard(handed, receipts, max_rows=100_000, max_bytes=1 << 26):
    """Metadata batches, a site each: known kinds, the site's own entities, the id of their tags, shapes, each key once, hashes, caps, batch key."""
    equipment = _c("kind") == "equipment"
    shape = F.when(equipment, _c("equipment_ref").isNotNull() | _c("historized") | _c("site_level").isNotNull()).otherwise(~_c("site_level").eqNullSafe(_c("equipment_ref").isNull()))
    faults = ((~_c("kind").isin("equipment", "point"), "kind"), (_c("site_ref") != _c("batch_id"), "site"), ((_c("source_id") == "") | (_c("tag_id") != _c("source_id")), "id"), (_c("historized").isNull() | shape, "shape"))
    return guarded("metadata", receipts, handed, *faults, n=tasks(handed), max_rows=max_rows, max_bytes=max_bytes)


@operator
def rule_guard(plan, judged, receipts, tenant="t", project="1001", max_rows=100_000, max_bytes=1 << 26):
    """Rule days: requested equipment, that day, the detection's key computed anew, each once, the hash of its revision, caps, batch key."""
    n = tasks(judged)
    own = judged.repartition(n, "batch_id").join(plan.select("batch_id", "scope", "day", "site_ref", "timezone"), "batch_id")
    key = detection_key(F.lit(tenant), F.lit(project), _c("site_ref"), _c("equipment_id"), _c("rule_id"), _c("day"), _c("timezone"))
    own = own.withColumn("revision_line", canonical(severity=_c("severity"), spark=_c("spark")))
    faults = ((~F.array_contains("scope", _c("equipment_id")), "scope"), (_c("source_date") != _c("day"), "day"), (_c("detection_key") != key, "detection_key"))
    return guarded("rules", receipts, own, *faults, n=n, carried="revision_hash", max_rows=max_rows, max_bytes=max_bytes)
