"""WARC archives: a distributed writer, and a reader that salvages what damage leaves.

Payloads that repeat are written once: of the records alike, that with the largest id is the
response and the others revisit it. Every record is a gzip member of its own. The reader checks
each record (compression, version line, header, lengths, payload digest). Where a check fails it
searches for the next member, or in plain archives the next version line, that passes, goes on
from there, and reports the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagflow.llm.common import materialize, new_path

ARCHIVE_BYTES = 8 << 20
PIECE = 1 << 15
#: Bytes of an archive read at a time, and how many of the next block come with each; rows a batch.
BLOCK, PAST, BATCH_ROWS = 1 << 20, 16, 1_000
MAGIC = b"\x1f\x8b\x08"
VERSION, HEADER_END = b"WARC/1.", b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "kind string, path string, start long, stop long, reason string, record_id string, record_type string, uri string, refers_to string, payload_bytes long, payload_digest string"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(ident: str, uri: str, payload: bytes, refers_to: str | None = None) -> bytes:
    """One record, not compressed: a response, or a revisit of the record ``refers_to``."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to else http + payload
    clean = "".join(c for c in uri if c > " " and c != "\x7f")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to else 'response'}",
        f"WARC-Record-ID: <{ident}>",
        "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Target-URI: {clean}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def squeeze(record: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(record) + c.flush()


class Archive:
    """The bytes of an archive, read block by block from ``read(offset, n)``.

    Places that ``find`` met are remembered, so a search that moves on is linear over all its calls.
    ``failed`` are the ends of headers whose record did not pass a check.
    """

    def __init__(self, size: int, read: Callable[[int, int], bytes]):
        self.size, self._read = size, read
        self._found: dict[bytes, tuple[int, int]] = {}
        self.failed: set[int] = set()
        self._block = lru_cache(maxsize=4)(lambda k: read(k * BLOCK, min(BLOCK + PAST, size - k * BLOCK)))

    def read(self, at: int, n: int) -> bytes:
        n = max(0, min(n, self.size - at))
        k, inside = divmod(at, BLOCK)
        if n and inside + n <= BLOCK + PAST:
            return self._block(k)[inside : inside + n]
        return self._read(at, n) if n else b""

    def find(self, what: bytes, at: int) -> int:
        """The first place of ``what``, at most PAST bytes long, from ``at`` on; the size where there is none."""
        low, place = self._found.get(what, (1, 0))
        if not low <= at <= place:
            place = self.size
            for k in range(at // BLOCK, -(-self.size // BLOCK)):
                here = self._block(k).find(what, max(0, at - k * BLOCK), BLOCK + len(what) - 1)
                if here >= 0:
                    place = k * BLOCK + here
                    break
            self._found[what] = (at, place)
        return place


def whole(data: bytes) -> Archive:
    return Archive(len(data), lambda at, n: data[at : at + n])


def parse(data: Archive, at: int = 0) -> tuple[dict, int]:
    """(record, its end) at ``at``; ValueError names the check that failed."""
    if data.read(at, len(VERSION)) != VERSION:
        raise ValueError("no version line")
    end = data.find(HEADER_END, at)
    if end == data.size:
        raise ValueError("no end of header")
    try:
        return _checked(data, at, end)
    except ValueError:
        data.failed.add(end)
        raise


def _checked(data: Archive, at: int, end: int) -> tuple[dict, int]:
    lines = data.read(at, end - at).decode("utf-8", "replace").split("\r\n")[1:]
    head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    if not head.get("content-length", "").isdigit():
        raise ValueError("no content length")
    size, body = int(head["content-length"]), end + 4
    if body + size > data.size or data.read(body + size, 4) != HEADER_END:
        raise ValueError("wrong content length")
    block = data.read(body, size)
    http, gap, payload = block.partition(HEADER_END)
    kind, digest = head.get("warc-type"), head.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and digest and digest != digest_of(payload):
        raise ValueError("wrong payload digest")
    told = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:") and x.split(b":")[1].strip().isdigit()), None)
    out = {
        "record_id": head.get("warc-record-id", "").strip("<>"),
        "record_type": kind,
        "uri": head.get("warc-target-uri"),
        "refers_to": head["warc-refers-to"].strip("<>") if "warc-refers-to" in head else None,
        "payload_bytes": told if kind == "revisit" else len(payload),
        "payload_digest": digest or digest_of(payload),
        "payload": payload if kind == "response" else None,
    }
    return out, body + size + 4


def _member(data: Archive, at: int) -> tuple[dict, int]:
    """(record, end offset) of the gzip member at ``at``, read piece by piece."""
    d, got, pos = zlib.decompressobj(31), [], at
    try:
        while not d.eof:
            if pos >= data.size:
                raise ValueError("gzip: member without end")
            got.append(d.decompress(data.read(pos, PIECE)))
            pos += PIECE
    except zlib.error as e:
        raise ValueError(f"gzip: {e}") from None
    raw = b"".join(got)
    record, size = parse(whole(raw))
    if size != len(raw):
        raise ValueError("bytes after the record")
    return record, min(pos, data.size) - len(d.unused_data)


def _may_start(data: Archive, at: int) -> bool:
    """Whether a whole record at ``at`` is worth reading, by a few bytes.

    A member must unpack to a version line. A version line must end in CRLF, have an end of header
    that no record failed at, and no line between that is a version line itself: of several before
    one end only the last can begin a record.
    """
    if data.read(at, 3) == MAGIC:
        try:
            return zlib.decompressobj(31).decompress(data.read(at, 512), 16).startswith(VERSION)
        except zlib.error:
            return False
    line = data.read(at, len(VERSION) + 3)
    if not (line[len(VERSION) : -2].isdigit() and line.endswith(b"\r\n")):
        return False
    end = data.find(HEADER_END, at)
    return end < data.size and end not in data.failed and data.find(b"\n" + VERSION, at) > end


def salvage(data: bytes | Archive) -> Iterator[tuple[str, int, int, dict | str]]:
    """('record', start, stop, record) and ('gap', start, stop, reason), in order, without overlap.

    Together they cover ``data``. Compressed and plain stretches may follow one another. The search
    after a failed check is linear in the bytes, whatever they hold, but for records inside records
    that pass all checks save the digest.
    """
    data = whole(data) if isinstance(data, bytes) else data
    at, n = 0, data.size
    read = lambda k: _member(data, k) if data.read(k, 3) == MAGIC else parse(data, k)
    while at < n:
        try:
            record, stop = read(at)
            yield "record", at, stop, record
            at = stop
            continue
        except ValueError as e:
            reason = str(e)
        stop = at
        while stop < n:
            stop = min(data.find(MAGIC, stop + 1), data.find(VERSION, stop + 1))
            if stop < n and _may_start(data, stop):
                try:
                    read(stop)
                    break
                except ValueError:
                    continue
        yield "gap", at, stop, reason
        at = stop


def plan_records(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """``pages`` with r_id, r_payload (text, null as empty) and r_refers (null for responses).

    Only payloads that repeat enter the join, by digest; they are read from a table, so Spark may
    broadcast few of them and split hot ones.
    """
    payload = F.coalesce(pages[payload_col], F.lit(""))
    narrow = pages.select(pages[id_col].alias("i"), F.unhex(F.sha1(payload)).alias("sha"), F.octet_length(payload).alias("n"))
    again = narrow.where(F.col("n") >= min_bytes).groupBy("sha").agg(F.max("i").alias("first"), F.count("*").alias("k")).where("k > 1").select("sha", "first")
    again = materialize(again, "payloads")
    rows = pages.select(pages[id_col].alias("r_id"), payload.alias("r_payload"), "url", F.unhex(F.sha1(payload)).alias("sha"))
    joined = rows.join(again, "sha", "left")
    return joined.select("r_id", "r_payload", "url", F.when(~F.col("r_id").eqNullSafe(F.col("first")), F.col("first")).alias("r_refers"))


def write_archives(planned: DataFrame, folder: str) -> DataFrame:
    """Write the archives, a few by task; (file, records) of those whose task ended well.

    Each attempt writes files of its own name; what a lost attempt leaves is in no row returned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        done: list[tuple[str, int]] = []
        out, size, n, name = None, 0, 0, ""
        for b in batches:
            for ident, payload, url, refers in zip(*(b.column(k) for k in range(4))):
                if out is None:
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                i, r = ident.as_py(), refers.as_py()
                raw = record_bytes(f"urn:page:{'' if i is None else i}", url.as_py() or "", payload.as_py().encode("utf-8", "replace"), None if r is None else f"urn:page:{r}")
                size += out.write(member := squeeze(raw)) or len(member)
                n += 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((name, n))
                    out = None
        if out is not None:
            out.close()
            done.append((name, n))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64())], names=["file", "records"])

    return planned.select("r_id", "r_payload", "url", "r_refers").mapInArrow(run, "file string, records long")


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False, files: DataFrame | None = None) -> DataFrame:
    """Records and gaps of all archives in ``folder`` (or only those that ``files`` names).

    ``kind`` is record or gap; a gap has its reason and byte range and no record fields. Archives are
    read block by block where the records are made, so a task holds a record and a few blocks,
    whatever the size of its archives. An empty folder, or an empty archive, gives no rows.
    """
    schema = RECORD + ", payload binary" * with_payload
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = {"start": pa.int64(), "stop": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], kinds.get(c, pa.string())) for c in names], names=names)
        for b in batches:
            for path in b.column(0).to_pylist():
                store, place = pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
                with store.open_input_file(place) as f:
                    rows, size = [], 0
                    for kind, start, stop, what in salvage(Archive(f.size(), lambda at, n: f.read_at(n, at))):  # noqa: B023
                        rows.append({"kind": kind, "path": path, "start": start, "stop": stop} | (what if kind == "record" else {"reason": what}))
                        if not with_payload:
                            rows[-1].pop("payload", None)
                        size += len(rows[-1].get("payload") or b"")
                        if len(rows) == BATCH_ROWS or size > BLOCK:
                            yield batch_of(rows)
                            rows, size = [], 0
                    yield batch_of(rows)

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder).select("path")
    if files is not None:
        found = found.withColumn("file", F.element_at(F.split("path", "/"), -1)).join(files.select("file"), "file", "left_semi").select("path")
    return found.mapInArrow(run, schema)


def archived(pages: DataFrame, min_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """Archive ``pages`` (page_id, url, html) in the shared folder and read the archives back: (records, gaps).

    Records have page_id, payload_bytes, payload_digest, record_type, refers_to; gaps have path,
    start, stop and reason of the bytes that the reader quarantined. The records of each archive are
    counted against the manifest of the writer; a lost one is an error that names the archives.
    """
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    files = materialize(write_archives(plan_records(pages, min_bytes=min_bytes), folder), "manifest")
    if files.isEmpty():
        fields = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
        return spark.createDataFrame([], fields), spark.createDataFrame([], "path string, start long, stop long, reason string")
    back = materialize(read_archives(spark, folder, files=files), "records")
    read = back.where("kind = 'record'").groupBy(F.element_at(F.split("path", "/"), -1).alias("file")).agg(F.count("*").alias("n"))
    lost = files.join(read, "file", "left").where(F.coalesce("n", F.lit(0)) != F.col("records")).limit(5).collect()
    if lost:
        raise ValueError(f"records lost between writing and reading, among others in {[(r.file, r.records, r.n) for r in lost]}")
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("long")
    found = back.where("kind = 'record'").select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))
    return found, back.where("kind = 'gap'").select("path", "start", "stop", "reason")


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """The records of ``archived``: one row per page row.

    Null html is empty, null url an empty one; very long payloads and urls are written whole. Rows
    that repeat the response's page_id and payload are all responses; a row with a null page_id
    revisits the payload's response, or is one where no row of that payload has an id. Empty input
    gives no rows. Further columns are not read.
    """
    return archived(pages, min_bytes)[0]


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS r FROM p),
q AS (SELECT *, [cast('0x' || x[5 * i + 1:5 * i + 5] AS bigint) for i in range(8)] AS v FROM d)
SELECT page_id, cast(n AS bigint) AS payload_bytes,
  array_to_string(flatten([[('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')[((y >> s) & 31) + 1] for s in [15, 10, 5, 0]] for y in v]), '') AS payload_digest,
  CASE WHEN page_id = r THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> r THEN r END AS refers_to
FROM q
"""
