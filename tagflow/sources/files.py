"""Readers of landed exports, pages and snapshots, and writers that refuse to overwrite."""

from __future__ import annotations

import csv
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagflow.functions.normalize import ZONED, historized_value, instant_with_zone, reference, typed_value, utc_clock
from tagflow.operators.validators import settled
from tagflow.tables import exists, folders, materialize


def _headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The first line's names of every file below ``path``, quoted ones unquoted; only the starts of files are read, by Spark's own stores."""
    files = [r.path for r in spark.read.format("binaryFile").load(path).select("path").collect()]  # a path a file
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs, out = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf), {}
    for name in files:
        place = jvm.org.apache.hadoop.fs.Path(name)
        raw, codec = place.getFileSystem(conf).open(place), codecs.getCodec(place)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(raw) if codec else raw, "UTF-8"))
        line = lines.readLine()
        lines.close()
        out[name] = next(csv.reader([(line or "").lstrip("\ufeff")]), [])
    return out


def read_entity_export(spark: SparkSession, path: str, required: list[str], max_bytes: int | None = None, max_rows: int | None = None) -> DataFrame:
    """CSV with a header in each file, all strings, an empty cell as an empty one; a byte-order mark is tolerated.

    Files may have their columns in any order, which are read by name; the result has those of the
    first file, by path, and ones that only others have after them (empty where absent). Refused are
    files without a required column or with a repeated one, a row with more or fewer cells than its
    header, and files over ``max_bytes`` or ``max_rows`` together.
    """
    heads = _headers(spark, path)
    for name, names in sorted(heads.items()):
        missing = [c for c in required if c not in names]
        if missing or len(set(names)) < len(names):
            raise ValueError(f"bad header of {name}: missing {missing}, columns {names}")
    if not heads:
        raise ValueError(f"no export at {path}")
    if max_bytes is not None and (spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0) > max_bytes:
        raise ValueError(f"{path} is over {max_bytes} bytes")
    alike: dict[tuple[str, ...], list[str]] = {}
    for name, names in sorted(heads.items()):
        alike.setdefault(tuple(names), []).append(name)
    rows = None
    for names, own in alike.items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField("_corrupt", T.StringType())])
        part = spark.read.csv(own, header=True, schema=schema, enforceSchema=True, columnNameOfCorruptRecord="_corrupt", mode="PERMISSIVE")
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    bad = rows.where("_corrupt IS NOT NULL").limit(3).collect()
    if bad:
        raise ValueError(f"rows whose cells differ from the header, among others {[r['_corrupt'] for r in bad]}")
    rows = rows.drop("_corrupt").fillna("")
    if max_rows is not None and rows.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"{path} has over {max_rows} rows")
    return rows


def read_export_set(spark: SparkSession, folder: str, required: dict[str, list[str]], **caps: int) -> dict[str, DataFrame]:
    """The exports ``<kind>.csv`` of a folder, each with its required columns."""
    return {kind: read_entity_export(spark, f"{folder}/{kind}.csv", cols, **caps) for kind, cols in required.items()}


PAGE = "meta variant, cols array<struct<name:string,meta:variant>>, rows array<variant>"


def read_pages(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Landed grids, one row a file, or with ``lines`` one row a line of files that hold many: path, meta, cols, rows."""
    return spark.read.schema(PAGE).option("multiLine", not lines).json(path).withColumn("path", F.col("_metadata.file_path"))


#: Receipt fields of a page's ``meta`` (fixed names of the landed format), by type.
RECEIPT = {"batch_id": "string", "err": "string", "project": "string", "site": "string", "complete": "boolean", "returned_rows": "long", "total_rows": "long"}
WINDOWED = {"query_id": "string", "window_start": "string", "window_end": "string", "requested_ids": "array<string>", "completed_ids": "array<string>", "truncated": "boolean"}
CHAINED = {"kind": "string", "page": "long", "page_index": "long", "next_page": "string"}


def receipts_of(pages: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Pages with their receipt fields as columns (null where absent or of another type), and ``actual_rows``."""
    meta = (F.try_variant_get("meta", f"$.{k}", t).alias(k) for k, t in fields.items())
    return pages.select("path", *meta, F.coalesce(F.size("rows"), F.lit(0)).cast("long").alias("actual_rows"), "cols", "rows")


def read_history_pages(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Landed wide grids of samples, one row a page."""
    return receipts_of(read_pages(spark, path, lines), RECEIPT | WINDOWED)


def read_metadata_pages(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Landed equipment or point pages, with their snapshot and place in the chain."""
    return receipts_of(read_pages(spark, path, lines), RECEIPT | {"snapshot": "string"} | CHAINED)


def read_rules_pages(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Landed grids of detections, with their local day and zone."""
    return receipts_of(read_pages(spark, path, lines), RECEIPT | WINDOWED | {"day": "string", "timezone": "string", "requested_count": "long"} | CHAINED)


def entity_rows(pages: DataFrame) -> DataFrame:
    """Entities of landed metadata pages: path, kind, source_id, site_ref, parent_id, site_level, historized, tags.

    References may be texts or objects. An id, a site or a mark that is invalid is null; so is the
    ``site_level`` of a point whose reference to equipment is there but invalid.
    """
    rows = pages.select("path", "kind", F.explode("rows").alias("tags"))
    field = lambda k: F.try_variant_get("tags", f"$.{k}", "variant")
    parent = field("equipRef")
    lacks = parent.isNull() | F.is_variant_null(parent) | (F.try_variant_get(parent, "$", "string") == "")
    point = F.col("kind") != "equipment"
    return rows.select(
        "path", F.when(point, "point").otherwise("equipment").alias("kind"), reference(field("id")).alias("source_id"), reference(field("siteRef")).alias("site_ref"), F.when(point, reference(parent)).alias("parent_id"),
        F.when(point, F.when(F.coalesce(lacks, F.lit(False)), True).when(reference(parent).isNotNull(), False)).alias("site_level"), F.when(point, historized_value(field("his"))).otherwise(False).alias("historized"), F.to_json("tags").alias("tags"),
    )


def landed_samples(pages: DataFrame) -> DataFrame:
    """Samples of landed history pages (with batch_id): batch_id, point_id, observed_at on a UTC clock, typed values, source fields.

    A key without a column stands for itself, so that the checks find it; cells of columns that are
    null are no samples. ``observed_at`` is null without a zone, ``value_kind`` where the value has no type.
    """
    cells = pages.sparkSession.sql(
        """
WITH r AS (
  SELECT batch_id, transform(cols, x -> x.name) AS names, transform(cols, x -> coalesce(try_variant_get(x.meta, '$.id', 'string'), x.name)) AS ids, explode(rows) AS line
  FROM {pages})
SELECT r.batch_id, coalesce(get(r.ids, array_position(r.names, e.key) - 1), e.key) AS point_id, try_variant_get(r.line, '$.ts', 'string') AS ts, e.value AS cell
FROM r, LATERAL variant_explode(r.line) e WHERE e.key <> 'ts' AND NOT (array_contains(r.names, e.key) AND is_variant_null(e.value))""",
        pages=pages,
    )
    typed = (c.alias(k) for k, c in typed_value(F.col("cell")).items())
    return cells.select("batch_id", "point_id", utc_clock(instant_with_zone(F.col("ts"))).alias("observed_at"), *typed, F.col("ts").alias("source_timestamp"), F.regexp_extract("ts", ZONED, 1).alias("source_timezone"))


def history_wide_to_long(pages: DataFrame, key: str = "path") -> DataFrame:
    """(``key``, point_id, ts, cell) of every cell that is set; a column's id is its ``meta.id``, else its name.

    Pages that share a file are told apart by another ``key`` than its path.
    """
    return pages.sparkSession.sql(
        """
WITH r AS (
  SELECT page, transform(cols, x -> x.name) AS names, transform(cols, x -> coalesce(try_variant_get(x.meta, '$.id', 'string'), x.name)) AS ids, explode(rows) AS line
  FROM {pages})
SELECT r.page, r.ids[array_position(r.names, e.key) - 1] AS point_id, try_variant_get(r.line, '$.ts', 'string') AS ts, e.value AS cell
FROM r, LATERAL variant_explode(r.line) e WHERE e.key <> 'ts' AND array_contains(r.names, e.key) AND NOT is_variant_null(e.value)""",
        pages=pages.select(F.col(key).alias("page"), "cols", "rows"),
    ).withColumnRenamed("page", key)


def latest_export(spark: SparkSession, pattern: str) -> DataFrame:
    """Path and time of the newest file that the pattern finds."""
    files = spark.read.format("binaryFile").load(pattern).select("path", "modificationTime")
    return files.agg(F.max(F.struct("modificationTime", "path")).alias("m")).select("m.path", "m.modificationTime")


def file_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256, length and whether the file ends in a line feed."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"), (F.substring(F.col("content"), -1, 1) == F.lit(b"\n")).alias("ends_in_newline"))


#: Files of a folder of landed ones, about; a task lists a folder and reads its files.
FOLDER_FILES = 5_000
#: Tasks a core that landed files are dealt to, and bytes of one read at a time.
WAVES, BLOCK = 4, 1 << 20


def write_files(contents: DataFrame, root: str) -> DataFrame:
    """One file below ``root`` a row of (name, content), in folders of about ``FOLDER_FILES``: (name, file), the file's path there.

    Folder and file follow from the name, and a file gets its name when it is whole, so a task that is run again puts the same ones in place.
    Tasks write them, and no list of them is made on the driver. Each name is there once; ``contents`` is counted.
    """
    n = max(WAVES * contents.sparkSession.sparkContext.defaultParallelism, -(-contents.count() // FOLDER_FILES))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(root)
        made = set()
        for part in parts:
            for file, content in zip(part.column("file").to_pylist(), part.column("content").to_pylist(), strict=True):
                folder, name = f"{base}/{file}".rsplit("/", 1)
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                own = f"{folder}/.{uuid.uuid4().hex}"
                with store.open_output_stream(own, compression=None) as out:
                    out.write(content)
                _place(store, own, f"{folder}/{name}")
            yield part.select(["name", "file"])

    folder = F.lpad(F.pmod(F.xxhash64("name"), F.lit(n)).cast("string"), 8, "0")
    dealt = contents.select("name", F.concat_ws("/", folder, F.sha1("name")).alias("file"), F.col("content").cast("binary").alias("content"))
    return materialize(dealt.repartition(n, F.substring_index("file", "/", 1)).mapInArrow(run, "name string, file string"), "landed-files")


def _place(store: pafs.FileSystem, own: str, path: str) -> None:
    """Give a whole file its name; where a store does not replace files, one that another run of the task put there stays, as it is the same."""
    try:
        store.move(own, path)
    except OSError:
        if store.get_file_info(path).type != pafs.FileType.File:
            raise
        store.delete_file(own)


def folder_fingerprints(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    """(file, sha256, length) of the files in folders of ``root``, and in itself by the name ``""``. A task lists a folder and reads its files
    block by block, so the driver holds names of folders only. Hidden files are passed over, as Spark's readers do."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(root)
        for folder in (name for part in parts for name in part.column(0).to_pylist()):
            rows = []
            for info in store.get_file_info(pafs.FileSelector(f"{base}/{folder}".rstrip("/"))):
                if info.type != pafs.FileType.File or info.base_name.startswith((".", "_")):
                    continue
                sha, length = hashlib.sha256(), 0
                with store.open_input_stream(info.path, compression=None) as file:
                    while block := file.read(BLOCK):
                        sha.update(block)
                        length += len(block)
                rows.append({"file": f"{folder}/{info.base_name}".lstrip("/"), "sha256": sha.hexdigest(), "length": length})
            yield pa.RecordBatch.from_pylist(rows, pa.schema({"file": pa.string(), "sha256": pa.string(), "length": pa.int64()}))

    dealt = spark.createDataFrame([(name,) for name in names], "folder string").repartition(len(names))
    return dealt.mapInArrow(run, "file string, sha256 string, length long")


def verify_files(spark: SparkSession, path: str, receipts: DataFrame) -> DataFrame:
    """(file, verdict) of landed files against receipts (file, sha256, length): ok, missing, unexpected, length, sha256, or
    no_newline where JSON lines don't end in one."""
    found = file_fingerprints(spark, path).withColumn("file", F.element_at(F.split("path", "/"), -1))
    both = found.join(receipts.select("file", F.col("sha256").alias("want"), F.col("length").alias("size")), "file", "full")
    verdict = (
        F.when(F.col("path").isNull(), "missing").when(F.col("want").isNull(), "unexpected").when(F.col("length") != F.col("size"), "length").when(F.col("sha256") != F.col("want"), "sha256")
        .when(F.col("file").endswith(".jsonl") & ~F.col("ends_in_newline"), "no_newline").otherwise("ok")
    )
    return both.select("file", verdict.alias("verdict"))


def read_certified_jsonl(spark: SparkSession, path: str, schema: str, receipts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of the batches whose count is the receipt's, the other batches with their counts); a bad batch gives no rows.

    Rows without a batch key are of no batch, so they are never among the good ones.
    """
    rows = spark.read.schema(schema + ", batch_key string").json(path)
    counts = rows.groupBy("batch_key").agg(F.count("*").alias("n"))
    both = receipts.join(counts, "batch_key", "full")
    verdicts = both.select(F.col("batch_key").alias("batch_id"), (F.col("n").eqNullSafe(F.col("row_count")) & F.col("batch_key").isNotNull()).alias("ok"))
    good, _ = settled(rows.withColumn("batch_id", F.col("batch_key")), verdicts)
    return good.drop("batch_id"), both.where(~F.col("n").eqNullSafe(F.col("row_count")) | F.col("batch_key").isNull())


SITES = "struct<version:string,tenant_id:string,project_id:string,sites:map<string,struct<equipment_ids:array<string>,point_ids:array<string>,historized_point_ids:array<string>>>>"


def read_inventory(spark: SparkSession, path: str, tenant: str | None = None, project: str | None = None, sha256: str | None = None, sites: set[str] | None = None) -> DataFrame:
    """(version, site_ref, kind, id) of an inventory snapshot; what is given of identity, checksum and sites must agree."""
    raw = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("sha256"), F.from_json(F.decode("content", "UTF-8"), SITES).alias("v"))
    told = raw.select("sha256", "v.version", "v.tenant_id", "v.project_id", F.map_keys("v.sites").alias("sites")).collect()  # a row a snapshot
    for r in told:
        wrong = [k for k, want, got in (("checksum", sha256, r.sha256), ("tenant", tenant, r.tenant_id), ("project", project, r.project_id)) if want is not None and want != got]
        if r.version is None or wrong or (sites is not None and set(r.sites or ()) != sites):
            raise ValueError(f"inventory {path} differs from what was approved: {wrong or 'sites'}")
    each = raw.select("v.version", F.explode("v.sites").alias("site_ref", "s"))
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"s.{k}_ids").alias("ids")) for k in ("equipment", "point", "historized_point")))
    return each.select("version", "site_ref", F.inline(kinds)).select("version", "site_ref", "kind", F.explode("ids").alias("id"))


def _by_site(inventory: DataFrame) -> DataFrame:
    """(site_ref, kind, ids, hash) of (site_ref, kind, id) rows, ids sorted and each once."""
    lists = inventory.select("site_ref", "kind", "id").distinct().groupBy("site_ref", "kind").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return lists.withColumn("hash", F.sha2(F.array_join("ids", "\n"), 256))


def _version(sites: DataFrame) -> str:
    line = F.concat_ws("=", "site_ref", "kind", "hash")
    return sites.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256)).first()[0]  # a line a site and kind


def write_inventory(inventory: DataFrame, root: str, tenant: str, project: str, source_run: str) -> str:
    """Write (site_ref, kind, id) rows below a path that names their content, and return the path.

    A snapshot is never changed: the same content has the same path and is not written again.
    """
    sites = materialize(_by_site(inventory), "inventory")
    path = f"{root}/inventory/{tenant}/{project}/{source_run}/{_version(sites)}"
    if not _complete(sites.sparkSession, path):
        sites.write.mode("overwrite").json(path)
    return path


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was finished."""
    return exists(spark, f"{path}/_SUCCESS")


def read_inventory_version(spark: SparkSession, path: str) -> DataFrame:
    """(site_ref, kind, id) of what ``write_inventory`` wrote; content that the path does not name is refused."""
    sites = spark.read.schema("site_ref string, kind string, ids array<string>, hash string").json(path)
    own = sites.withColumn("hash", F.sha2(F.array_join("ids", "\n"), 256))
    if _version(own) != path.rstrip("/").rsplit("/", 1)[-1]:
        raise ValueError(f"{path} does not hold the content that it names")
    return own.select("site_ref", "kind", F.explode("ids").alias("id"))


def write_certified_jsonl(rows: DataFrame, key: str, path: str, max_rows: int = 100_000, max_bytes: int = 64 << 20) -> DataFrame:
    """JSON lines by batch; refuses an existing path and batches over a cap, before anything is written.

    Returns the manifest: batch_key, row_count, bytes (line ends included) and checksum, the SHA-256
    of the sorted hashes of the lines. The input is evaluated once.
    """
    own = materialize(rows.withColumn("batch_key", F.col(key)), "certified")
    line = F.to_json(F.struct(*rows.columns))
    hashed = own.select("batch_key", F.sha2(line, 256).alias("h"), (F.octet_length(line) + 1).alias("size"))
    sizes = hashed.groupBy("batch_key").agg(F.count("*").alias("row_count"), F.sum("size").alias("bytes"))
    over = [r.batch_key for r in sizes.where((F.col("row_count") > max_rows) | (F.col("bytes") > max_bytes)).limit(5).collect()]
    if over:
        raise ValueError(f"batches over a cap, among others {over}")
    own.repartition("batch_key").write.mode("errorifexists").partitionBy("batch_key").json(path)
    sums = hashed.groupBy("batch_key").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), "\n"), 256).alias("checksum"))
    return sizes.join(sums, "batch_key")


def write_raw_manifest(spark: SparkSession, landed: str, receipts: DataFrame, batches: DataFrame, path: str, nested: bool = False) -> DataFrame:
    """Fingerprints of landed files with their scope and row count, written once as JSON lines.

    ``receipts`` are (batch_id, file, query_id, completed_ids, row_count, truncated), ``batches`` (batch_id,
    scope_ids). Truncated responses, ones without a query, and ones whose scope is not the batch's
    are refused, as are files without a receipt or the other way round. With ``nested`` files are
    in folders of ``landed`` too, as ``write_files`` puts them, and receipts name the folder before the file.
    """
    if nested:
        files = folder_fingerprints(spark, landed, ["", *folders(spark, landed)])
    else:
        files = file_fingerprints(spark, landed).withColumn("file", F.element_at(F.split("path", "/"), -1)).select("file", "sha256", "length")
    both = receipts.join(batches, "batch_id", "left").join(files, "file", "full")
    scope = F.array_sort("completed_ids") == F.array_sort("scope_ids")
    fault = (
        F.when(F.col("sha256").isNull(), "no_file").when(F.col("batch_id").isNull(), "no_receipt").when(F.col("truncated") | (F.coalesce("query_id", F.lit("")) == "") | (F.col("row_count") < 0), "incomplete")
        .when(~F.coalesce(scope, F.lit(False)), "scope")
    )
    told = materialize(both.withColumn("fault", fault), "manifest")
    bad = told.where("fault IS NOT NULL").limit(5).collect()
    if bad:
        raise ValueError(f"raw files refused, among others {[(r.batch_id, r.file, r.fault) for r in bad]}")
    manifest = told.select("batch_id", "file", "query_id", "scope_ids", "completed_ids", "row_count", F.col("sha256").alias("checksum"), F.col("length").alias("byte_count"))
    manifest.write.mode("errorifexists").json(path)
    return manifest


def write_history(rows: DataFrame, path: str) -> None:
    """Parquet by day; only the days in ``rows`` are replaced."""
    rows.withColumn("obs_date", F.to_date("observed_at")).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("obs_date").parquet(path)


def write_csv_shards(rows: DataFrame, path: str, max_rows: int = 500_000, gzip: bool = False) -> None:
    """CSV files of at most ``max_rows`` rows; refuses an existing path."""
    rows.write.option("header", True).option("maxRecordsPerFile", max_rows).option("compression", "gzip" if gzip else "none").csv(path)


def dataset_footprint(spark: SparkSession, tables: dict[str, str], max_objects: int = 1_000_000) -> DataFrame:
    """(table, objects, bytes, rows, complete) of Parquet folders; over ``max_objects`` files count as far as that, and are not complete."""
    out = None
    for name, path in tables.items():
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path).select("length")
        size = files.limit(max_objects).agg(F.count("*").alias("objects"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
        total = files.agg((F.count("*") <= max_objects).alias("complete"))
        rows = spark.read.option("recursiveFileLookup", True).parquet(path).agg(F.count("*").alias("rows"))
        one = size.crossJoin(rows).crossJoin(total).select(F.lit(name).alias("table"), "objects", "bytes", "rows", "complete")
        out = one if out is None else out.unionByName(one)
    return out
