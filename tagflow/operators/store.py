"""History in folders of days and buckets, merged batch by batch.

Layout: ``base`` and ``revisions`` below one root, each ``obs_date=<day>/bucket=<b>/put=<n>``, and
``receipts/put=<n>``. A put reads no day that it does not stage: only the staged days' folders are
listed, of these only the buckets that its points fall into, and of their files only the row groups
whose times overlap. There is no transactional table format: a put owns the folders of its number,
which it replaces as a whole and never reads, so one that is run again after a failure gives the
same. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagflow.functions.normalize import SAMPLE_FIELDS, SOURCE_FIELDS, observation_hash
from tagflow.operators.merge import KEY, POLICIES, history_revisions, merged
from tagflow.tables import exists, materialize

_c = F.col
SAMPLE = (
    "row_no long, batch_id string, tenant_id string, project_id string, point_id string, observed_at timestamp_ntz, value_kind string, val_bool boolean, val_str string, val_num decimal(38,18), val_na boolean, "
    "source_timestamp string, source_timezone string, source_status string, row_hash string"
)
STORED = f"{SAMPLE}, obs_date date, bucket int, put long"


class HistoryStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, policy: str = "append_revision"):
        if policy not in POLICIES:
            raise ValueError(f"policy is one of {POLICIES}")
        self.spark, self.root, self.buckets, self.policy = spark, root.rstrip("/"), buckets, policy

    def _table(self, table: str, folders: list[str]) -> DataFrame:
        there = [f for f in folders if exists(self.spark, f)]
        if not there:
            return self.spark.createDataFrame([], STORED)
        return self.spark.read.schema(STORED).option("basePath", f"{self.root}/{table}").parquet(*there)

    def read(self, table: str = "base") -> DataFrame:
        """All of ``base`` or ``revisions``."""
        return self._table(table, [f"{self.root}/{table}"])

    def near(self, staged: DataFrame, table: str = "base") -> DataFrame:
        """The stored rows that rows of ``staged`` (with obs_date and bucket) may meet."""
        span = staged.agg(F.collect_set("obs_date").alias("days"), F.collect_set("bucket").alias("buckets"), F.min("observed_at").alias("low"), F.max("observed_at").alias("high")).first()  # days of a calendar, and buckets
        stored = self._table(table, [f"{self.root}/{table}/obs_date={d}" for d in sorted(span.days)])
        if span.low is None:
            return stored
        # whole days bound the scan's partitions, times its row groups
        return stored.where(_c("obs_date").isin(*span.days) & _c("bucket").isin(*span.buckets) & _c("observed_at").between(F.lit(span.low).cast("timestamp_ntz"), F.lit(span.high).cast("timestamp_ntz")))

    def prepared(self, staged: DataFrame) -> DataFrame:
        """``staged`` in the store's columns, with its hash, day and bucket; what it lacks is null."""
        names = ("row_no", "batch_id", *KEY[:2], *SAMPLE_FIELDS, *SOURCE_FIELDS)
        kinds = dict(x.strip().split(" ", 1) for x in SAMPLE.replace("decimal(38,18)", "decimal(38;18)").split(","))
        own = staged.select(*((_c(n) if n in staged.columns else F.lit(None)).cast(kinds[n].replace(";", ",")).alias(n) for n in names))
        bucket = F.pmod(F.xxhash64("point_id"), F.lit(self.buckets)).cast("int")
        return own.withColumns({"row_hash": observation_hash(staged) if "row_hash" not in staged.columns else _c("row_hash"), "obs_date": F.to_date("observed_at"), "bucket": bucket})

    def put(self, staged: DataFrame, put: int) -> DataFrame:
        """Merge batches of samples as put number ``put``; the receipts, one a batch, are written and returned.

        Receipts: batch_id, staged, inserted, ignored, revised, refused, reason. Rows whose time is
        null are an error. Rows are as in ``merged``; late and corrected samples become
        revisions, and the base is never changed.
        """
        own = self.prepared(staged)
        own = materialize(own.withColumn("obs_date", F.coalesce("obs_date", F.raise_error(F.lit("a sample has no time")).cast("date"))), "staged")
        told = materialize(merged(self.near(own).where(_c("put") != put), own, self.policy), "told")
        self._write("base", told.where("action = 'insert'"), put)
        new = history_revisions(told=told, revisions=self.near(own, "revisions").where(_c("put") != put))
        key = ["point_id", "observed_at", "row_hash"]
        self._write("revisions", told.where("action = 'revision'").join(new, key, "left_semi").dropDuplicates([*KEY, "row_hash"]), put)
        n = lambda a: F.count_if(_c("action") == a)
        receipts = told.groupBy("batch_id").agg(F.count("*").alias("staged"), n("insert").alias("inserted"), n("ignore").alias("ignored"), n("revision").alias("revised"), n("refused").alias("refused"), F.coalesce(F.max("reason"), F.lit("")).alias("reason"))
        path, schema = f"{self.root}/receipts/put={put}", receipts.schema
        receipts.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def _write(self, table: str, rows: DataFrame, put: int) -> None:
        out = rows.select(*(x.split()[0] for x in SAMPLE.replace("38,18", "38;18").split(", ")), "obs_date", "bucket").withColumn("put", F.lit(put).cast("long"))
        # a bucket's day that is large is written by several tasks
        out = out.hint("rebalance", _c("obs_date"), _c("bucket")).sortWithinPartitions("obs_date", "bucket", "observed_at", "point_id")
        out.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("obs_date", "bucket", "put").parquet(f"{self.root}/{table}")
