"""Deduplication keeps its keys in RocksDB, within one memory, not in the heap."""

from pyspark.sql import functions as F

from tagflow.streaming import streams
from tagflow.tables import setting

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
HEAP = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
BOUNDED = "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage"


def test_keys_of_a_deduplicated_stream_are_kept_on_disk(spark, tmp_path):
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))
    rows = spark.range(3000).select(F.when(F.col("id") % 1000 != 7, F.col("id") % 1000).cast("string").alias("key"), at.alias("at"))
    for k in range(2):
        rows.where(F.col("key").isNull() | (F.lit(k) == 0) | (F.col("key") > "5")).write.mode("append").parquet(str(tmp_path / "in"))
    with setting(spark, PROVIDER, HEAP):
        feed = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(str(tmp_path / "in"))
        out = streams.stream_dedup(feed, "key", "at", lag="1 day")
        query = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
        state = [s for p in query.recentProgress for s in p.stateOperators]
    assert spark.conf.get(BOUNDED) == "true"
    assert len(state) > 1 and all("rocksdbSstFileSize" in s.customMetrics for s in state) and max(s.numRowsTotal for s in state) == 1000
    got = [r.key for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert len(got) == 1000 and set(got) == {None} | {str(k) for k in range(1000) if k != 7}
