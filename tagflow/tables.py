"""Intermediate tables, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """This application's folder below the session's ``spark.checkpoint.dir``; it goes when the application ends.

    Where the session names none, a folder of our own is set if all tasks run in this process
    (a local master, as in tests); on a cluster that is an error, as executors would not share it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tagflow-")
        spark.conf.set("spark.checkpoint.dir", root)
    own = f"{root.rstrip('/')}/tagflow-{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(path)
    store.deleteOnExit(path)
    return own


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reads."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, hidden ones left out; only these reach Python."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatusIterator(place)
    names = []
    while found.hasNext():
        if (status := found.next()).isDirectory() and not (name := status.getPath().getName()).startswith((".", "_")):
            names.append(name)
    return sorted(names)


@contextmanager
def setting(spark: SparkSession, key: str, value) -> Iterator[None]:
    """The session's ``key`` is ``value`` within, and what it was after."""
    before = spark.conf.get(key)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def brief_shuffles(spark: SparkSession):
    """Writes within drop the files of their own shuffles as they end, where disk is short; nothing may use their plans again."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def measured(df: DataFrame) -> DataFrame:
    """``df``, read from a table of ours, so that joins do not broadcast it because its files are small.

    Spark takes the length of the files for the size of the rows, and compressed keys and hashes are many
    times that in memory. Joins shuffle it; one that is known to be small is broadcast by name.
    """
    return df.hint("merge")


#: Rows of a task of a shuffle whose tasks grow with its rows.
TASK_ROWS = 250_000


def tasks(df: DataFrame, rows: int = TASK_ROWS) -> int:
    """Tasks for a shuffle of ``df``, of ``rows`` rows each, the session's number at least; ``df`` is counted, which is little for a table of ours."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows))


def materialize(df: DataFrame, label: str, drop_shuffles: bool = False) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared folder and read it back.

    A lost executor costs a re-read, not the stages before. Spark drops a shuffle's files once
    nothing refers to it; with ``drop_shuffles`` it does as the write ends.
    """
    spark, path, schema = df.sparkSession, new_path(df.sparkSession, label), df.schema
    with brief_shuffles(spark) if drop_shuffles else nullcontext():
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)
