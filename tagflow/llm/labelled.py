"""The bounded sample of labelled rows that the classifiers learn from."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.llm.common import materialize


def sample(docs: DataFrame, labels: DataFrame, label_col: str, learn, rows: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """(s_order, label, text, extra...) of at most ``rows`` labelled documents.

    The rows with the smallest hashes of their id; ``learn`` is a boolean column over doc_id. Rows
    without an id or a 0/1 label are left out. An id counts once: labels that disagree give 0, and
    of documents that share an id that with the smallest text (then the smallest ``extra``) is
    taken. The bound makes the picked labels safe to broadcast: the documents are filtered where
    they are read.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1)).where(learn)
    picked = known.groupBy(F.col("doc_id").alias("s_id")).agg(F.min(F.col(label_col).cast("int")).alias("label")).withColumn("s_order", F.xxhash64("s_id"))
    picked = picked.orderBy("s_order", "s_id").limit(rows)
    own = docs.select(docs["doc_id"].alias("d_id"), F.coalesce(docs["text"], F.lit("")).alias("text"), *(docs[c].alias(c) for c in extra))
    found = own.join(F.broadcast(picked), F.col("d_id") == F.col("s_id")).groupBy("s_order", "s_id", "label").agg(F.min(F.struct("text", *extra)).alias("d"))
    return found.select("s_order", "label", "d.text", *(f"d.{c}" for c in extra))


#: A row whose features take more than this share of the bound in bytes is not learned from.
ROW_SHARE = 64


def collected(features: DataFrame, size, max_bytes: int) -> pd.DataFrame:
    """The sample's features on the driver, by s_order: each row that, with those taken before it, is within ``max_bytes``.

    A row of over a ROW_SHARE-th of the bound is passed over, as is one that no longer fits; later
    ones go on being taken. So the driver's share is bounded in bytes as well as in rows, and no long
    text keeps others from being learned. It is an error if rows there are, but none within the bound.
    """
    stored = materialize(features, "sample")
    sizes = stored.groupBy("s_order").agg(F.sum(size).alias("n")).toPandas().sort_values("s_order")  # a row a sampled id
    taken, room = [], max_bytes
    for s_order, n in zip(sizes["s_order"].tolist(), sizes["n"].tolist()):
        if n <= min(room, max_bytes // ROW_SHARE):
            taken.append(s_order)
            room -= n
    if len(sizes) and not taken:
        raise ValueError(f"none of {len(sizes)} labelled rows is within {max_bytes // ROW_SHARE} bytes of features")
    if len(taken) < len(sizes):
        kept = stored.sparkSession.createDataFrame([(s,) for s in taken], "s_order long")
        stored = stored.join(F.broadcast(kept), "s_order")
    return stored.toPandas().sort_values("s_order", kind="stable")
