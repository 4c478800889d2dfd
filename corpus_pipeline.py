"""Cleaning of a training corpus in five stages, each over all that the one before kept.

Every stage takes nulls in any column, empty and very long texts, repeated rows, ties, columns with
clashing names and empty tables; what it does with them its docstring says. All but the last return
the columns of their input, as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagflow.llm import decontaminate, linedup, packing, simhash, toxicity
from tagflow.llm.common import fold, materialize, table

#: The toxicity model and the packing have no SQL form; tests compare stages with plain Python.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity reaches their language's threshold go.

    Each row is judged by its own text, read whole, null as empty; a null language has the default
    threshold. Repeated rows stay or go together. An empty table stays empty.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), "toxic", fold("doc_id", 4) != 2)
    return toxicity.keep_clean(docs, model)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated three-line windows are cut; a document of which no line is left goes.

    Null, empty and shorter texts stay. Rows alike in id and text are one document and keep or lose
    the same lines; of other occurrences that with the smallest id stays, null ids last.
    """
    cut = linedup.dedup_lines(docs)
    n_lines, n_removed = cut.columns[-2:]
    left = cut.where((F.col(n_removed) < F.col(n_lines)) | (F.col(n_removed) == 0))
    fresh = {"n_chars": F.length("text").cast("long")} if "n_chars" in docs.columns else {}
    return left.withColumns(fresh).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that with the smallest id, nulls last, then by text.

    Texts without a word, null ones too, are one group. Rows alike in id and text are one document.
    """
    return simhash.keep_one(docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, each by its own text, with or without an id.

    Null and empty texts hold none; repeated rows stay or go together.
    """
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 1024 ids.

    Null and empty texts are one end id; repeated rows are packed each for itself; null ids stay null.
    """
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("line dedup", cut_lines), ("simhash", one_of_each), ("decontamination", drop_leaked), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
