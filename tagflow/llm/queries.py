"""The registered queries of this subpackage, each over its whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagflow.llm import bestfit, decontaminate, gam, katz, linedup, packing, rules, runs, secrets, simhash, toxicity, warc, whiten
from tagflow.llm.common import table


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents; edge cases as in ``simhash.near_duplicates``."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages archived and read back; edge cases as in ``warc.round_trip``."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed; edge cases as in ``packing.pack_documents``."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines that repeated windows hold; edge cases as in ``linedup.dedup_lines``."""
    return linedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents hold; edge cases as in ``decontaminate.leaks``."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_quality_gam": gam.op1,
    "op2_simhash": op2,
    "op3_katz": katz.op3,
    "op4_toxicity_cnn": toxicity.op4,
    "op5_warc": op5,
    "op6_packing": op6,
    "op7_line_dedup": op7,
    "op8_secrets": secrets.op8,
    "op9_quality_rules": rules.op9,
    "op10_decontaminate": op10,
    "op11_whiten": whiten.op11,
    "op12_best_two_fit": bestfit.op12,
    "op13_periodic_runs": runs.op13,
}

ORACLE = {"op5_warc": warc.ORACLE, "op7_line_dedup": linedup.ORACLE, "op10_decontaminate": decontaminate.ORACLE}
