"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagflow.tables import materialize, new_path

__all__ = ["WORD", "fold", "fresh", "materialize", "new_path", "table", "text_of"]

#: Words are maximal runs of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(col_name: str, n: int):
    """crc32 of the id's text, modulo n: the fold of a row (null id: fold of the text '')."""
    return F.pmod(F.crc32(F.coalesce(F.col(col_name).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (case is ignored, as Spark does)."""
    have = {c.lower() for c in df.columns}
    name, k = stem, 0
    while name.lower() in have:
        k += 1
        name = f"{stem}_{k}"
    return name


def text_of(df: DataFrame, col_name: str = "text"):
    """The text column, null as empty."""
    return F.coalesce(df[col_name], F.lit(""))
