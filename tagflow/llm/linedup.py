"""Line dedup over overlapping windows of three lines, in DataFrame functions alone.

Each line is hashed; a window is three hashes in a row. Windows that occur twice or more are found
by one aggregation with partial sums, so a passage that many documents share is one row a map task.
Occurrences other than the first, by (doc_id, position), lose the lines they cover. The join of
occurrences with repeated windows reads the latter from a table, so that Spark may split the hot
ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.llm.common import fresh, materialize, text_of

WINDOW = 3


def _keys(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column]:
    """A row is known by id and text: rows alike in both are one document, told once."""
    return F.coalesce(docs[id_col].cast("long"), F.lit((1 << 63) - 1)), F.xxhash64(text_of(docs, text_col))


def windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(w_id, w_th, p, a, b, c): the window's document, first line from 0 and line hashes.

    Windows of three empty lines are left out.
    """
    w_id, w_th = _keys(docs, id_col, text_col)
    hashes = F.transform(F.split(text_of(docs, text_col), "\n"), lambda x: F.xxhash64(x))
    one = docs.select(w_id.alias("w_id"), w_th.alias("w_th"), hashes.alias("h")).where(F.size("h") >= WINDOW)
    n = F.size("h") - (WINDOW - 1)
    out = one.select("w_id", "w_th", F.posexplode(F.arrays_zip(*(F.slice("h", k + 1, n).alias(x) for k, x in enumerate("abc")))).alias("p", "w"))
    empty = F.xxhash64(F.lit(""))
    return out.select("w_id", "w_th", "p", "w.a", "w.b", "w.c").where(~((F.col("a") == empty) & (F.col("b") == empty) & (F.col("c") == empty)))


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(w_id, w_th, gone): the line positions that later occurrences of windows cover.

    A later occurrence that overlaps the first one of its own window leaves the first one whole.
    """
    occ = windows(docs, id_col, text_col)
    repeated = occ.groupBy("a", "b", "c").agg(F.min(F.struct("w_id", "w_th", "p")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = occ.join(materialize(repeated, "windows"), ["a", "b", "c"]).where(F.struct("w_id", "w_th", "p") != F.col("first"))
    own = (F.col("first.w_id") == F.col("w_id")) & (F.col("first.w_th") == F.col("w_th"))
    start = F.when(own, F.greatest(F.col("p"), F.col("first.p") + WINDOW)).otherwise(F.col("p"))
    covered = later.select("w_id", "w_th", F.explode(F.sequence(start, F.col("p") + WINDOW - 1)).alias("line"))
    return covered.groupBy("w_id", "w_th").agg(F.collect_set("line").alias("gone"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text cut, and n_lines and n_removed at the end (named anew on a clash).

    Lines are split at line feeds and compared as they are. Texts of fewer than three lines stay.
    A text whose lines all go becomes empty. Null texts stay null, with no lines. Rows alike in id
    and text count as one document; null ids come last. Further columns are kept as they are.
    """
    w_id, w_th = _keys(docs, id_col, text_col)
    a, b, gone, lines = (fresh(docs, x) for x in ("w_id", "w_th", "gone", "lines"))
    cut = removals(docs, id_col, text_col).toDF(a, b, gone)
    keyed = docs.withColumn(a, w_id).withColumn(b, w_th).join(cut, [a, b], "left")
    split = keyed.withColumn(lines, F.split(text_of(keyed, text_col), "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    kept = F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    text = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(kept)
    counts = {
        fresh(docs, "n_lines"): F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("long"),
        fresh(docs, "n_removed"): F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long"),
    }
    return split.select(*(text.alias(c) if c == text_col else F.col(c) for c in docs.columns), *(e.alias(k) for k, e in counts.items()))


#: Text comparison instead of hashes; otherwise the rules above.
ORACLE = """
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
w AS (SELECT doc_id, p, l[p + 1] AS a, l[p + 2] AS b, l[p + 3] AS c
      FROM (SELECT doc_id, l, unnest(range(len(l) - 2)) AS p FROM d WHERE len(l) >= 3)),
f AS (SELECT *, first_value(doc_id) OVER o AS fd, first_value(p) OVER o AS fp, row_number() OVER o AS k
      FROM w WHERE a <> '' OR b <> '' OR c <> '' WINDOW o AS (PARTITION BY a, b, c ORDER BY doc_id, p)),
g AS (SELECT DISTINCT doc_id, unnest(range(CASE WHEN fd = doc_id THEN greatest(p, fp + 3) ELSE p END, p + 3)) AS i FROM f WHERE k > 1),
x AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i FROM d),
k AS (SELECT x.doc_id, string_agg(line, chr(10) ORDER BY i) AS kept FROM x ANTI JOIN g ON x.doc_id = g.doc_id AND x.i = g.i GROUP BY 1),
c AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(kept, '') END AS text,
  CASE WHEN d.text IS NULL THEN 0 ELSE len(l) END AS n_lines, coalesce(c.n, 0) AS n_removed
FROM d LEFT JOIN k ON d.doc_id = k.doc_id LEFT JOIN c ON d.doc_id = c.doc_id
"""
