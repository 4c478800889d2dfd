"""Benchmark decontamination by spaced seeds, in DataFrame functions alone.

Tokens are runs of letters and digits of the lower-cased text. A mask takes some tokens of a short
stretch and ignores the others, so a seed survives substitutions at ignored places. Seeds of all
document positions are joined with those of the benchmark; each hit names a document, an item and
the shift between them. Along that shift the item's tokens around the hit, to both ends of the item,
are compared with the document's. An item too short for a mask is one seed, of all its tokens.
The benchmark side is broadcast only if its seed count is within BROADCAST_SEEDS; beyond, the seeds
are joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.llm.common import fresh, materialize, text_of

TOKEN_GAP = r"[^\p{L}\p{N}]+"
#: Fixed masks: the positions that a seed takes.
MASKS = ((0, 1, 3, 4), (0, 2, 3, 5))
SPAN = 6
#: Leaked: matches at least min(ENOUGH, SHARE of the item's tokens), and FEWEST.
SHARE, ENOUGH, FEWEST = 0.6, 13, 5
BROADCAST_SEEDS = 500_000


def tokens(text: Column) -> Column:
    """Hashes of the text's tokens in order."""
    return F.transform(F.filter(F.split(F.lower(text), TOKEN_GAP), lambda x: x != ""), lambda x: F.xxhash64(x))


def seeds(rows: DataFrame, h: str, keep: list[str], lengths: tuple[int, ...] = (), whole: bool = False) -> DataFrame:
    """keep..., p, mask, seed for every position at which a mask fits the hashes in ``h``.

    The last positions are padded with nulls, so the shorter mask is tried there as well. With
    ``lengths`` every stretch of so many tokens is a seed too; its mask is minus the length. If
    ``whole``, only a stretch that is all of ``h`` is.
    """
    wide = F.arrays_zip(*(F.slice(h, k + 1, F.greatest(F.size(h) - k, F.lit(0))).alias(f"t{k}") for k in range(SPAN)))
    fits = F.size(h) >= (min(lengths) if lengths else FEWEST)
    at = rows.where(fits).select(*keep, F.size(h).alias("n"), F.posexplode(wide).alias("p", "t"))
    cells = [((m, mask), F.lit(True)) for m, mask in enumerate(MASKS)] + [((-n, tuple(range(n))), (F.col("n") == n) if whole else F.lit(True)) for n in lengths]
    each = [F.struct(F.lit(m).alias("mask"), F.when(F.col(f"t.t{mask[-1]}").isNotNull() & may, F.xxhash64(*(F.col(f"t.t{k}") for k in mask))).alias("seed")) for (m, mask), may in cells]
    return at.select(*keep, "p", F.inline(F.array(*each))).where("seed is not null")


def _matches(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str) -> DataFrame:
    """(key, id, item, item_id, matched, item_tokens) of every document, known by ``key``, and item that it holds."""
    items = benchmark.select(benchmark[item_col].alias("item_id"), tokens(text_of(benchmark, item_text)).alias("b"))
    items = items.where(F.size("b") > 0).groupBy("b").agg(F.min("item_id").alias("item_id")).withColumn("item", F.monotonically_increasing_id())
    items = materialize(items.withColumn("size", F.size("b")), "items")
    short = items.where(F.size("b") < FEWEST).select(F.size("b").alias("n")).distinct().collect()  # at most four values
    lengths = tuple(sorted(r.n for r in short))
    known = seeds(items, "b", ["item", "size"], lengths, whole=True).withColumnRenamed("p", "q")
    small = known.count() <= BROADCAST_SEEDS
    near = F.broadcast if small else (lambda df: df)
    doc = docs.select(docs[id_col].cast("long").alias("id"), text_of(docs, text_col).alias("text"))
    doc = doc.withColumn("key", F.xxhash64("id", "text"))
    own = seeds(doc.select("key", tokens(F.col("text")).alias("h")), "h", ["key"], lengths)
    hits = own.join(near(known), ["mask", "seed"]).select("key", "item", "size", (F.col("p") - F.col("q")).alias("shift")).distinct()
    hits = materialize(hits, "hits")
    held = doc.join(hits.select("key").distinct(), "key", "left_semi").select("key", "id", tokens(F.col("text")).alias("h"))
    # a row keeps the item's length of the document's tokens, however many shifts a long text has
    before = F.greatest(-F.col("shift"), F.lit(0))
    along = F.slice("h", F.col("shift") + before + 1, F.col("size") - before)
    both = held.join(hits, "key").select("key", "id", "item", before.alias("before"), along.alias("w")).join(near(items), "item")
    same = F.size(F.filter(F.sequence(F.lit(0), F.size("b") - 1), lambda i: F.get("b", i) == F.get("w", i - F.col("before"))))
    n = F.col("size")
    enough = F.when(n < FEWEST, n).otherwise(F.greatest(F.lit(FEWEST), F.least(F.lit(ENOUGH), F.ceil(n * SHARE))))
    found = both.select("key", "id", "item", "item_id", same.alias("matched"), n.alias("item_tokens"), enough.alias("enough"))
    return found.where("matched >= enough").drop("enough")


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, item_id, matched, item_tokens.

    ``matched`` is the most tokens equal along one shift; it is at least 13, or 60 % of a shorter
    item, and never below 5. Of an item with fewer than five tokens all must be equal, next to one
    another. Items alike in their tokens count as one, named by the smallest id (null if none has
    one). Null, empty and token-free texts match nothing; very long ones are read whole. Rows that
    share an id, nulls too, give one row per item with the best match. Empty input, on either side,
    gives no rows. Further columns are not read.
    """
    found = _matches(docs, benchmark, id_col, text_col, item_col, item_text)
    best = found.groupBy("id", "item").agg(F.first("item_id").alias("item_id"), F.max("matched").cast("long").alias("matched"), F.max("item_tokens").cast("long").alias("item_tokens"))
    return best.select(F.col("id").alias("doc_id"), "item_id", "matched", "item_tokens")


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; the rest as they are.

    A row is judged by its own text, so of rows that share an id, or have none, only those that hold
    an item go. Nulls, empty texts and empty tables: as in ``leaks``.
    """
    key = fresh(docs, "leak_key")
    gone = _matches(docs, benchmark, id_col, text_col, "item_id", "text").select(F.col("key").alias(key)).distinct()
    keyed = docs.withColumn(key, F.xxhash64(docs[id_col].cast("long"), text_of(docs, text_col)))
    return keyed.join(gone, key, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


#: Tokens are compared as text, not by hashes; otherwise the rules above.
ORACLE = """
WITH b0 AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS b FROM benchmark),
b AS (SELECT min(item_id) AS item_id, b FROM b0 WHERE len(b) > 0 GROUP BY b),
d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS h FROM documents),
bp AS (SELECT item_id, b AS t, unnest(range(1, len(b) - 3)) AS p FROM b WHERE len(b) >= 5),
dp AS (SELECT doc_id, h AS t, unnest(range(1, len(h) - 3)) AS p FROM d WHERE len(h) >= 5),
bs AS (SELECT item_id, p, [t[p], t[p + 1], t[p + 3], t[p + 4]] AS s, 0 AS m FROM bp
       UNION ALL SELECT item_id, p, [t[p], t[p + 2], t[p + 3], t[p + 5]], 1 FROM bp WHERE p + 5 <= len(t)),
ds AS (SELECT doc_id, p, [t[p], t[p + 1], t[p + 3], t[p + 4]] AS s, 0 AS m FROM dp
       UNION ALL SELECT doc_id, p, [t[p], t[p + 2], t[p + 3], t[p + 5]], 1 FROM dp WHERE p + 5 <= len(t)),
hits AS (SELECT DISTINCT doc_id, item_id, ds.p - bs.p AS shift FROM ds JOIN bs ON ds.m = bs.m AND ds.s = bs.s),
v AS (SELECT doc_id, item_id, len(list_filter(range(1, len(b) + 1), lambda i: i + shift >= 1 AND b[i] = h[i + shift])) AS matched, len(b) AS n
      FROM hits JOIN b USING (item_id) JOIN d USING (doc_id))
SELECT doc_id, item_id, cast(max(matched) AS bigint) AS matched, cast(max(n) AS bigint) AS item_tokens FROM v
WHERE matched >= greatest(5, least(13, ceil(n * 0.6))) GROUP BY doc_id, item_id
UNION ALL
SELECT DISTINCT doc_id, item_id, cast(len(b) AS bigint), cast(len(b) AS bigint) FROM b JOIN
  (SELECT doc_id, h, unnest(range(1, len(h) + 1)) AS p FROM d WHERE EXISTS (SELECT 1 FROM b WHERE len(b) < 5)) s ON len(b) < 5 AND h[p:p + len(b) - 1] = b
"""
