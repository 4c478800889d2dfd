"""Periodic runs of words, found by a descending-LCP Kruskal.

A run is a stretch of words with smallest period q, at least max(MIN_LENGTH, 2q) long, that no
neighbouring word extends. In each text the suffixes that share enough words are sorted (prefix
doubling) and neighbours united by decreasing common prefix, so that a class holds the suffixes that
agree on the current number of words. Classes keep their positions in order; the smaller is merged
into the larger. Two positions that become neighbours at level L and at distance d <= L agree on
exactly L words, so words from the first one on have period d for d + L words, and not one word
more. Were there a smaller period, a position in between would be in the class already; and the
first two periods of every run become neighbours at its level, by the theorem of Fine and Wilf. So
the seeds that no word extends to the left are the runs, each once. Levels below half of MIN_LENGTH
seed none, and only suffixes that share that many words with another are sorted.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.llm.common import table, text_of

MIN_LENGTH = 12
BLANKS = r"[\x20\x09-\x0D]+"
RUN = "struct<start:bigint,length:bigint,period:bigint>"
_ODD = np.random.default_rng(13).integers(1, 1 << 62, 64, dtype=np.int64) | 1


def _levels(w: np.ndarray) -> list[np.ndarray]:
    """Ranks of the stretches of 1, 2, 4, ... words from each position, until all differ; an end is below any word."""
    ranks, size = [np.unique(w, return_inverse=True)[1].astype(np.int64)], 1
    while size < len(w) and ranks[-1].max() < len(w) - 1:
        low = np.zeros(len(w), np.int64)
        low[: len(w) - size] = ranks[-1][size:] + 1
        ranks.append(np.unique(ranks[-1] * (len(w) + 1) + low, return_inverse=True)[1].astype(np.int64))
        size *= 2
    return ranks


def _edges(w: np.ndarray, at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, common words) of neighbours among the sorted suffixes ``at``, by decreasing common prefix, of at least ``least`` words."""
    ranks = _levels(w)
    sa = at[np.argsort(ranks[-1][at], kind="stable")]
    i, j = sa[:-1].copy(), sa[1:].copy()
    common = np.zeros(len(i), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        inside = np.maximum(i, j) + (1 << k) <= len(w)
        same = np.zeros(len(i), bool)
        same[inside] = ranks[k][i[inside]] == ranks[k][j[inside]]
        common[same] += 1 << k
        i[same] += 1 << k
        j[same] += 1 << k
    order = np.argsort(-common, kind="stable")
    order = order[common[order] >= least]
    return sa[:-1][order], sa[1:][order], common[order]


def find_runs(w: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of the word numbers ``w``, by start, then period."""
    least, n = (min_length + 1) // 2, len(w)
    if n < min_length:
        return []
    key = sum(w[i : n - least + 1 + i] * _ODD[i % len(_ODD)] for i in range(least))
    order = np.argsort(key, kind="stable")
    again = key[order][1:] == key[order][:-1]
    if not again.any():
        return []
    shared = np.zeros(len(key), bool)
    shared[order[1:][again]] = shared[order[:-1][again]] = True
    found: list[tuple[int, int, int]] = []
    classes: dict[int, list[int]] = {}
    up: dict[int, int] = {}
    words = w.tolist()

    def root(x: int) -> int:
        while (p := up.get(x, x)) != x:
            up[x] = x = up.get(p, p)
        return x

    def seed(i: int, j: int, level: int) -> None:
        d = j - i
        if d <= level and d + level >= min_length and (i == 0 or words[i - 1] != words[j - 1]):
            found.append((i, d + level, d))

    for i, j, level in zip(*(x.tolist() for x in _edges(w, np.flatnonzero(shared), least))):
        a, b = root(i), root(j)
        one, two = classes.pop(a, None) or [a], classes.pop(b, None) or [b]
        if len(one) < len(two):
            a, b, one, two = b, a, two, one
        up[b] = a
        if 8 * len(two) < len(one):
            # a class of neighbours gets few positions; pairs of two new ones are met from their left end
            for x in two:
                insort(one, x)
            new = set(two)
            for x in two:
                k = bisect_left(one, x)
                if k and one[k - 1] not in new:
                    seed(one[k - 1], x, level)
                if k + 1 < len(one) and one[k + 1] not in new:
                    seed(x, one[k + 1], level)
        else:
            new, merged = set(two), sorted(one + two)
            for x, y in zip(merged, merged[1:]):
                if (x in new) != (y in new):
                    seed(x, y, level)
            one = merged
        classes[a] = one
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay: all but those that a run holds after its first period."""
    cover = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return np.cumsum(cover)[:n] == 0


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_words, runs (start, length, period; by start, then period), collapsed.

    ``collapsed`` are the words that stay, joined by one space: each run's first period, and all words
    outside runs. Null and empty texts have no words, no runs and collapse to the empty text; very
    long ones are read whole. Repeated rows and null ids keep their rows; an empty table gives no
    rows; other columns, whatever their names, are not read. Overlapping runs are all reported.
    """
    if min_length < 2:
        raise ValueError("a run has at least two words")
    kind = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, runs, texts = [], [], []
            for t in b.column(1):
                words = t.as_py().encode("utf-8", "replace").split()
                number = {x: k for k, x in enumerate(dict.fromkeys(words))}
                own = find_runs(np.fromiter(map(number.__getitem__, words), np.int64, len(words)), min_length)
                kept = [x for x, k in zip(words, kept_words(len(words), own)) if k] if own else words
                counts.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), r)) for r in own])
                texts.append(b" ".join(kept).decode())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    own = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))
    return own.mapInArrow(run, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with repeats planted in a tenth of the texts, as op13's contract words it.

    With h the crc32 of the id and g = h // 10: where h % 10 = 0, word i >= a becomes word
    a + (i - a) % p, a = g % n, p = 1 + (n - a) // (3 + g % 8). A null id plants nothing.
    """
    ident = docs[id_col].cast("long")
    base = docs.select(ident.alias("doc_id"), text_of(docs, text_col).alias("text"), F.crc32(ident.cast("string").cast("binary")).alias("h"))
    words = F.filter(F.split("text", BLANKS), lambda x: x != "")
    g, n = F.floor(F.col("h") / 10), F.size("words").cast("long")
    cut = base.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("a", F.when(n > 0, g % n)).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    changed = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get("words", place(i))), " ")
    return cut.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def op13(spark, sf_dir: str) -> DataFrame:
    """Runs of all documents after planting, as digests; edge cases as in ``periodic_runs``."""
    found = periodic_runs(planted(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    out = found.withColumn("top", F.when(F.size("runs") > 0, longest))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
        F.floor(1000 * F.col("top.length") / -F.col("top.period")).alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )
