"""SimHash near-duplicates by a binary-trie self-join.

Fingerprints are 64 bits over 3-word shingles. Two fingerprints link when at most three bits
differ. Of the four 16-bit quarters at least one is then equal, so the trie is built four times,
each time rotated so that another quarter comes first, and its first 16 levels get an error budget
of zero: a subtrie below level 16 is paired with itself alone. That makes subtries the unit which
Spark deals out; below, node pairs are walked together level by level, differing bits add up, and a
pair goes as soon as it is over budget. A subtrie with more than ROWS_PER_TRIE leaves is dealt out
once more: of the four 12-bit parts below its root one is again equal, so it becomes four rotated
subtries with 28 levels of budget zero, whose subtries go to tasks of their own.

Only distinct fingerprints enter the join, so any number of exact copies is one leaf. Each task
returns a star per connected set rather than all pairs; the stars are joined into components by
alternating large-star and small-star rounds over DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.llm.common import fresh, materialize, text_of

SEED = 42
MAX_BITS = 3
QUARTER, PART = 16, 12
#: Fingerprint rows that one trie task gets on average, and that a subtrie is split beyond.
ROWS_PER_TRIE = 100_000
#: Node pairs walked at once in a task; longer frontiers are cut and walked piece by piece.
FRONTIER = 1 << 20
SMALL = 32


def fingerprint(text: str | None, k: int = 3) -> int:
    """64-bit SimHash: a bit is set if more than half of the shingles' hashes have it."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < k:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    ones, n = np.zeros(64, np.int64), len(words) - k + 1
    for at in range(0, n, 65536):
        part = words[at : at + 65536 + k - 1]
        hashes = np.fromiter((digest(join(s), SEED) for s in zip(*(part[i:] for i in range(k)))), np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, fp): one row per document row; ``th`` hashes the text, ``fp`` holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py()) for t in b.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], names=["id", "th", "fp"])

    text = text_of(docs, text_col)
    return docs.select(docs[id_col].cast("long").alias("id"), F.xxhash64(text).alias("th"), text.alias("text")).mapInArrow(run, "id long, th long, fp long")


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def trie_links(fps: np.ndarray, roots: np.ndarray, budget: int = MAX_BITS, depth: int = QUARTER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of ``fps`` that share a root and differ in at most ``budget`` bits.

    ``fps`` are distinct, rotated so that the root's ``depth`` bits are on top, and sorted by (root, fp).
    """
    edges = np.flatnonzero(np.r_[True, roots[1:] != roots[:-1]])
    lo, hi = edges, np.r_[edges[1:], len(fps)]
    keep = hi - lo > 1
    lo, hi = lo[keep], hi[keep]
    stack = [(63 - depth, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    zeros: dict[int, np.ndarray] = {}
    while stack:
        bit, alo, ahi, blo, bhi, err = stack.pop()
        if not len(alo):
            continue
        if len(alo) > FRONTIER:
            h = len(alo) // 2
            stack += [(bit, alo[:h], ahi[:h], blo[:h], bhi[:h], err[:h]), (bit, alo[h:], ahi[h:], blo[h:], bhi[h:], err[h:])]
            continue
        na, nb = ahi - alo, bhi - blo
        small = (na * nb <= SMALL) | (bit < 0)
        if small.any():
            s = np.flatnonzero(small)
            for c in np.array_split(s, max(1, int((na[s] * nb[s]).sum()) // (4 * FRONTIER) + 1)):
                cells = na[c] * nb[c]
                r, n = _ranges(cells), np.repeat(nb[c], cells)
                i, j = np.repeat(alo[c], cells) + r // n, np.repeat(blo[c], cells) + r % n
                near = (i < j) & (np.bitwise_count(fps[i] ^ fps[j]) <= budget)
                if near.any():
                    yield i[near], j[near]
            big = ~small
            alo, ahi, blo, bhi, err = alo[big], ahi[big], blo[big], bhi[big], err[big]
        if not len(alo):
            continue
        if bit not in zeros:
            zeros[bit] = np.r_[0, np.cumsum(((fps >> np.uint64(bit)) & np.uint64(1)) == 0)]
        z, same = zeros[bit], (alo == blo) & (ahi == bhi)
        am, bm = alo + z[ahi] - z[alo], blo + z[bhi] - z[blo]
        cross = ~same
        parts = [(alo, am, blo, bm, err), (am, ahi, bm, bhi, err), (alo, am, bm, bhi, err + 1), (am[cross], ahi[cross], blo[cross], bm[cross], err[cross] + 1)]
        alo, ahi, blo, bhi, err = (np.concatenate([p[k] for p in parts]) for k in range(5))
        live = (ahi > alo) & (bhi > blo) & (err <= budget)
        live &= ~((alo == blo) & (ahi == bhi) & (ahi - alo == 1))
        stack.append((bit - 1, alo[live], ahi[live], blo[live], bhi[live], err[live].astype(np.int8)))


def _stars(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest reachable index of each of n nodes."""
    label = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = label[i], label[j]
            open_ = a != b
            if not open_.any():
                break
            low, high = np.minimum(a, b)[open_], np.maximum(a, b)[open_]
            np.minimum.at(label, high, low)
            while (label[label] != label).any():
                label = label[label]
    while (label[label] != label).any():
        label = label[label]
    return label


def _trie_task(pdf: pd.DataFrame) -> pd.DataFrame:
    out, low48 = [], np.uint64((1 << 48) - 1)
    for (turn, part), group in pdf.groupby(["turn", "part"], sort=False):
        fp = group["fp"].to_numpy().view(np.uint64)
        shift, depth = np.uint64(QUARTER * int(turn)), QUARTER
        rot = fp if not shift else (fp << shift) | (fp >> (np.uint64(64) - shift))
        if part >= 0:
            depth += PART
            turned, low = np.uint64(PART * int(part)), rot & low48
            rot = (rot & ~low48) | (((low << turned) | (low >> (np.uint64(48) - turned))) & low48)
        order = np.argsort(rot)
        rot, fp = rot[order], fp[order]
        label = _stars(len(rot), trie_links(rot, rot >> np.uint64(64 - depth), depth=depth))
        off = np.flatnonzero(label != np.arange(len(label)))
        out.append(pd.DataFrame({"u": fp[off].view(np.int64), "v": fp[label[off]].view(np.int64)}))
    return pd.concat(out) if out else pd.DataFrame({"u": np.empty(0, np.int64), "v": np.empty(0, np.int64)})


def links(classes: DataFrame, n: int, rows_per_trie: int = ROWS_PER_TRIE) -> DataFrame:
    """Star edges (u, v) that connect what links among ``n`` distinct fingerprints ``fp``."""
    buckets = max(1, -(-4 * n // rows_per_trie))
    turns = classes.select("fp", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("turn"))
    turns = turns.withColumn("rot", F.expr(f"shiftleft(fp, {QUARTER} * turn) | shiftrightunsigned(fp, 64 - {QUARTER} * turn)"))
    turns = turns.withColumn("top", F.shiftrightunsigned("rot", 64 - QUARTER))
    large = turns.groupBy("turn", "top").count().where(F.col("count") > rows_per_trie).select("turn", "top", F.lit(True).alias("large"))
    split = turns.join(F.broadcast(large), ["turn", "top"], "left")  # at most four times 65,536 subtries
    parts = F.when(F.col("large"), F.array(*map(F.lit, range(4)))).otherwise(F.array(F.lit(-1)))
    split = split.select("fp", "turn", "top", "rot", F.explode(parts).alias("part"))
    below = F.expr(f"CASE WHEN part >= 0 THEN shiftrightunsigned(rot, 48 - {PART} * (part + 1)) & {(1 << PART) - 1} END")
    dealt = split.withColumn("bucket", F.pmod(F.xxhash64("turn", "top", "part", below), F.lit(buckets)))
    return dealt.select("fp", "turn", "part", "bucket").groupBy("bucket").applyInPandas(_trie_task, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's connected component, for nodes with an edge.

    Alternates large-star and small-star rounds until the edges stay as they are, which takes about
    the squared logarithm of the longest path; nothing but two aggregates a round comes to the driver.
    """

    def sign(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = sign(edges)
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        edges = materialize(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        now = sign(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v"), F.col("v")).distinct())


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """((id, th, fp) of every row, (fp, root, component_id) of every distinct fingerprint)."""
    own = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = materialize(own.groupBy("fp").agg(F.min("id").alias("first_id")), "classes")
    roots = components(links(classes, classes.count()))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return own, materialize(rooted.join(named, "root").select("fp", "root", "component_id"), "members")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest id reachable over links of three bits or fewer, itself
    included. A null or empty text has fingerprint zero and links like any other; very long texts
    are read whole. A row with a null id belongs to its fingerprint's component but never names one
    (a component of such rows alone has a null one). Repeated rows each give a row, ties can't
    arise. Empty input gives no rows. Other columns of ``docs``, whatever their names, are not read.
    """
    own, member = grouped(docs, id_col, text_col)
    return own.join(member, "fp").select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id, nulls last.

    Of rows that tie for it (a repeated id, or none but null ids) that with the smallest hash of its
    text stays; rows alike in id and text are one document, of which one row stays. All columns are
    kept as they are, and may have any name. Empty input gives no rows.
    """
    own, member = grouped(docs, id_col, text_col)
    order = F.struct(F.col("id").isNull().alias("no_id"), F.coalesce("id", F.lit(0)).alias("id"), "th")
    first = own.groupBy("fp").agg(F.min(order).alias("k")).join(member.select("fp", "root"), "fp")
    kept = materialize(first.groupBy("root").agg(F.min("k").alias("k")).select("k.no_id", "k.id", "k.th"), "kept")
    names = [fresh(docs, x) for x in ("kept_no_id", "kept_id", "kept_th")]
    ident = docs[id_col].cast("long")
    keyed = docs.withColumns(dict(zip(names, (ident.isNull(), F.coalesce(ident, F.lit(0)), F.xxhash64(text_of(docs, text_col))))))
    return keyed.join(kept.toDF(*names), names, "left_semi").dropDuplicates(names).select(*(F.col(f"`{c}`") for c in docs.columns))
