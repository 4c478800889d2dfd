"""Packing of whole documents by best-two-fit.

A document is cut only if it is longer than a window. A window is filled greedily, the largest piece
that fits first, until none fits; then its smallest piece is taken out if two unpacked pieces fill
the gap that this leaves more tightly, and filling goes on. Lengths are small integers, so pieces of
one length are one class: the largest class that fits a gap is looked up in a table, and the best
pair is found over classes, not pieces. Pieces are dealt at random to groups of about GROUP_WINDOWS
windows (fewer where pieces are tiny), as many as the table needs; each group is packed for itself and
leaves at most about one window unfilled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.llm.common import materialize, table
from tagflow.llm.packing import pieces, read_spec

CAPACITY = 2048
GROUP_WINDOWS = 2048
GROUP_PIECES = 200_000


def head_cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: full windows, the first piece holding what is over."""
    first = n % capacity or capacity
    return [(0, first)] + [(k, capacity) for k in range(first, n, capacity)]


class Classes:
    """How many unpacked pieces of each length there are, and the largest length at most v for every v."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
        have = self.count > 0
        self.below = np.maximum.accumulate(np.where(have, np.arange(capacity + 1), 0))

    def take(self, x: int) -> None:
        self.count[x] -= 1
        if not self.count[x]:
            rest = self.below[x:]
            rest[: np.searchsorted(rest, x, "right")] = self.below[x - 1]

    def give_back(self, x: int) -> None:
        self.count[x] += 1
        if self.count[x] == 1:
            rest = self.below[x:]
            rest[: np.searchsorted(rest, x, "left")] = x

    def best_pair(self, room: int) -> tuple[int, int]:
        """The two pieces of the largest sum within ``room``; (0, 0) where none fit."""
        a = np.flatnonzero(self.count[:room])
        if not len(a):
            return 0, 0
        b = self.below[np.minimum(room - a, a)]
        b = np.where((b == a) & (self.count[a] < 2), self.below[np.maximum(b - 1, 0)], b)
        total = np.where(b > 0, a + b, 0)
        k = int(np.argmax(total))
        return (int(a[k]), int(b[k])) if total[k] else (0, 0)


def windows(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """The lengths in each window, in the order in which they are packed."""
    left, out = Classes(lengths, capacity), []
    for _ in range(len(lengths)):
        if not left.below[capacity]:
            break
        own, gap = [], capacity

        def fill(own: list[int], gap: int) -> int:
            while x := int(left.below[gap]):
                left.take(x)
                own.append(x)
                gap -= x
            return gap

        gap = fill(own, gap)
        if gap and len(own) > 1:
            smallest = own[-1]
            a, b = left.best_pair(gap + smallest)
            if a + b > smallest:
                own.pop()
                left.take(a)
                left.take(b)
                left.give_back(smallest)
                own += [a, b]
                fill(own, gap + smallest - a - b)
        out.append(own)
    return out


def _pack_group(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["length", "uid"]).reset_index(drop=True)
    lengths = pdf["length"].to_numpy()
    packed = windows(lengths)
    flat = np.array([x for w in packed for x in w], np.int64)
    sizes = np.array([len(w) for w in packed])
    window = np.repeat(np.arange(len(packed)), sizes)
    before = np.cumsum(flat) - flat
    offset = before - np.repeat(before[np.cumsum(sizes) - sizes], sizes)
    # the k-th place of a length goes to the k-th piece of that length
    places = np.argsort(flat, kind="stable")
    pdf["sequence_id"] = pdf["grp"].to_numpy() * (1 << 20) + window[places]
    pdf["offset"] = offset[places]
    return pdf.drop(columns=["uid", "grp"])


def pack_whole(docs: DataFrame, tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one end id. Repeated rows are packed each for itself; null ids stay
    null. Empty input gives no rows. Further columns are not read. Texts are never cut before
    tokenising; the pieces of a long one are full windows, but for the first. ``tokenizer_path``
    names a tokenizers JSON file that the driver can read.
    """
    own = pieces(docs, read_spec(tokenizer_path), id_col=id_col, text_col=text_col, cut=head_cuts).drop("doc_tokens")
    own = own.withColumn("piece", F.ceil(F.col("start") / CAPACITY).cast("int")).withColumn("uid", F.monotonically_increasing_id())
    own = materialize(own.select("doc_id", "piece", "start", "length", "ids_crc32", "uid"), "pieces")
    small = own.where(F.col("length") < CAPACITY)
    size = small.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("ids"), F.count("*").alias("n")).first()
    groups = max(1, -(-size.ids // (GROUP_WINDOWS * CAPACITY)), -(-size.n // GROUP_PIECES))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    packed = small.withColumn("grp", F.pmod(F.xxhash64("uid"), F.lit(groups))).groupBy("grp").applyInPandas(_pack_group, schema)
    whole = own.where(F.col("length") == CAPACITY).withColumn("sequence_id", F.col("uid") + (1 << 61)).withColumn("offset", F.lit(0).cast("long")).drop("uid")
    return packed.unionByName(whole)


def op12(spark, sf_dir: str) -> DataFrame:
    """All documents packed; edge cases as in ``pack_whole``."""
    return pack_whole(table(spark, sf_dir, "documents"))
