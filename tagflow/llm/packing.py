"""Packing of token sequences by Karmarkar-Karp multiway differencing.

Texts are tokenised once; each document's ids, with the end id, are cut into whole windows and a
remainder of near-equal pieces of at most PIECE ids. Whole windows are sequences as they are. The
other pieces are dealt at random to groups of about GROUP_WINDOWS windows, as many groups as the
table needs, and each group is packed for itself: partial partitions with the largest imbalance are
merged, the fullest window of one with the emptiest of the other, until one partition is left; if
a window is over capacity, the group gets another window and starts anew.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.llm.common import materialize, text_of

CAPACITY = 1024
PIECE = 256
GROUP_WINDOWS = 128
#: Letters on whose classes any two regular-expression engines might differ.
_NOT_LATIN = "[\x1c-\x1f\u0250-\U0010ffff]"


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 bytes stand
    for themselves, the others for the letters from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Token ids as little-endian 32-bit bytes, for byte-level BPE tokenizers.

    The ids are those of the tokenizers library. Texts of Latin letters without a special token's
    text go through the same merges in tiktoken, which is several times as fast on words that it
    has not met; all other texts go through tokenizers itself.
    """

    def __init__(self, spec: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.model, letters = Tokenizer.from_str(spec), byte_letters()
        parts = json.loads(spec)
        vocabulary = parts["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in parts["model"]["merges"]]
        tokens = sorted(letters, key=letters.get) + [a + b for a, b in merges]
        ranks = {bytes(letters[c] for c in t): k for k, t in enumerate(tokens)}
        self.ids = np.array([vocabulary[t] for t in tokens], "<u4")
        other = [re.escape(t["content"]) for t in parts.get("added_tokens", [])]
        self.slow = re.compile("|".join([_NOT_LATIN, *other]))
        self.fast = tiktoken.Encoding("merges", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if self.slow.search(text):
            return np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.ids[np.array(self.fast.encode_ordinary(text), np.int64)].tobytes()


@lru_cache(maxsize=2)
def encoder(spec: str) -> Encoder:
    """One a worker: kept between tasks."""
    return Encoder(spec)


def read_spec(path: str | None = None) -> str:
    """The text of a tokenizers JSON file that the driver can read; by default the public byte-level vocabulary."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def cuts(n: int, capacity: int = CAPACITY, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, length): whole windows, then near-equal pieces of at most ``piece``."""
    whole, rest = divmod(n, capacity)
    parts = [(k * capacity, capacity) for k in range(whole)]
    if rest:
        k = -(-rest // piece)
        edges = [whole * capacity + rest * i // k for i in range(k + 1)]
        parts += [(a, b - a) for a, b in zip(edges, edges[1:])]
    return parts


def pieces(docs: DataFrame, spec: str, end_id: int = 0, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text", cut: Callable[[int], list[tuple[int, int]]] = cuts) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): every id of every row in one piece; ``cut`` gives (start, length) of so many ids.

    A null or empty text is the end id alone; repeated rows and null ids keep their rows; an empty
    table gives none; very long texts are read whole; further columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value)
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            for ident, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = encode(text.as_py()) + end
                n = len(ids) // 4
                for start, length in cut(n):
                    own = ids[4 * start : 4 * (start + length)]
                    for c, v in zip(out, (ident, start, length, zlib.crc32(own), n, own if with_ids else None)):
                        c.append(v)
            kinds = [pa.int64()] * 5 + [pa.binary()] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=[x.split()[0] for x in schema.split(", ")])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text")).mapInArrow(run, schema)


def differencing(lengths: list[int], k: int) -> tuple[list[int], np.ndarray]:
    """Karmarkar-Karp: (the k sums, window of each item). Ties go by item order."""
    n = len(lengths)
    parent = np.arange(n)
    sums, reps = {}, {}
    heap = []
    for i, x in enumerate(lengths):
        s, r = np.zeros(k, np.int64), np.full(k, -1)
        s[0], r[0] = x, i
        sums[i], reps[i] = s, r
        heap.append((-x if k > 1 else 0, i))
    heapq.heapify(heap)
    fresh = n
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        sa, ra, sb, rb = sums.pop(a), reps.pop(a), sums.pop(b)[::-1], reps.pop(b)[::-1]
        both = (ra >= 0) & (rb >= 0)
        parent[rb[both]] = ra[both]
        s, r = sa + sb, np.where(ra >= 0, ra, rb)
        order = np.argsort(-s, kind="stable")
        sums[fresh], reps[fresh] = s[order], r[order]
        heapq.heappush(heap, (int(s[order[-1]] - s[order[0]]), fresh))
        fresh += 1
    while (parent[parent] != parent).any():
        parent = parent[parent]
    last = heap[0][1]
    window = np.empty(n, np.int64)
    for w, r in enumerate(reps[last]):
        if r >= 0:
            window[parent == r] = w
    return [int(x) for x in sums[last]], window


def pack(lengths: list[int], capacity: int = CAPACITY) -> np.ndarray:
    """Window of each item; as few windows as differencing fills without one over capacity."""
    k = max(1, -(-sum(lengths) // capacity))
    while True:
        sums, window = differencing(lengths, k)
        if max(sums) <= capacity:
            return window
        k += 1


def _pack_group(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("uid").reset_index(drop=True)
    window = pack(pdf["length"].tolist())
    pdf["sequence_id"] = pdf["grp"] * (1 << 20) + window
    pdf["offset"] = pdf.groupby("sequence_id")["length"].cumsum() - pdf["length"]
    return pdf.drop(columns=["uid", "grp"])


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are one end id. Repeated rows are packed each for itself; null ids stay
    null. Empty input gives no rows. Further columns are not read. Texts are never cut before
    tokenising. ``tokenizer_path`` names a tokenizers JSON file that the driver can read.
    """
    spec = read_spec(tokenizer_path)
    own = materialize(pieces(docs, spec, id_col=id_col, text_col=text_col).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    total = own.where(F.col("length") < CAPACITY).agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // (GROUP_WINDOWS * CAPACITY)))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    part = own.where(F.col("length") < CAPACITY).withColumn("grp", F.pmod(F.xxhash64("uid"), F.lit(groups)))
    packed = part.groupBy("grp").applyInPandas(_pack_group, schema)
    whole = own.where(F.col("length") == CAPACITY).withColumn("sequence_id", F.col("uid") + (1 << 61)).withColumn("offset", F.lit(0).cast("long")).drop("uid")
    return packed.unionByName(whole)
