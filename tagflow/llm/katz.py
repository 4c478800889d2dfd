"""Katz back-off bigram model: Good-Turing discounts, exactly normalised back-off weights.

P(w|h) is d(c)·c(h,w)/c(h) where the pair was seen, else alpha(h)·P(w); P(w) is the same rule one
order down, with the mass left by discounting given to one class of unknown words. Counts up to
K_GT are discounted by Good-Turing, larger ones by EPSILON, so every history leaves mass.

The model is tables in one folder: ``ngrams`` (order, bucket; h, w, c, cw) with the counts of words
(order 1) and of pairs (order 2), partitioned by order and bucket; ``weights`` (bucket; h, total,
weight) with alpha(h)·c(h), partitioned by bucket; ``hot`` and ``meta`` with the frequent words and
a handful of numbers. Any texts can be scored from them later (``load``, ``score``).

Training. One pass counts words. One shuffle brings the pairs, packed by batch, to their
buckets, where they are counted and written; the weights come from the written pairs by one
aggregation over histories. Words seen twice and with at least a HOT-th of all tokens, at
most HOT of them, are broadcast with their counts and dealt by (h, w); other words are dealt by w,
so a bucket knows its words' counts and no word's share of the corpus lands in one bucket.

Scoring. A bucket's task evaluates its tokens by the bucket's counts: the pair's discounted count if
it was seen, else, one order down, the word's probability, to which the history's weight is still
owed. Where a corpus is scored by a model of its own rows (``katz_scores``), that is the task which
counts them, and the shuffle of training brings the rows that are only scored along; other texts
(``score``) are dealt the same way to tasks that read the bucket's two count tables. What a bucket
returns is summed by document: tokens of pairs seen up to K_GT times by their count, as their
discounts are known when all buckets are counted, and the tokens that owe a weight by history, to be
joined with ``weights``. The denominator c(h) of a token is charged where h itself is looked up, as
every word but the end is the history of just one token.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagflow.llm.common import fold, materialize, new_path, table, text_of
from tagflow.tables import brief_shuffles, setting

K_GT = 5
EPSILON = 1e-4
#: A word is hot with 1/HOT of the training tokens, so at most HOT words are broadcast.
HOT = 50_000
#: Tokens a bucket of the tables; tokens of other texts that a scoring task gets at once.
BUCKET_TOKENS, SCORE_TOKENS = 1_500_000, 2_500_000
FLUSH_TOKENS = 1_500_000
CACHE_WORDS = 300_000
#: Rows that a task hands on at once; partitions that it writes at once without sorting its rows.
BATCH_ROWS, WRITERS = 50_000, 8
END = b"\n"
START = -1
WEIGHTS = "h long, total long, weight double, bucket int"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def discounts(n: list[int]) -> list[float]:
    """Good-Turing d(1..K_GT) from n[r-1] items seen r times, r up to K_GT + 1.

    Where the counts of counts give r no value between 0 and 1, it is (r - 1/2) / r instead.
    """
    d = []
    a = (K_GT + 1) * n[K_GT] / n[0] if n[0] else 1.0
    for r in range(1, K_GT + 1):
        x = ((r + 1) * n[r] / (n[r - 1] * r) - a) / (1 - a) if a < 1 and n[r - 1] else 0.0
        d.append(x if 0 < x < 1 else (r - 0.5) / r)
    return d


def word_counts(docs: DataFrame) -> DataFrame:
    """(word binary, c long, other long) over rows of (text, learn): occurrences in rows to learn from, and in others; one end token a row."""
    names = ["word", "c", "other"]

    def sums(*got: Counter) -> Iterator[pa.RecordBatch]:
        for k, x in enumerate(got):
            c = [pa.array(list(x.values()), pa.int64()), pa.array(np.zeros(len(x), np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.binary()), c[k], c[1 - k]], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got, size = (Counter(), Counter()), 0
            for t, learn in zip(b.column(0), b.column(1).to_pylist()):
                w = words_of(t.as_py())
                w.append(END)
                got[not learn].update(w)
                size += len(w)
                if size > 2 * FLUSH_TOKENS:
                    yield from sums(*got)
                    got, size = (Counter(), Counter()), 0
            yield from sums(*got)

    return docs.select("text", "learn").mapInArrow(run, "word binary, c long, other long").groupBy("word").agg(F.sum("c").alias("c"), F.sum("other").alias("other"))


class _Ids(dict):
    """Hot words have their rank; others a 62-bit hash with bit 62 set."""

    def __init__(self, hot: list[bytes]):
        super().__init__((w, i) for i, w in enumerate(hot))
        self.room = len(self) + CACHE_WORDS

    def __missing__(self, word: bytes) -> int:
        v = (xxhash.xxh64_intdigest(word, 42) >> 2) | (1 << 62)
        if len(self) < self.room:
            self[word] = v
        return v


def _deal(w: np.ndarray, h: np.ndarray, n_hot: int, n_buckets: int) -> np.ndarray:
    x = w.astype(np.uint64)
    hot = w < n_hot
    x[hot] = x[hot] * np.uint64(0x9E3779B97F4A7C15) + h[hot].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    return (x % np.uint64(n_buckets)).astype(np.int32)


def _planes(x: np.ndarray) -> bytes:
    """All first bytes, then all second ones, and so on: ids' empty high bytes then shrink to nothing."""
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def _from_planes(raw: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


PACKED = ("bucket", "uw", "uh", "pairs", "hi", "reps", "at", "uid", "learn", "all_uid", "all_id")


def _packed(w, h, row, uid, ids, learn, deal, with_rows: bool) -> pa.RecordBatch:
    """One row per bucket: its words, the pairs of each, and, if asked, the document rows these are from.

    Words and histories are listed once (``uw``, ``uh``); ``pairs`` says how many pairs a word has,
    ``hi`` which history each has, ``reps`` how often it occurs and ``at`` in which of the rows
    ``uid``, of which ``learn`` says whether they are learned from. The first bucket also lists all
    rows with their ids.
    """
    bucket = deal(w, h)
    # most histories are the word before, so that one look-up of distinct values ranks words and histories
    own = np.flatnonzero(h != np.r_[START, w[:-1]])
    own = np.union1d(own, [0])
    ranks = np.unique(np.concatenate([w, h[own]]), return_inverse=True)[1]
    rank_w, rank_h = ranks[: len(w)], np.r_[0, ranks[: len(w) - 1]]
    rank_h[own] = ranks[len(w) :]
    order = np.lexsort((rank_w << 32 | rank_h, bucket))
    w, h, row, bucket = w[order], h[order], row[order], bucket[order]
    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
    squeeze = zstandard.ZstdCompressor(level=3).compress
    cols: list[list] = [[] for _ in PACKED]
    for lo, hi in zip(edges[:-1], edges[1:]):
        new_w = w[lo:hi] != np.r_[~w[lo], w[lo : hi - 1]]
        new = np.flatnonzero(new_w | (h[lo:hi] != np.r_[h[lo], h[lo : hi - 1]]))
        at_word = np.flatnonzero(new_w[new])
        uh, of_h = np.unique(h[lo:hi][new], return_inverse=True)
        ints = [np.diff(np.r_[at_word, len(new)]), of_h, np.diff(np.r_[new, hi - lo])]
        longs = [np.diff(w[lo:hi][new[at_word]], prepend=0), np.diff(uh, prepend=0)]
        blobs = [*longs, *(x.astype(np.int32) for x in ints)]
        if with_rows:
            present, at = np.unique(row[lo:hi], return_inverse=True)
            blobs += [at.astype(np.int32), uid[present], learn[present], *((uid, ids) if lo == 0 else (uid[:0], ids[:0]))]
        for c, v in zip(cols, (int(bucket[lo]), *(squeeze(_planes(x)) for x in blobs), *[b""] * (10 - len(blobs)))):
            c.append(v)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if k else pa.int32()) for k, c in enumerate(cols)], names=list(PACKED))


def occurrences(docs: DataFrame, hot, n_buckets: int, parts: int = 1, with_rows: bool = True) -> DataFrame:
    """Every (history, word) of every row of (uid, id, learn, text), packed by bucket and batch.

    With ``parts`` a bucket's tokens are dealt out once more, by history.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Ids(hot.value)
        get, n_hot = lookup.__getitem__, len(hot.value)
        deal = lambda w, h: _deal(w, h, n_hot, n_buckets) * np.int32(parts) + ((h * 0x9E3779B1 >> 20) % parts).astype(np.int32)
        held: list[tuple[np.ndarray, np.ndarray, int]] = []
        rows: list[tuple[int, int, bool]] = []
        size = 0

        def flush():
            w, h = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
            row = np.repeat([x[2] for x in held], [len(x[0]) for x in held])
            uid, ids, learn = (np.array([r[k] for r in rows], t) for k, t in enumerate((np.int64, np.int64, np.uint8)))
            return _packed(w, h, row, uid, ids, learn, deal, with_rows)

        for b in batches:
            for uid, ident, learn, text in zip(*(b.column(k).to_pylist() for k in range(3)), b.column(3)):
                words = words_of(text.as_py())
                words.append(END)
                before = START
                for at in range(0, len(words), FLUSH_TOKENS):
                    part = words[at : at + FLUSH_TOKENS]
                    w = np.fromiter(map(get, part), np.int64, len(part))
                    rows.append((uid, ident, learn))
                    held.append((w, np.r_[before, w[:-1]], len(rows) - 1))
                    before, size = w[-1], size + len(w)
                    if size >= FLUSH_TOKENS:
                        yield flush()
                        held, rows, size = [], [], 0
        if held:
            yield flush()

    packed = docs.select("uid", "id", "learn", "text").mapInArrow(run, "bucket int, " + ", ".join(f"{x} binary" for x in PACKED[1:]))
    n = n_buckets * parts
    return packed.repartition(n, "bucket").sortWithinPartitions("bucket")


def _arrays(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words, distinct histories, distinct pairs, pair of each listed one, its repeats) of one bucket."""
    grow = zstandard.ZstdDecompressor().decompress
    arr = lambda name, t: [_from_planes(grow(x[name]), t) for x in rows]
    uw, wi = np.unique(np.concatenate([np.repeat(np.cumsum(x), n) for x, n in zip(arr("uw", np.int64), arr("pairs", np.int32))]), return_inverse=True)
    uh, hi = np.unique(np.concatenate([np.cumsum(x)[k] for x, k in zip(arr("uh", np.int64), arr("hi", np.int32))]), return_inverse=True)
    up, pi = np.unique(wi * len(uh) + hi, return_inverse=True)
    return uw, uh, up, pi.astype(np.int32), np.concatenate(arr("reps", np.int32))


NGRAMS = "order int, bucket int, h long, w long, c long, cw long"
#: Tokens whose pair was seen 1 to K_GT times, by row: their discounts are known only when all pairs are counted.
RARE = [f"r{r}" for r in range(1, K_GT + 1)]
SCORED = "uid long, id long, h long, n int, known int, base double, s double, " + ", ".join(f"{r} int" for r in RARE)
BOTH = f"{NGRAMS}, {SCORED.replace('h long, ', '')}"


def _part(schema: str, **cols) -> Iterator[pa.RecordBatch]:
    """Rows of ``schema`` in small batches; columns without values are null, a single value is that of all rows."""
    types = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
    fields = [x.split() for x in schema.split(", ")]
    size = max(np.size(x) for x in cols.values() if np.ndim(x))
    for lo in range(0, size, BATCH_ROWS):
        n = min(BATCH_ROWS, size - lo)
        own = {k: x[lo : lo + n] if np.ndim(x) else np.full(n, x) for k, x in cols.items()}
        arrays = [pa.array(own[name].astype(types[kind].to_pandas_dtype()), types[kind]) if name in own else pa.nulls(n, types[kind]) for name, kind in fields]
        yield pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


class _Tokens:
    """The tokens of one bucket: distinct words and histories, their pairs, and with ``with_rows`` each token's pair and row."""

    def __init__(self, rows: list[dict], with_rows: bool):
        self.uw, self.uh, up, pi, reps = _arrays(rows)
        self.of_w, self.of_h, self.codes = up // len(self.uh), up % len(self.uh), up
        if not with_rows:
            self.counted = np.bincount(pi, reps, len(up)).astype(np.int64)
            return
        grow = zstandard.ZstdDecompressor().decompress
        arr = lambda name, t: [_from_planes(grow(x[name]), t) for x in rows]
        uid = arr("uid", np.int64)
        starts = np.cumsum([0] + [len(x) for x in uid[:-1]])
        self.row, self.uid = np.concatenate([x + np.int32(o) for x, o in zip(arr("at", np.int32), starts)]), np.concatenate(uid)
        self.all_uid, self.all_id = np.concatenate(arr("all_uid", np.int64)), np.concatenate(arr("all_id", np.int64))
        self.pair = np.repeat(pi, reps)
        self.counted = np.bincount(self.pair[np.concatenate(arr("learn", np.uint8))[self.row] > 0], minlength=len(up))

    def sums(self, c_word: np.ndarray, c_pair: np.ndarray, m: dict, schema: str, bucket: int | None = None) -> Iterator[pa.RecordBatch]:
        """Sums by row, then the tokens that back off, by row and history, given the words' and pairs' counts.

        Each token is evaluated from the highest order down: a seen pair ends it there, any other
        is passed to the order below, and owes its history's weight.
        """
        of = lambda order: {} if bucket is None else {"order": order, "bucket": bucket}
        yield from _part(schema, uid=self.all_uid, id=self.all_id, **of(0))
        n, token = len(self.uid), self.pair
        add = lambda v: np.bincount(self.row, v, n)
        seen, rare = c_pair > 0, (c_pair > 0) & (c_pair <= K_GT)
        higher = np.where(rare, 0.0, np.log10(np.where(seen, (1 - EPSILON) * c_pair, 1.0)))
        lower = np.log10(word_probability(c_word, m))
        owed = np.where((self.uw != m["end"]) & (c_word > 0), np.log10(np.maximum(c_word, 1)), 0.0)
        s_pair = np.where(seen, higher, lower[self.of_w]) - owed[self.of_w]
        base = np.log10((c_word + 0.5) / (m["N"] + 0.5 * (m["V"] + 1)))[self.of_w]
        of_rare = np.flatnonzero(rare[token])
        times = np.bincount(self.row[of_rare].astype(np.int64) * K_GT + c_pair[token[of_rare]] - 1, minlength=n * K_GT).reshape(n, K_GT)
        yield from _part(schema, uid=self.uid, n=add(None), known=add((c_word > 0)[self.of_w][token]), base=add(base[token]), s=add(s_pair[token]), **dict(zip(RARE, times.T)), **of(0))
        off = np.flatnonzero(~seen[token])
        back, n = np.unique(self.row[off].astype(np.int64) * len(self.uh) + self.of_h[token[off]], return_counts=True)
        yield from _part(schema, uid=self.uid[back // len(self.uh)], h=self.uh[back % len(self.uh)], n=n, **of(-1))


def _count(bucket: int, rows: list[dict], hot_c: np.ndarray, m: dict, scored: bool) -> Iterator[pa.RecordBatch]:
    """One bucket's rows of ``ngrams``; with ``scored`` also its sums (order 0) and what is owed (order -1)."""
    schema = BOTH if scored else NGRAMS
    t = _Tokens(rows, scored)
    c, cold = t.counted, t.uw >= len(hot_c)
    c_word = np.bincount(t.of_w, c, len(t.uw)).astype(np.int64)
    c_word[~cold] = hot_c[t.uw[~cold]]
    k, kw = np.flatnonzero(c), np.flatnonzero(cold & (c_word > 0))
    yield from _part(schema, order=2, bucket=bucket, h=t.uh[t.of_h[k]], w=t.uw[t.of_w[k]], c=c[k], cw=c_word[t.of_w[k]])
    yield from _part(schema, order=1, bucket=bucket, h=0, w=t.uw[kw], c=c_word[kw], cw=c_word[kw])
    if scored:
        yield from t.sums(c_word, c, m, schema, bucket)


def _by_bucket(batches: Iterator[pa.RecordBatch], use) -> Iterator[pa.RecordBatch]:
    """``use(bucket, rows)`` for each bucket of a task, one after the other."""
    held: list[dict] = []
    for b in batches:
        for k in range(len(b)):
            r = {n: b.column(n)[k].as_py() for n in b.schema.names}
            if held and held[0]["bucket"] != r["bucket"]:
                yield from use(held[0]["bucket"], held)
                held = []
            held.append(r)
    if held:
        yield from use(held[0]["bucket"], held)


def word_probability(c, uni: dict):
    """P(w) of words with training counts c; 0 is the class of unknown words."""
    d = np.r_[0.0, uni["d"]]
    c = np.asarray(c)
    p = np.where(c > K_GT, (1 - EPSILON) * c, d[np.minimum(c, K_GT)] * c) / max(uni["N"], 1)
    return np.where(c == 0, uni["unknown"], p)


def discounted(c, d: list[float]):
    """Column: d(c)·c."""
    small = F.element_at(F.array(*map(F.lit, d)), F.least(c, F.lit(K_GT)).cast("int"))
    return c * F.when(c > K_GT, 1 - EPSILON).otherwise(small)


def unigram_model(counts: DataFrame) -> dict:
    """N, tokens of other rows, V, discounts and the unknown class's mass; ``counts`` as of word_counts."""
    n_r = [F.count_if(F.col("c") == r).alias(f"n{r}") for r in range(1, K_GT + 2)]
    got = counts.agg(F.sum("c").alias("N"), F.sum("other").alias("other"), F.count_if(F.col("c") > 0).alias("V"), F.sum(F.when(F.col("c") > K_GT, F.col("c"))).alias("big"), *n_r).first()
    n, big = [got[f"n{r}"] for r in range(1, K_GT + 2)], got["big"] or 0
    d, total = discounts(n), got["N"] or 0
    kept = sum(d[r - 1] * r * n[r - 1] for r in range(1, K_GT + 1)) + (1 - EPSILON) * big
    return {"N": total, "other": got["other"] or 0, "V": got["V"], "d": d, "unknown": 1 - kept / total if total else 1.0}


@dataclass
class Katz:
    """A model's folder and what of it is small: frequent words with counts, and ``meta``."""

    folder: str
    words: list[bytes]
    counts: np.ndarray
    meta: dict


def load(spark: SparkSession, folder: str) -> Katz:
    """The model that ``train`` wrote to ``folder``; one of an empty table has no frequent words and knows no other."""
    hot = spark.read.parquet(f"{folder}/hot").orderBy("id").collect()  # at most HOT rows
    meta = json.loads(spark.read.parquet(f"{folder}/meta").first()["meta"])
    return Katz(folder, [bytes(r.word) for r in hot], np.array([r.c for r in hot], np.int64), meta)


def _fit(rows: DataFrame, folder: str, scored: bool) -> Katz:
    """The model of the rows of (uid, id, learn, text) that are to be learned from, in ``folder``; with ``scored`` also all rows' sums."""
    spark, zstd = rows.sparkSession, {"compression": "zstd"}
    # a word seen once is never hot, so that the table need not spell it
    whole = F.col("c") + F.col("other")
    counts = materialize(word_counts(rows).select(F.when(whole > 1, F.col("word")).alias("word"), "c", "other"), "words", drop_shuffles=True)
    uni = unigram_model(counts)
    tokens = uni["N"] + uni.pop("other")
    hot = counts.where(whole >= max(2, -(-tokens // HOT))).orderBy(whole.desc(), "word").collect()  # at most HOT rows
    words, hot_c = [bytes(r.word) for r in hot], np.array([r.c for r in hot], np.int64)
    frequent = spark.createDataFrame([(k, r.word, r.c) for k, r in enumerate(hot)], "id int, word binary, c long")
    frequent.coalesce(1).write.options(**zstd).parquet(f"{folder}/hot")
    n_buckets = 1 + tokens // BUCKET_TOKENS
    meta = uni | {"n_buckets": n_buckets, "end": int(_Ids(words)[END])}
    dealt = occurrences(rows, spark.sparkContext.broadcast(words), n_buckets, with_rows=scored)
    count = lambda bucket, packed: _count(bucket, packed, hot_c, meta, scored)
    counted = dealt.mapInArrow(lambda batches: _by_bucket(batches, count), BOTH if scored else NGRAMS)
    with brief_shuffles(spark), setting(spark, "spark.sql.maxConcurrentOutputFileWriters", WRITERS):
        counted.write.partitionBy("order", "bucket").options(**zstd).parquet(f"{folder}/ngrams")

    pairs = spark.read.schema(NGRAMS).parquet(f"{folder}/ngrams").where("order = 2")
    seen = {r.r: r.n for r in pairs.where(F.col("c") <= K_GT + 1).groupBy(F.col("c").alias("r")).agg(F.count("*").alias("n")).collect()}  # at most six rows
    d = discounts([seen.get(r, 0) for r in range(1, K_GT + 2)])
    history = pairs.groupBy("h").agg(F.sum("c").alias("total"), F.sum(F.col("c") - discounted(F.col("c"), d)).alias("left"), F.sum(discounted(F.col("cw"), uni["d"]) / max(uni["N"], 1)).alias("p"))
    # alpha(h)·c(h): the discounted counts' remainder over what P(w) leaves to unseen words
    weight = F.col("left") / F.greatest(1 - F.col("p"), F.lit(uni["unknown"]))
    n_parts = 1 + n_buckets // 16
    weights = history.select("h", "total", weight.alias("weight"), F.pmod(F.xxhash64("h"), F.lit(n_parts)).cast("int").alias("bucket"))
    with brief_shuffles(spark):
        weights.repartition(n_parts, "bucket").write.partitionBy("bucket").options(**zstd).parquet(f"{folder}/weights")
    first = spark.read.schema(WEIGHTS).parquet(f"{folder}/weights").where(F.col("h") == START).select("total").first() if uni["N"] else None
    meta |= {"d2": d, "starts": first.total if first else 0}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.parquet(f"{folder}/meta")
    return Katz(folder, words, hot_c, meta)


def train(docs: DataFrame, text_col: str = "text", folder: str | None = None) -> Katz:
    """Write the model of all rows of ``docs`` to ``folder`` (by default one that goes with the application).

    Null texts are empty: the end token alone. Repeated rows count each for itself, very long texts
    are read whole, an empty table gives a model in which every word is unknown with probability 1.
    Further columns are not read. Words are told apart by 62 bits of XXH64 unless hot.
    """
    zero = F.lit(0).cast("long")
    rows = docs.select(zero.alias("uid"), zero.alias("id"), F.lit(True).alias("learn"), text_of(docs, text_col).alias("text"))
    return _fit(rows, folder or new_path(docs.sparkSession, "katz"), scored=False)


class _Tables:
    """The count tables of one bucket after another, read where its tokens are."""

    def __init__(self, folder: str):
        self.store, self.root = pafs.FileSystem.from_uri(f"{folder}/ngrams")

    def read(self, order: int, bucket: int, columns: list[str]) -> list[np.ndarray]:
        where = pafs.FileSelector(f"{self.root}/order={order}/bucket={bucket}", allow_not_found=True)
        files = [f.path for f in self.store.get_file_info(where) if f.path.endswith(".parquet")]
        parts = [pq.read_table(self.store.open_input_file(f), columns=columns) for f in files]
        return [np.concatenate([t.column(c).to_numpy() for t in parts]) if parts else np.empty(0, np.int64) for c in columns]


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The value of each wanted key, 0 where it is none of ``keys``."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    order = np.argsort(keys)
    at = np.minimum(np.searchsorted(keys, wanted, sorter=order), len(keys) - 1)
    return np.where(keys[order[at]] == wanted, values[order[at]], 0)


def _evaluate(bucket: int, rows: list[dict], tables: _Tables, hot_c: np.ndarray, m: dict) -> Iterator[pa.RecordBatch]:
    """One bucket's sums by row, and its tokens that back off, by row and history, from the stored tables."""
    t = _Tokens(rows, True)
    c_word = _found(*tables.read(1, bucket, ["w", "c"]), t.uw)
    is_hot = t.uw < len(hot_c)
    c_word[is_hot] = hot_c[t.uw[is_hot]]
    w, h, c = tables.read(2, bucket, ["w", "h", "c"])
    wi, hi = np.searchsorted(t.uw, w), np.searchsorted(t.uh, h)
    ours = (t.uw[np.minimum(wi, len(t.uw) - 1)] == w) & (t.uh[np.minimum(hi, len(t.uh) - 1)] == h)
    c_pair = _found(wi[ours] * len(t.uh) + hi[ours], c[ours], t.codes)
    del w, h, c, wi, hi, ours
    yield from t.sums(c_word, c_pair, m, SCORED)


NO_ID = -(1 << 63)


def _scorable(docs: DataFrame, id_col: str, text_col: str, learn) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("uid"), F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("id"), learn.alias("learn"), text_of(docs, text_col).alias("text"))


def _settled(found: DataFrame, model: Katz) -> DataFrame:
    """Scores by row from the buckets' sums: rare pairs get their discounts, tokens that backed off their histories' weights."""
    spark, m = found.sparkSession, model.meta
    weights = spark.read.schema(WEIGHTS).parquet(f"{model.folder}/weights").select("h", F.log10("weight").alias("weight"))
    backs, is_hot = found.where("h IS NOT NULL").select("uid", "h", "n"), F.col("h") < len(model.words)
    small = F.broadcast(weights.where(is_hot))  # at most HOT + 1 rows
    backed = backs.where(is_hot).join(small, "h").unionByName(backs.where(~is_hot).join(weights.where(~is_hot), "h"))
    owed = backed.select("uid", (F.col("n") * F.col("weight")).alias("s"))
    rare = sum((F.col(r) * F.lit(float(np.log10(d * k))) for k, (r, d) in enumerate(zip(RARE, m["d2"]), 1)), F.lit(0.0))
    own = found.where("h IS NULL").select("uid", "id", "n", "known", "base", F.col("s") + rare if m["N"] else F.col("s"))
    own = own.toDF("uid", "id", "n", "known", "base", "s")
    total = own.unionByName(owed, allowMissingColumns=True).groupBy("uid").agg(F.max("id").alias("id"), *(F.sum(x).alias(x) for x in ("n", "known", "base", "s")))
    return total.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"),
        F.col("n").cast("long").alias("n_tokens"),
        F.col("known").cast("long").alias("n_known"),
        F.lit(m["N"]).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        (F.col("s") - F.lit(float(np.log10(m["starts"])) if m["starts"] else 0.0)).alias("score"),
    )


def score(docs: DataFrame, model: Katz, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    Null texts are empty and have the end token alone; very long ones are read whole. Repeated rows
    are scored each for itself; rows with a null id keep theirs; an empty table gives no rows.
    Further columns are not read. Texts may be others than those that the model is of.
    """
    spark, m, folder, hot_c = docs.sparkSession, model.meta, model.folder, model.counts
    size = docs.agg(F.sum(F.octet_length(text_of(docs, text_col)))).first()[0] or 0
    parts = max(1, -(-(size // 6) // (m["n_buckets"] * SCORE_TOKENS)))
    dealt = occurrences(_scorable(docs, id_col, text_col, F.lit(False)), spark.sparkContext.broadcast(model.words), m["n_buckets"], parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _Tables(folder)
        return _by_bucket(batches, lambda bucket, packed: _evaluate(bucket // parts, packed, tables, hot_c, m))

    return _settled(materialize(dealt.mapInArrow(run, SCORED), "katz", drop_shuffles=True), model)


def katz_scores(docs: DataFrame, train_rows, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``score`` of all rows by the model of those where the boolean column ``train_rows`` holds (null: not).

    The texts are dealt out once, for counting and for scoring: a bucket's task has the whole counts
    of its words and pairs, so it writes them and evaluates its tokens by them.
    """
    spark = docs.sparkSession
    folder = new_path(spark, "katz")
    model = _fit(_scorable(docs, id_col, text_col, F.coalesce(train_rows, F.lit(False))), folder, scored=True)
    return _settled(spark.read.schema(BOTH).parquet(f"{folder}/ngrams").where("order < 1"), model)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by the model of the training fold; edge cases as in ``train`` and ``score``."""
    scored = katz_scores(table(spark, sf_dir, "documents"), fold("doc_id", 5) != 1)
    return scored.select("doc_id", (fold("doc_id", 5) == 1).alias("held_out"), *scored.columns[1:])
