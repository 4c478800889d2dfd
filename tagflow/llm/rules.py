"""Quality rules: fixed measures of a text, and a hashed n-gram logistic regression.

The regression reads words, pairs of neighbouring words and groups of four characters by their
hashed shares of the text, is trained on a bounded sample of labelled rows and calibrated by Platt's
method on rows that training did not see. Measures and probability come from one pass in Arrow batches, against fixed thresholds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.llm.common import fold, table
from tagflow.llm.labelled import collected, sample

#: Labelled rows to learn from, at most, and bytes of their n-grams. A text has at most 2 ** 19 distinct ones.
SAMPLE_ROWS = 6_000
SAMPLE_BYTES = 160 << 20
#: Hash table sizes of words, word pairs and character groups, in bits.
BITS, GRAM = (16, 17, 18), 4
EPOCHS, RATE, SCALE = 6, 0.5, 20.0
#: Fixed thresholds.
FEWEST_WORDS, REPEATED_PERCENT, WINDOW, KEEP_FROM = 20, 30, 8, 0.3
SYMBOLS = "#*$%&|<>"
BLANK = " \t\n\v\f\r"
_ODD = np.random.default_rng(3).integers(1, 1 << 62, WINDOW, dtype=np.int64) | 1


def measures(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words).

    Windows of words are compared by sums of 64-bit hashes with random odd factors; two that differ
    are alike with a chance of about 2 ** -62 a pair.
    """
    words = text.encode("utf-8", "replace").split()
    n = len(words)
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line.strip(BLANK):
            dup += line in seen
            seen.add(line)
    repeat = 0
    if n >= WINDOW + 1:
        h = np.fromiter(map(hash, words), np.int64, n)
        m = n - WINDOW + 1
        key = sum(h[i : m + i] * _ODD[i] for i in range(WINDOW))
        _, inv, count = np.unique(key, return_inverse=True, return_counts=True)
        hit = np.flatnonzero(count[inv] > 1)
        if len(hit):
            cover = np.zeros(n + 1, np.int64)
            np.add.at(cover, hit, 1)
            np.add.at(cover, hit + WINDOW, -1)
            repeat = int((np.cumsum(cover)[:n] > 0).sum())
    return n, len(text) - sum(map(text.count, BLANK)), sum(map(text.count, SYMBOLS)), dup, repeat


def grams(text: str) -> list[np.ndarray]:
    """Hashed words, pairs of words and groups of GRAM characters, repeats included."""
    words = text.encode("utf-8", "replace").split()
    w = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    pair = (w[:-1] * np.uint32(2246822519)) ^ (w[1:] * np.uint32(3266489917))
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    m = max(0, len(c) - GRAM + 1)
    key = np.zeros(m, np.uint32)
    for i in range(GRAM):
        key = key * np.uint32(16777619) + c[i : m + i]
    return [(x * np.uint32(2654435761)) >> np.uint32(32 - bits) for x, bits in zip((w, pair, key), BITS)]


class Regression:
    def __init__(self):
        self.weights = [np.zeros(1 << b, np.float32) for b in BITS]
        self.bias, self.slope, self.shift = 0.0, 1.0, 0.0

    def margin(self, text: str) -> float:
        return self.bias + SCALE * sum(float(w[g].mean(dtype=np.float64)) for w, g in zip(self.weights, grams(text)) if len(g))

    def probability(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(text) + self.shift, -30, 30))))


def _shares(x: np.ndarray, offset: int) -> tuple[np.ndarray, np.ndarray]:
    u, n = np.unique(x, return_counts=True)
    return (u + offset).astype(np.int32), (n * (SCALE / max(1, len(x)))).astype(np.float32)


OFFSETS = (0, 1 << BITS[0], (1 << BITS[0]) + (1 << BITS[1]))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> Regression:
    """Fit to sparse rows (indices, shares) and 0/1 ``y``; every fifth row calibrates only.

    With one label only, or no rows, the probability is the smoothed share of ones.
    """
    model = Regression()
    if len(set(y.tolist())) < 2:
        model.slope, model.shift = 0.0, float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        return model
    check = np.arange(len(y)) % 5 == 4
    w, r = np.zeros(sum(1 << b for b in BITS), np.float32), np.random.default_rng(5)
    seen = np.full_like(w, 1e-2)
    bias, seen_b = 0.0, 1e-2
    for _ in range(EPOCHS):
        for i in r.permutation(np.flatnonzero(~check)):
            idx, x = rows[i]
            g = 1 / (1 + np.exp(-np.clip(bias + float(x @ w[idx]), -30, 30))) - y[i]
            grad = (g * x).astype(np.float32)
            seen[idx] += grad * grad
            w[idx] -= RATE * grad / np.sqrt(seen[idx])
            seen_b += g * g
            bias -= RATE * g / np.sqrt(seen_b)
    model.weights, model.bias = np.split(w, OFFSETS[1:]), bias
    held = np.flatnonzero(check)
    if len(set(y[held].tolist())) == 2:
        z, t = np.array([bias + float(rows[i][1] @ w[rows[i][0]]) for i in held]), y[held]
        n1, n0 = t.sum(), len(t) - t.sum()
        t = np.where(t > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        a, b = 1.0, 0.0
        for _ in range(50):  # Newton steps with a small ridge
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            s = p * (1 - p)
            grad = np.array([(p - t) @ z, (p - t).sum()])
            hess = np.array([[s @ (z * z) + 1e-3, s @ z], [s @ z, s.sum() + 1e-3]])
            da, db = np.linalg.solve(hess, grad)
            a, b = a - da, b - db
            if not np.isfinite(a + b):
                a, b = 1.0, 0.0
                break
            if abs(da) + abs(db) < 1e-8:
                break
        model.slope, model.shift = float(max(a, 1e-3)), float(b)
    return model


def train(docs: DataFrame, labels: DataFrame, label_col: str, learn, rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> Regression:
    """Learn from at most ``rows`` labelled rows and ``max_bytes`` of n-grams, which are counted where the texts are read.

    Whole texts, null ones as empty; which rows, and what becomes of repeats, says ``sample``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sparse = [[np.concatenate(v).tobytes() for v in zip(*(_shares(g, o) for g, o in zip(grams(t), OFFSETS)))] for t in b["text"]]
            yield b[["s_order", "label"]].assign(idx=[x[0] for x in sparse], val=[x[1] for x in sparse])

    found = sample(docs, labels, label_col, learn, rows).mapInPandas(run, "s_order long, label int, idx binary, val binary")
    got = collected(found, F.octet_length("idx") + F.octet_length("val"), max_bytes)
    sparse = [(np.frombuffer(i, np.int32), np.frombuffer(v, np.float32)) for i, v in zip(got["idx"], got["val"])]
    return fit(sparse, got["label"].to_numpy(np.float32))


def judge(docs: DataFrame, model: Regression, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, the measures, base_failed, kept, probability.

    Null and empty texts have no words and so fail; very long ones are read whole. Repeated rows and
    null ids keep their rows; a probability equal to the threshold keeps; an empty table gives no
    rows; other columns, whatever their names, are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.as_py() or "" for t in b.column(1)]
            cols = list(zip(*map(measures, texts))) or [()] * 5
            p = [shared.value.probability(t) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols), pa.array(p, pa.float64())], names=["doc_id", *names, "probability"])

    schema = "doc_id long, " + ", ".join(f"{x} long" for x in names) + ", probability double"
    out = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, schema)
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    return out.select("doc_id", *names, failed.alias("base_failed"), (~failed & (F.col("probability") >= KEEP_FROM)).alias("kept"), "probability")


def op9(spark, sf_dir: str) -> DataFrame:
    """Measures and verdicts of all documents; edge cases as in ``judge``."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return judge(docs, train(docs, labels, "quality", fold("doc_id", 5) != 0))
