"""Quality classifier: an additive model of shallow boosted trees with pairwise interactions.

Features are counts and shares of a whole text. Training is cyclic: each round gives every feature
in turn a tree of at most three leaves, fitted to the residual over the feature's bins and added to
the feature's lookup table; then the pairs with the largest gain get trees of two cuts, one a
feature. The model is its tables: a score is the sum of the entries at the row's bins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.llm.common import fold, table
from tagflow.llm.labelled import sample

#: Labelled rows to learn from, at most.
SAMPLE_ROWS = 8_000
BINS, ROUNDS, RATE, PAIRS, PAIR_BINS, PAIR_ROUNDS = 48, 120, 0.15, 8, 12, 60
THRESHOLD = 0.3
FEATURES = (
    "log_words", "word_length", "upper_share", "digit_share", "symbol_share", "bang_share", "stop_share", "comma_share",
    "pipe_share", "line_words", "repeated_lines", "distinct_words", "repeated_grams", "capital_words", "end_symbols", "longest_word",
)
_UPPER, _DIGIT, _SYMBOL = (np.frombuffer(x, np.uint8) for x in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>@^~_=+{}[]\\/"))


def features(text: str) -> list[float]:
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    n, size = len(words), max(1, len(raw))
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    h = np.fromiter(map(hash, words), np.int64, n)
    lens = np.fromiter(map(len, words), np.int64, n)
    m = max(1, n)
    grams = h[:-4] * 3 + h[1:-3] * 5 + h[2:-2] * 7 + h[3:-1] * 11 + h[4:] * 13 if n > 4 else h[:0]
    return [
        np.log1p(n), lens.sum() / m, byte[_UPPER].sum() / size, byte[_DIGIT].sum() / size, byte[_SYMBOL].sum() / size, byte[33] / size, byte[46] / m, byte[44] / m,
        byte[124] / m, n / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)), len(np.unique(h)) / m,
        1 - len(np.unique(grams)) / max(1, len(grams)), sum(w.isupper() for w in words) / m, sum(w[-1] in b"#*$%&|<>!" for w in words) / m, np.log1p(lens.max(initial=0)),
    ]


def feature_rows(texts: list[str]) -> np.ndarray:
    return np.array([features(t) for t in texts], np.float64).reshape(-1, len(FEATURES))


class Gam:
    """``cuts`` by feature, ``tables`` by feature, ``pairs`` of (i, j, cuts i, cuts j, table)."""

    def __init__(self, base: float, cuts: list, tables: list, pairs: list):
        self.base, self.cuts, self.tables, self.pairs = base, cuts, tables, pairs

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for k, (c, t) in enumerate(zip(self.cuts, self.tables)):
            z += t[np.searchsorted(c, x[:, k], "right")]
        for i, j, ci, cj, t in self.pairs:
            z += t[np.searchsorted(ci, x[:, i], "right"), np.searchsorted(cj, x[:, j], "right")]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _quantiles(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.empty(0)


def _leaf(g, h):
    return g / (h + 1.0)


def _gain(g, h):
    return g * g / (h + 1.0)


def _shallow(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Best tree of up to two cuts over bins with gradient and weight sums: its value by bin."""
    out, spans = np.zeros(len(g)), [(0, len(g))]
    for _ in range(2):
        best = (1e-9, None, 0)
        for lo, hi in spans:
            if hi - lo < 2:
                continue
            cg, ch = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
            left_g, left_h = cg[:-1], ch[:-1]
            gain = _gain(left_g, left_h) + _gain(cg[-1] - left_g, ch[-1] - left_h) - _gain(cg[-1], ch[-1])
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], (lo, hi), lo + k + 1)
        if best[1] is None:
            break
        spans.remove(best[1])
        spans += [(best[1][0], best[2]), (best[2], best[1][1])]
    for lo, hi in spans:
        out[lo:hi] = _leaf(g[lo:hi].sum(), h[lo:hi].sum())
    return out


def _square(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best pair of cuts, one an axis: (gain over none, its four values spread over the bins)."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    tg, th = cg[-1, -1], ch[-1, -1]
    a = (cg[:-1, :-1], ch[:-1, :-1])
    top = (cg[:-1, -1:] - a[0], ch[:-1, -1:] - a[1])
    left = (cg[-1:, :-1] - a[0], ch[-1:, :-1] - a[1])
    rest = (tg - a[0] - top[0] - left[0], th - a[1] - top[1] - left[1])
    gain = sum(_gain(*q) for q in (a, top, left, rest)) - _gain(tg, th)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.empty(g.shape)
    for q, (r, c) in zip((a, top, left, rest), ((slice(None, i + 1), slice(None, j + 1)), (slice(None, i + 1), slice(j + 1, None)), (slice(i + 1, None), slice(None, j + 1)), (slice(i + 1, None), slice(j + 1, None)))):
        out[r, c] = _leaf(q[0][i, j], q[1][i, j])
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Fit to rows ``x`` and 0/1 ``y``. Without rows, or with one label only, every score is the prior's."""
    prior = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(prior / (1 - prior)))
    cuts = [_quantiles(x[:, k], BINS) for k in range(x.shape[1])]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    if len(set(y.tolist())) < 2:
        return Gam(base, cuts, tables, [])
    bins = [np.searchsorted(c, x[:, k], "right") for k, c in enumerate(cuts)]
    z = np.full(len(y), base)

    def residual():
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for b, t in zip(bins, tables):
            g, h = residual()
            step = RATE * _shallow(np.bincount(b, g, len(t)), np.bincount(b, h, len(t)))
            t += step
            z += step[b]
    for k, (b, t) in enumerate(zip(bins, tables)):  # tables of mean zero over the rows
        mean = np.bincount(b, minlength=len(t)) @ t / len(y)
        t -= mean
        base += mean
    coarse = [_quantiles(x[:, k], PAIR_BINS) for k in range(x.shape[1])]
    small = [np.searchsorted(c, x[:, k], "right") for k, c in enumerate(coarse)]
    grid = lambda i, j, v: np.bincount(small[i] * (len(coarse[j]) + 1) + small[j], v, (len(coarse[i]) + 1) * (len(coarse[j]) + 1)).reshape(len(coarse[i]) + 1, -1)
    g, h = residual()
    gains = sorted(((_square(grid(i, j, g), grid(i, j, h))[0], i, j) for i in range(x.shape[1]) for j in range(i)), reverse=True)[:PAIRS]
    pairs = [(i, j, coarse[i], coarse[j], np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1))) for _, i, j in gains]
    for _ in range(PAIR_ROUNDS):
        for i, j, _, _, t in pairs:
            g, h = residual()
            step = RATE * _square(grid(i, j, g), grid(i, j, h))[1]
            t += step
            z += step[small[i], small[j]]
    return Gam(base, cuts, tables, pairs)


def train(docs: DataFrame, labels: DataFrame, label_col: str, learn, rows: int = SAMPLE_ROWS) -> Gam:
    """Learn from at most ``rows`` labelled rows; their features, a fixed number, are computed where they are read.

    Whole texts, null ones as empty; which rows, and what becomes of repeats, says ``sample``.
    """
    names = ", ".join(f"f{k} double" for k in range(len(FEATURES)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = feature_rows(b["text"].tolist())
            yield pd.concat([b[["s_order", "label"]], pd.DataFrame(x, index=b.index, columns=[f"f{k}" for k in range(len(FEATURES))])], axis=1)

    got = sample(docs, labels, label_col, learn, rows).mapInPandas(run, f"s_order long, label int, {names}").toPandas().sort_values("s_order", kind="stable")
    return fit(got.iloc[:, 2:].to_numpy(np.float64), got["label"].to_numpy(np.float64))


def score(docs: DataFrame, model: Gam, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, score.

    Null texts are empty and scored so; very long ones are read whole. Values on a bin's edge belong
    to the upper bin. Repeated rows and null ids keep their rows; an empty table gives no rows; other
    columns, whatever their names, are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = feature_rows([t.as_py() or "" for t in b.column(1)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shared.value.score(x), pa.float64())], names=["doc_id", "score"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, "doc_id long, score double")


def op1(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents; edge cases as in ``score``."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = score(docs, train(docs, labels, "quality", fold("doc_id", 5) != 0))
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
